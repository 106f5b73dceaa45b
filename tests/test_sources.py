import json

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tessera.operators import activities as act
from tessera.operators.objects import clean_objects, facts_of
from tessera.sources import filters
from tessera.sources.activity_json import read_activity_json
from tessera.sources.log import CommitLog
from tessera.sources.object_csv import read_object_csv
from tessera.sources.store import ObjectStore, ProcessStore
from tessera.streaming.landing import fact_stream, facts_of_stream, follow_activities, follow_new_objects, follow_objects

HEADER = "Key,Kind,Name,When,Who,Holder,Where\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_ragged_csv(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        HEADER
        + '1,Map,"A ""quoted"", title",1500,"Doe, J (V:1)",BUB,Bologna\n'
        + "2,Map,short\n"
        + "3,Map,t,1,,w,p,one too many\n"
        + '4,Map,"a,b,c,d,e,f,g",,,"w, ""x"", y"\n'
        + "\n"
        + "5,Map,NA,,,w,p\n",
    )
    rows = {r.identifier: r for r in read_object_csv(spark, path).collect() if r.identifier}
    assert set(rows) == {"1", "2", "4", "5"}
    assert rows["1"].title == 'A "quoted", title' and rows["1"].hasAuthor == "Doe, J (V:1)"
    assert rows["2"].owner is None and rows["2"].title == "short"
    assert rows["4"].title == "a,b,c,d,e,f,g" and rows["4"].owner == 'w, "x", y'
    assert rows["5"].title == "NA" and rows["5"].hasAuthor is None


def test_line_breaks_in_cells_are_noticed(spark, tmp_path):
    path = write(tmp_path / "o.csv", HEADER + '1,Map,"two\nlines",,,w,p\n2,Map,t,,,w,p\n')
    assert [(r.identifier, r.title) for r in read_object_csv(spark, path).collect()] == [
        ("1", "two\nlines"), ("2", "t"),
    ]


DOCUMENTS = """[
 {"object id": " 1 ",
  "acquisition": {"responsible institute": "Lab", "technique": "Scan", "tool": ["a ", "b,c"], "start date": "2023-05-08", "end date": ""},
  "Processing": {"Responsible Institute": "Lab", "tool": "Solo"},
  "modelling": {"responsible institute": "first", "tool": []},
  "modelling": {"responsible institute": "last", "tool": ["x", null]},
  "interpretation": {"responsible institute": "Lab"},
  "optimising": {"responsible institute": " "},
  "exporting": {"responsible institute": "Lab", "technique": "Scan"}},
 {"object id": "2", "acquisition": {"responsible institute": ["p", "q"], "technique": "T"}},
 {"object id": "", "processing": {"responsible institute": "Lab"}},
 {"object id": "3", "acquisition": {"responsible institute": "Lab"}, "processing": "not an object"}
]"""


def expected_activities():
    return [
        ("Acquisition", "1", "Scan", "Lab", None, "2023-05-08", None, ["a", "b,c"]),
        ("Acquisition", "2", "T", '["p","q"]', None, None, None, None),
        ("Modelling", "1", None, "last", None, None, None, None),
        ("Processing", "1", None, "Lab", None, None, None, ["Solo"]),
    ]


def test_activity_documents(spark, tmp_path):
    path = write(tmp_path / "p.json", DOCUMENTS)
    assert tuples(act.activities_from(read_activity_json(spark, path))) == expected_activities()


def test_activity_lines(spark, tmp_path):
    # Written by hand, as a dict would lose the repeated key.
    first = DOCUMENTS[DOCUMENTS.index("{"):DOCUMENTS.index("}},") + 2].replace("\n", " ")
    rest = [json.dumps(d) for d in json.loads(DOCUMENTS)[1:]]
    path = write(tmp_path / "p.jsonl", "\n".join([first, "", *rest]) + "\n")
    rows = read_activity_json(spark, path, lines=True)
    assert tuples(act.activities_from(rows)) == expected_activities()


def test_wide_activities_with_missing_columns(spark):
    wide = spark.createDataFrame(
        [("1", ("Lab", "Scan"), ("Lab",)), ("2", None, None)],
        "`object id` string, acquisition struct<`responsible institute`: string, technique: string>,"
        "exporting struct<`responsible institute`: string>",
    )
    assert tuples(act.unpivot_activities(wide)) == [
        ("Acquisition", "1", "Scan", "Lab", None, None, None, None),
        ("Exporting", "1", None, "Lab", None, None, None, None),
    ]


def objects_file(tmp_path, name, *lines):
    return write(tmp_path / name, HEADER + "".join(line + "\n" for line in lines))


def test_object_pushes_form_a_set(spark, tmp_path):
    store = ObjectStore(spark, str(tmp_path / "store"))
    first = objects_file(tmp_path, "a.csv", "1,Map,t,,Doe (V:1); (V:2),w,p", "1,Map,t,,,w,p", ",Map,x,,,,")
    second = objects_file(tmp_path, "b.csv", "1,Map,t,,Doe (V:1),w,p", "2, nautical chart ,t2,,,w,p", "3,Nope,t,,,w,p")
    assert store.facts().records.count() == 0
    for path in (first, first, second):
        store.push_csv(path)
    facts = store.facts()
    assert [r[0] for r in tuples(facts.records)] == ["1", "2"]
    assert tuples(facts.authored) == [("1", "V:1"), ("1", "V:2")]
    assert tuples(facts.person) == [("V:1", "Doe"), ("V:2", None)]
    store.reset()
    assert store.facts().records.count() == 0
    store.push_csv(second)
    assert store.facts().records.count() == 2


def test_activity_pushes_form_a_bag(spark, tmp_path):
    path = write(tmp_path / "p.json", DOCUMENTS)
    store = ProcessStore(spark, str(tmp_path / "store"))
    store.reset()
    for _ in range(3):
        store.push_json(path)
    assert tuples(store.activities()) == sorted(expected_activities() * 3, key=repr)
    rows = read_activity_json(spark, path)
    store.push(rows, label="again")
    store.push(rows, label="again")
    assert store.activities().count() == 16
    store.reset()
    assert store.activities().count() == 0


def test_lookup_by_id_is_pushed_to_the_files(spark, tmp_path):
    store = ObjectStore(spark, str(tmp_path / "store"))
    store.push_csv(objects_file(tmp_path, "a.csv", "1,Map,t,,Doe (V:1),w,p"))
    found = store.facts().records.filter(F.col("identifier").isin("1", "2")).select("title")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(identifier, [1,2])" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<identifier:string,title:string>" in plan


def test_landed_files_are_pushed_once(spark, tmp_path):
    landing, progress = tmp_path / "landing", tmp_path / "progress"
    store = ObjectStore(spark, str(tmp_path / "objects"))
    objects_file(landing / "o", "a.csv", "1,Map,t,,Doe (V:1),w,p")
    follow_objects(spark, str(landing / "o"), store, str(progress / "o")).awaitTermination()
    objects_file(landing / "o", "b.csv", "2,Map,t,,,w,p,too,long", "3,Map,t,,,w,p")
    follow_objects(spark, str(landing / "o"), store, str(progress / "o")).awaitTermination()
    assert [r[0] for r in tuples(store.facts().records)] == ["1", "3"]

    bag = ProcessStore(spark, str(tmp_path / "activities"))
    line = json.dumps({"object id": "1", "processing": {"responsible institute": "Lab"}})
    for name in ("a.jsonl", "b.jsonl"):
        write(landing / "p" / name, line + "\n")
        follow_activities(spark, str(landing / "p"), bag, str(progress / "p")).awaitTermination()
    assert bag.activities().count() == 2


def test_followed_folders_keep_apart(spark, tmp_path):
    bag = ProcessStore(spark, str(tmp_path / "activities"))

    def land(folder, name, progress):
        line = json.dumps({"object id": name, "processing": {"responsible institute": "Lab"}})
        write(tmp_path / folder / f"{name}.jsonl", line + "\n")
        follow_activities(spark, str(tmp_path / folder), bag, str(tmp_path / progress)).awaitTermination()

    land("north", "1", "progress1")
    land("south", "2", "progress2")
    assert [r[1] for r in tuples(bag.activities())] == ["1", "2"]
    (tmp_path / "north" / "1.jsonl").unlink()
    land("north", "3", "afresh")
    assert [r[1] for r in tuples(bag.activities())] == ["1", "2", "3"]


def test_a_single_document_is_an_array_of_one(spark, tmp_path):
    one = {"object id": "1", "processing": {"responsible institute": "Lab", "tool": [""]}}
    rows = read_activity_json(spark, write(tmp_path / "p.json", " \n" + json.dumps(one)))
    store = ProcessStore(spark, str(tmp_path / "store"))
    store.push(rows)
    assert [(r.refersTo, r.tool) for r in store.activities().collect()] == [("1", None)]


@pytest.mark.parametrize("text", ["[{", "not json"])
def test_what_is_not_json_fails(spark, tmp_path, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        read_activity_json(spark, write(tmp_path / "p.json", text)).collect()


# -- pushes that are whole or not there -----------------------------------------------------------


def held(store):
    facts = store.facts()
    return [tuples(getattr(facts, name)) for name in ("records", "authored", "person")]


def test_a_push_that_ends_half_way_leaves_the_state_before(spark, tmp_path, monkeypatch):
    store = ObjectStore(spark, str(tmp_path / "store"), buckets=4)
    store.push_csv(objects_file(tmp_path, "a.csv", "1,Map,t,,Doe (V:1),w,p"))
    before = held(store)
    second = objects_file(tmp_path, "b.csv", "2,Map,t2,,Roe (V:2),w,p")

    def broken(version, segments):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(store, "_commit", broken)
    with pytest.raises(RuntimeError):
        store.push_csv(second)
    other = ObjectStore(spark, str(tmp_path / "store"), buckets=4)
    assert held(other) == before and before[0] == [("1", "Map", "t", "w", "p", None)]

    real = filters.built
    monkeypatch.setattr(filters, "built", lambda *_: (_ for _ in ()).throw(RuntimeError("between its writes")))
    with pytest.raises(RuntimeError):
        other.push_csv(second)
    assert held(other) == before
    monkeypatch.setattr(filters, "built", real)
    other.push_csv(second)
    assert [r[0] for r in held(store)[0]] == ["1", "2"]


def test_two_pushes_at_once_leave_a_set(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    slow, quick = ObjectStore(spark, path, buckets=4), ObjectStore(spark, path, buckets=8)
    first = objects_file(tmp_path, "a.csv", "1,Map,t,,Doe (V:1); Roe (V:2),w,p", "2,Map,u,,,w,p")
    second = objects_file(tmp_path, "b.csv", "1,Map,t,,Doe (V:1),w,p", "3,Map,v,,,w,p")
    commit, tried = slow._commit, []

    def late(version, segments):
        if not tried:
            quick.push_csv(second)
        tried.append(version)
        return commit(version, segments)

    monkeypatch.setattr(slow, "_commit", late)
    slow.push_csv(first)
    assert tried == [1, 2] and slow.log.versions() == [1, 2]
    records, authored, person = held(slow)
    assert [r[0] for r in records] == ["1", "2", "3"]
    assert authored == [("1", "V:1"), ("1", "V:2")] and person == [("V:1", "Doe"), ("V:2", "Roe")]
    # Nothing of the lost try is left.
    assert len(list((tmp_path / "store" / "records").iterdir())) == 2
    slow.compact()
    assert len(slow._segments()[1]) == 1 and held(slow) == [records, authored, person]


def test_only_one_of_two_commits_gets_a_version(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.read() == (0, None)
    assert log.commit(1, {"a": 1}) and not log.commit(1, {"a": 2}) and log.commit(2, {"a": 3})
    assert log.read() == (2, {"a": 3}) and log.read(1) == (1, {"a": 1})
    assert log.versions() == [1, 2]


def test_a_push_reads_only_buckets_that_may_hold_its_facts(spark, tmp_path, monkeypatch):
    store = ObjectStore(spark, str(tmp_path / "store"), buckets=32)
    lines = [f"{i},Map,t{i},,Doe (V:{i}),w,p" for i in range(500)]
    store.push_csv(objects_file(tmp_path, "a.csv", *lines))
    read = []
    wanted = store.buckets_of
    monkeypatch.setattr(store, "buckets_of", lambda *a: read.append(wanted(*a)) or read[-1])
    store.push_csv(objects_file(tmp_path, "b.csv", "7,Map,t7,,Doe (V:7),w,p"))
    assert {table: len(folders) for table, folders in read[-1].items()} == {"records": 1, "authored": 1, "person": 1}
    files = store.held(facts_of_csv(store, "7,Map,t7,,Doe (V:7),w,p", tmp_path), store._segments()[1]).records.inputFiles()
    assert len(files) == 1
    assert store.log.versions() == [1]  # nothing new, so no version
    fresh = [f"x{i},Map,t,,New (N:{i}),w,p" for i in range(20)]
    store.push_csv(objects_file(tmp_path, "c.csv", *fresh))
    assert sum(map(len, read[-1].values())) <= 6  # of 96: a key that is not there looks as if it were once in a hundred
    assert store.facts().records.count() == 520
    monkeypatch.setattr(ObjectStore, "ASKED", 0)  # every bucket that has any of the keys
    store.push_csv(objects_file(tmp_path, "d.csv", *lines, *fresh))
    assert store.facts().records.count() == 520 and store.facts().person.count() == 520


def facts_of_csv(store, line, tmp_path):
    raw = read_object_csv(store.spark, objects_file(tmp_path, "one.csv", line))
    return facts_of(clean_objects(raw.withColumn("source", F.lit(0))))


def test_a_reset_is_a_version_of_its_own(spark, tmp_path):
    store = ProcessStore(spark, str(tmp_path / "store"))
    path = write(tmp_path / "p.json", DOCUMENTS)
    store.push_json(path)
    stored = tuples(store.activities())
    store.reset()
    assert store.activities().count() == 0 and store.log.versions() == [1, 2]
    store.push_json(path)
    assert tuples(store.activities()) == stored


def test_a_failed_process_push_is_not_there(spark, tmp_path, monkeypatch):
    store = ProcessStore(spark, str(tmp_path / "store"))
    path = write(tmp_path / "p.json", DOCUMENTS)
    store.push_json(path)
    stored = tuples(store.activities())
    monkeypatch.setattr(store.log, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        store.push_json(path)
    assert tuples(ProcessStore(spark, str(tmp_path / "store")).activities()) == stored


# -- a stream that remembers its facts ------------------------------------------------------------


def test_a_stream_remembers_its_facts_over_restarts(spark, tmp_path, monkeypatch):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    store = ObjectStore(spark, str(tmp_path / "objects"), buckets=4)
    monkeypatch.setattr(ObjectStore, "held", lambda *_: pytest.fail("the store is read"))
    lines = ["1,Map,t,,Doe (V:1); Roe (V:2),w,p", "1,Map,t,,Doe (V:1),w,p", "2,Map,,,broken,w,"]
    objects_file(landing, "a.csv", *lines)
    follow_new_objects(spark, str(landing), store, progress).awaitTermination()
    wanted = [
        [("1", "Map", "t", "w", "p", None), ("2", "Map", None, "w", None, None)],
        [("1", "V:1"), ("1", "V:2")], [("V:1", "Doe"), ("V:2", "Roe")],
    ]
    assert held(store) == [sorted(rows, key=repr) for rows in wanted]
    objects_file(landing, "b.csv", *lines)
    objects_file(landing, "c.csv", *lines, "3,Map,t,,Doe (V:1),w,p")
    follow_new_objects(spark, str(landing), store, progress).awaitTermination()
    records, authored, person = held(store)
    assert len(records) == 3 and len(authored) == 3 and person == [("V:1", "Doe"), ("V:2", "Roe")]

    store.append(facts_of_stream(fact_stream(read_object_csv(spark, str(landing / "c.csv")))), label="x", stream=store._segments()[1][0]["stream"])
    store.append(facts_of_stream(fact_stream(read_object_csv(spark, str(landing / "c.csv")))), label="x", stream=store._segments()[1][0]["stream"])
    assert len([s for s in store._segments()[1] if s["label"] == "x"]) == 1  # a batch again replaces its first try
    with pytest.raises(ValueError, match="stream"):
        store.push_csv(str(landing / "a.csv"))
    with pytest.raises(ValueError, match="own"):
        store.append(facts_of_stream(fact_stream(read_object_csv(spark, str(landing / "c.csv")))), label="y", stream="another")


def test_facts_of_a_stream_are_those_of_a_push(spark, tmp_path):
    raw = read_object_csv(spark, objects_file(
        tmp_path, "a.csv", "1,Map,t,,Doe (V:1); (V:2); nobody,w,p", "2,Nope,t,,Doe (V:9),w,p", ",Map,t,,Doe (V:8),w,p", "3, nautical chart ,,,,,",
    ))
    pushed, streamed = facts_of(clean_objects(raw.withColumn("source", F.lit(0)))), facts_of_stream(fact_stream(raw))
    for name in ("records", "authored", "person"):
        assert tuples(getattr(streamed, name).distinct()) == tuples(getattr(pushed, name).drop("source"))
