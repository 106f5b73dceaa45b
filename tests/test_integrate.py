"""The aggregate form of integration against the rules applied row by row in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tessera import config
from tessera.operators import integrate as joint
from tessera.operators import objects as obj
from tessera.operators import ranges
from tessera.operators.objects import Facts

VALUES = list(config.OBJECT_VALUES)
RECORDS = "source int, identifier string, class string, title string, owner string, place string, date string"
AUTHORED = "source int, identifier string, p_identifier string"
PERSON = "source int, p_identifier string, p_name string"


def facts(spark, records, authored, person):
    return Facts(
        spark.createDataFrame(records, RECORDS),
        spark.createDataFrame(authored, AUTHORED),
        spark.createDataFrame(person, PERSON),
    )


def random_facts(rng, objects, sources=3):
    def maybe(value, gap):
        return None if rng.random() < gap else value

    records, authored, person = set(), set(), set()
    for i in range(objects):
        gap = rng.choice([0.1, 0.4, 0.7])
        kind = rng.choice(["named", "nameless", "mixed", "none"])
        for s in range(1, sources + 1):
            if rng.random() < 0.2:
                continue
            for _ in range(rng.choice([1, 1, 1, 2])):
                records.add(
                    (s, f"o{i}", "Map" if rng.random() < 0.8 else "Model", maybe(f"t{s}{rng.randint(0, 1)}", gap),
                     maybe(f"w{s}", gap), maybe(f"p{s}", gap), maybe(f"d{s}", gap))
                )
            if kind == "none" or rng.random() < 0.4:
                continue
            for _ in range(rng.randint(1, 3)):
                p = rng.randint(1, 5)
                if kind == "nameless" or (kind == "mixed" and rng.random() < 0.5):
                    p += 5
                authored.add((s, f"o{i}", f"a{p}"))
    for s in range(1, sources + 1):
        for p in range(1, 11):
            names = {None} if p > 5 else {rng.choice([None, f"n{p}", f"n{9 - p}"])}
            if p <= 5 and rng.random() < 0.3:
                names.add(f"m{rng.randint(1, 3)}")
            if p == 6 and s == 1:
                names.add("late name")
            person |= {(s, f"a{p}", name) for name in names}
    return sorted(records, key=repr), sorted(authored), sorted(person, key=repr)


def by_rows(records, authored, person):
    """Settle, join, sort, fill backwards, mark duplicates, validate, list authors."""
    settled = {}
    for s, i, *values in records:
        old = settled.get((s, i), [None] * 5)
        settled[s, i] = [min((x for x in pair if x is not None), default=None) for pair in zip(old, values)]
    rows = []
    for (s, i), values in settled.items():
        links = [
            (p, name)
            for (s2, i2, p) in authored if (s2, i2) == (s, i)
            for (s3, p3, name) in person if (s3, p3) == (s, p)
        ]
        for p, name in links or [(None, None)]:
            rows.append({"i": i, "v": list(values) + [p, name], "order": (name is None, name or "", s, p is None, p or "")})
    result = {}
    for i in {r["i"] for r in rows}:
        group = sorted((r for r in rows if r["i"] == i), key=lambda r: r["order"])
        later = [None] * 7
        for row in reversed(group):
            later = [a if a is not None else b for a, b in zip(row["v"], later)]
            row["v"] = later
        seen = set()
        for row in group:
            *values, p, name = row["v"]
            first = p not in seen
            seen.add(p)
            if first and None not in values[1:4] and (p is None) == (name is None):
                entity = result.setdefault(i, (values, []))
                if p is not None:
                    entity[1].append((p, name))
    flat = []
    for i, (values, authors) in result.items():
        flat += [(i, *values, *author) for author in authors or [(None, None)]]
    return sorted(flat, key=repr)


@pytest.mark.parametrize("seed", range(8))
def test_objects_as_if_row_by_row(spark, seed):
    data = random_facts(random.Random(seed), objects=150, sources=3 + seed % 3)
    result = joint.to_objects(facts(spark, *data))
    assert tuples(result.select("identifier", *VALUES, "p_identifier", "p_name")) == by_rows(*data)


def test_row_steps_reach_the_same(spark):
    data = random_facts(random.Random(99), objects=120)
    stored = facts(spark, *data)
    rows = obj.object_rows(stored, settled=True)
    for c in joint.ROW_ORDER:
        rows = rows.withColumn(f"o_{c}", F.col(c))
    order = [f"o_{c}" for c in joint.ROW_ORDER]
    filled = joint.backfill(rows, "identifier", order, [*VALUES, "p_identifier", "p_name"])
    kept = joint.keep_first(filled, ["identifier", "p_identifier"], order, joint.is_valid_object())
    authors = kept.filter(F.col("p_identifier").isNotNull()).select("identifier", "p_identifier", "p_name")
    expected = [(r[0], r[6], r[7]) for r in by_rows(*data) if r[6] is not None]
    assert tuples(authors) == sorted(expected, key=repr)


@pytest.mark.parametrize("names", ["mixed", "alike", "none"])
def test_backfill_across_stretches(spark, names):
    rng = random.Random(len(names))
    name = {"mixed": lambda: rng.choice([None, f"n{rng.randint(0, 40):02d}"]), "alike": lambda: f"Supplier#0000{rng.randint(0, 99)}"}
    data = [
        (rng.choice(["hot", "hot", "warm", f"k{i}", None]), name.get(names, lambda: None)(), i,
         rng.choice([None, None, f"a{i}"]), rng.choice([None, f"b{i}"]))
        for i in range(400)
    ]
    rows = spark.createDataFrame(data, "k string, name string, i int, a string, b string")
    expected, later = [], {}
    for k, name, i, a, b in sorted(data, key=lambda r: (r[0] or "", r[1] is None, r[1] or "", r[2]), reverse=True):
        seen = later.setdefault(k, [None, None])
        seen[:] = [new if new is not None else old for new, old in zip((a, b), seen, strict=True)]
        expected.append((k, name, i, *seen))
    filled = joint.backfill(rows, "k", ["name", "i"], ["a", "b"])
    assert tuples(filled) == sorted(expected, key=repr)
    assert tuples(filled) != tuples(rows)


@pytest.mark.parametrize("name", ["concat('Supplier#', lpad(id, 9, '0'))", "cast(null as string)"])
def test_one_key_goes_over_all_stretches(spark, name):
    rows = spark.range(40_000).selectExpr("'hot' as k", f"{name} as name", "id as i")
    placed = ranges.in_stretches(rows, "k", [F.col("name").asc_nulls_last(), F.col("i").asc_nulls_last()], stretches=8)
    sizes = [r["count"] for r in placed.groupBy(ranges.STRETCH).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8


def test_a_key_in_one_stretch_has_nothing_to_carry(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("b", 0, 5), ("b", 1, 7), (None, 1, 2), (None, 2, 3)], f"k string, {ranges.STRETCH} int, n int")
    assert tuples(ranges.rows_before(rows, "k")) == [("b", 0, 0), ("b", 1, 5), (None, 1, 0), (None, 2, 2)]


def flat_objects(spark, counts):
    rows = [
        (f"o{i}", "Map", "t", "w", "p", None, f"a{j}" if n else None, f"n{n - j:04d}" if n else None)
        for i, n in enumerate(counts) for j in range(max(n, 1))
    ]
    return spark.createDataFrame(
        rows, "identifier string, class string, title string, owner string, place string, date string,"
        "p_identifier string, p_name string"
    )


def test_nested_authors_in_order_of_name(spark):
    nested = {r.identifier: r for r in joint.nest_authors(flat_objects(spark, [0, 3])).collect()}
    assert nested["o0"].authors == []
    assert [tuple(a) for a in nested["o1"].authors] == [("a2", "n0001"), ("a1", "n0002"), ("a0", "n0003")]
    assert {r.part for r in nested.values()} == {0}


def test_a_long_list_of_authors_is_continued(spark):
    nested = joint.nest_authors(flat_objects(spark, [0, 3, 450]), list_rows=100).collect()
    assert sorted(r.identifier for r in nested) == ["o0", "o1"] + ["o2"] * 5
    parts = sorted((r.part, [a.name for a in r.authors]) for r in nested if r.identifier == "o2")
    assert [len(names) for _, names in parts] == [100, 100, 100, 100, 50]
    assert [name for _, names in parts for name in names] == [f"n{j:04d}" for j in range(1, 451)]


def test_very_many_authors_of_one_object(spark):
    """A million authors are numbered in several tasks, and their parts make up the sorted list."""
    n = 1_000_000
    values = [f"'{v}' as {c}" for c, v in zip(VALUES, ("Map", "t", "w", "p", "d"), strict=True)]
    flat = spark.range(n, numPartitions=8).selectExpr(
        "'o' as identifier", *values, "concat('a', id) as p_identifier", f"lpad((id * 7919) % {n}, 7, '0') as p_name"
    )
    nested = joint.nest_authors(flat, list_rows=150_000).select(
        "part", F.size("authors").alias("n"), F.col("authors")[0]["name"].alias("first"), F.element_at("authors", -1)["name"].alias("last"),
        (F.array_sort("authors.name") == F.col("authors.name")).alias("ordered"),
    )
    parts = [tuple(r) for r in nested.orderBy("part").collect()]
    assert parts == [
        (k, min(150_000, n - k * 150_000), f"{k * 150_000:07d}", f"{min(n, (k + 1) * 150_000) - 1:07d}", True) for k in range(7)
    ]


def test_people_take_the_smallest_name(spark):
    rows = spark.createDataFrame(
        [("p", None), ("p", "b"), ("p", "a"), ("q", None)], "identifier string, name string"
    )
    assert tuples(joint.to_people(rows)) == [("p", "a")]


def test_one_id_with_many_names_on_many_objects(spark):
    """Names are reduced before they meet the objects, so no pairs of the two arise."""
    n = 300
    stored = facts(
        spark,
        [(1, f"{i}", "Map", "t", "w", "p", None) for i in range(n)],
        [(1, f"{i}", "a") for i in range(n)],
        [(1, "a", f"name {j:03d}") for j in range(n)] + [(1, "a", None)],
    )
    assert stored.name_spans().count() == n
    assert {r.p_name for r in joint.to_objects(stored).collect()} == {"name 000"}
    assert obj.people_behind(stored, [str(i) for i in range(n)]).count() == n + 1


def small(spark):
    return facts(
        spark,
        [(1, "1", "Map", "t", "w", "p", None), (2, "1", "Map", None, None, "p", "d"), (2, "2", "Map", None, "w", "p", None)],
        [(1, "1", "a"), (2, "1", "b"), (2, "2", "a")],
        [(1, "a", "Anna"), (2, "a", None), (2, "b", "Bert")],
    )


def test_values_are_never_filled_from_earlier_rows(spark):
    """Bert's row sorts last and his source has no title, so he is lost."""
    assert tuples(joint.to_objects(small(spark))) == [("1", "Map", "t", "w", "p", "d", "a", "Anna")]


def test_filter_by_author_sees_only_sources_that_know_the_link(spark):
    stored = small(spark)
    within = obj.authored_by(stored, "a")
    got = tuples(joint.to_objects(stored, within))
    assert got == [("1", "Map", "t", "w", "p", None, "a", "Anna")]
    assert tuples(joint.to_objects(stored, within)) == tuples(
        joint.to_objects(stored.within(within))
    )


def test_no_ids_no_objects(spark):
    stored = small(spark)
    none = spark.createDataFrame([], "identifier string")
    assert tuples(joint.to_objects(stored, none)) == []
    assert tuples(obj.authors_of(stored, [])) == []
    assert tuples(obj.object_rows(stored.within(none))) == []


def test_entity_by_id(spark):
    stored = small(spark)
    got = joint.entity_by_id(stored, ["1", "2", "a", "b", "x"])
    assert sorted((r.kind, r.identifier, r.p_name) for r in got.collect()) == [
        ("CHO", "1", "Anna"), ("Person", "a", "Anna"), ("Person", "b", "Bert"),
    ]


def test_conflicting_values_multiply_in_the_view_only(spark):
    stored = facts(
        spark,
        [(1, "35", "Map", "t", "w1", "p1", "1614"), (1, "35", "Model", "t", "w2", "p2", "1991"),
         (2, "35", "Map", "t", None, None, None)],
        [(1, "35", "a"), (1, "35", "b")],
        [(1, "a", "Anna"), (1, "b", "Bert")],
    )
    counts = {r.source: r["count"] for r in obj.object_rows(stored).groupBy("source").count().collect()}
    assert counts == {1: 2 * 2 * 2 * 2 * 2, 2: 1}
    assert len(joint.to_objects(stored).collect()) == 2


def test_activities_keep_only_valid_objects(spark):
    stored = small(spark)
    activities = spark.createDataFrame(
        [("Processing", i, None, "inst", None, "2024", None, ["x"]) for i in ("1", "1", "2", "9")],
        "class string, refersTo string, technique string, institute string, person string,"
        "start string, end string, tool array<string>",
    )
    got = joint.to_activities(activities, joint.object_entities(stored)).collect()
    assert [(r.refersTo, r.object.title) for r in got] == [("1", "t"), ("1", "t")]


def test_triples_are_a_set(spark):
    stored = small(spark)
    once, twice = tuples(obj.triples(stored)), tuples(obj.triples(stored.union(stored)))
    assert once == twice
    assert (1, "loc:CHO-1", "dc:creator", "loc:Person-a") in once
    assert (2, "loc:Person-a", "foaf:name", "") in once


def test_select_only_is_per_object_and_class(spark):
    stored = facts(
        spark, [(1, "1", "Map", "t", None, None, None), (1, "1", "Model", None, None, None, None)], [], []
    )
    assert tuples(obj.select_only(stored, "title")) == [("t",), ("t",)]
    assert tuples(obj.select_only(stored, "owner")) == [(None,), (None,)]
    assert tuples(obj.select_only(stored, "identifier")) == [("1",), ("1",)]


def test_result_orders(spark):
    flat = flat_objects(spark, [1, 1, 2])
    ids = flat.withColumn("identifier", F.element_at(F.create_map(*[F.lit(x) for x in ("o0", "alo", "o1", "10", "o2", "9")]), F.col("identifier")))
    got = [(r.identifier, r.p_name) for r in joint.order_objects(ids).collect()]
    assert got == [("9", "n0001"), ("9", "n0002"), ("10", "n0001"), ("alo", "n0001")]
