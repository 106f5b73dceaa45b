import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tessera.sources.activity_json import read_activity_json, read_documents
from tessera.sources.object_csv import csv_options, drop_long_rows, read_object_csv, schema_with_corrupt


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes, so that records, strings and cells go over their borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "173")
    yield
    for name in names:
        spark.conf.unset(name)


def document(rng, number):
    texts = ['plain', 'quo"te', 'back\\', '\\"', 'brace } {', '[1, {', 'ünï', '', 'x' * rng.randrange(300), '\\\\"}']
    inner = {rng.choice("abc"): rng.choice(texts), "deep": {"er": [{"k": rng.choice(texts)}, {}]}, "n": None}
    return {"object id": str(number), **{k: rng.choice([inner, rng.choice(texts), {}, []]) for k in ("acquisition", "other }")}}


def parsed(rows):
    return sorted((json.loads(r.text) for r in rows.collect()), key=lambda d: int(d["object id"]))


@pytest.mark.parametrize("seed", range(3))
def test_arrays_are_cut_into_their_documents(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    documents = [document(rng, i) for i in range(60)]
    for i, (indent, ascii_only) in enumerate([(None, True), (2, False)]):
        part = documents[i::2]
        listed = [*part[:3], None, *part[3:], None]
        mark = "﻿" if seed == 1 else ""
        end = rng.choice(["", "\n", " \n "])
        (tmp_path / f"{i}.json").write_text(mark + json.dumps(listed, indent=indent, ensure_ascii=ascii_only) + end, encoding="utf-8")
    (tmp_path / "2.json").write_text("[ ]\n")
    (tmp_path / "3.json").write_text("")
    (tmp_path / "4.json").write_text("[null, null]")
    (tmp_path / "5.json").write_text(' {"object id": "60"}\n')
    rows = read_documents(spark, str(tmp_path))
    assert parsed(rows) == [*documents, {"object id": "60"}]


def test_one_large_array_is_in_several_tasks(spark, tmp_path, small_blocks):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([document(random.Random(i), i) for i in range(300)]))
    scanned = spark.read.text(str(path), lineSep="}")
    assert scanned.groupBy(F.spark_partition_id()).count().count() > 4
    assert read_documents(spark, str(path)).count() == 300


@pytest.mark.parametrize(
    "text",
    ['[{"a": "1"}', '[{"a": "1"}}, {"a": "2"}]', '{"a": "1"', '{"a": "1"}, {"a": "2"}', '{"a": "1"} {"a": "2"}', '{"a": "1"}]',
     '[{"a": "1"} {"a": "2"}]', '[{"a": "1"},]', '[[{"a": "1"}]]', '[{"a": "1"}] x', '[{"a": "1}]', '[1, {"a": "1"}]', '"x"'],
)
def test_arrays_that_are_none_fail(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        read_activity_json(spark, str(path)).collect()


def cells(rng):
    texts = ["", "a", 'say "x"', "two\nlines", "three\r\nmore", "a,b", '"', '""', ",\n,", "NA", " padded ", 'in"ner', "ü" * rng.randrange(200)]
    return [rng.choice(texts) for _ in range(7)]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_rows_with_breaks_are_those_of_one_task(spark, tmp_path, small_blocks, ending):
    rng = random.Random(len(ending))
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=ending)
    writer.writerow(["Key", f"Kind{ending}of it", *"abcde"])
    for i in range(150):
        writer.writerow([str(i), *cells(rng)[1:]])
        if i % 20 == 0:
            out.write(ending)
    out.write(f"900,Map,short{ending}901,stray\"quote,x \"y\" z,,,,{ending}902,a,b,c,d,e,f,too long{ending}903,no end of line")
    path = tmp_path / "o.csv"
    path.write_bytes(out.getvalue().encode())
    whole = drop_long_rows(spark.read.schema(schema_with_corrupt()).options(**csv_options(True)).csv(str(path)))
    expected = tuples(whole)
    assert len(expected) == 153
    rows = read_object_csv(spark, str(path))
    assert tuples(rows) == expected
    assert tuples(rows.select("owner")) == sorted([(r[5],) for r in expected], key=repr)
    assert rows.count() == 153


def test_files_keep_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,c\n1,Map,"a\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("\nk,c\n2,Map\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("k,c\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    rows = read_object_csv(spark, str(tmp_path)).select("identifier").collect()
    assert sorted(r[0] for r in rows) == ["1", "2"]
