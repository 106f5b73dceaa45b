"""What shuffles and tables leave on disk while a query goes on, and that results don't depend on it."""

import os
import random
import time

from pyspark.sql import functions as F

from conftest import tuples
from tessera.operators import objects as obj
from tessera.operators.objects import Facts
from tessera.session import ensure_checkpoint_dir
from tessera.sources.folders import kept
from tessera.sources.store import kept_facts

SCHEMAS = (
    "source int, identifier string, class string, title string, owner string, place string, date string",
    "source int, identifier string, p_identifier string",
    "source int, p_identifier string, p_name string",
)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def raw_rows(spark, n=300):
    rng = random.Random(n)
    rows = [
        (rng.randint(1, 3), f"o{rng.randint(0, 40)}", rng.choice(["Map", "Model"]), rng.choice([None, "t", "u"]),
         rng.choice([None, "1500"]), "; ".join(f"{rng.choice(['', 'x', 'y', 'z'])} (A:{rng.randint(0, 9)})" for _ in range(rng.randint(0, 3))),
         rng.choice([None, "w"]), rng.choice([None, "p", "q"]))
        for _ in range(n)
    ]
    return spark.createDataFrame(
        rows, "source int, identifier string, class string, title string, date string, hasAuthor string, owner string, place string"
    )


def test_a_kept_table_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").agg(F.sum("id").alias("s"))
    before = shuffle_files(spark)
    table = kept(rows, "sums")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert tuples(table) == tuples(rows)


def test_author_cells_go_once_all_is_made_of_them(spark):
    facts = kept_facts(raw_rows(spark))
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    tables = (facts.authored, facts.person, facts.linked, facts.records)
    assert sorted(d.split("-")[0] for d in set(os.listdir(top)) - before) == ["authored", "linked", "person", "records"]
    plain = obj.facts_from(raw_rows(spark))
    assert [tuples(t) for t in tables if t is not facts.linked] == [tuples(t) for t in (plain.authored, plain.person, plain.records)]
    held, exact = ({(r.source, r.identifier): r.links for r in t.collect()} for t in (facts.linked, plain.linked))
    assert held.keys() == exact.keys() and all(held[k] >= n for k, n in exact.items())


def test_both_kinds_of_objects_share_one_shuffle(spark):
    rows = obj.object_rows(kept_facts(raw_rows(spark)))
    assert rows.count() > 0
    rows.collect()
    assert "ReusedExchange" in rows._jdf.queryExecution().executedPlan().toString()


def test_objects_without_source_or_authors_keep_their_rows(spark):
    records = [(None, "a", "Map", "t", "w", "p", None), (1, "b", "Map", None, "w", "p", None), (1, "c", "Map", "t", "w", "p", "1")]
    tables = (records, [(1, "c", "A:1"), (2, "b", "A:1")], [(1, "A:1", "x")])
    facts = Facts(*map(spark.createDataFrame, tables, SCHEMAS))
    expected = [("a", None), ("b", None), ("c", "x")]
    for how in ({}, {"settled": True}, {"together": True}):
        assert tuples(obj.object_rows(facts, **how).select("identifier", "p_name")) == expected
