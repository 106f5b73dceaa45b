"""Some registered queries against their SQL, and what no plan may contain."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tessera.plans.catalog import QUERIES
from tessera.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = [
    "a4_metadata_push_set", "a5_process_push_bag", "a10_triples", "b6_parse_author", "b9_rename_fields", "b11_valid_activities", "b12_key_case",
    "c1_by_identifier", "c4_tool_filter", "d2_object_values", "d3_object_rows", "d11_authors_acquired_between", "f2_keep_first",
    "h1_union_sources", "h2_union_facts", "m2_all_objects", "c9_relation_paths", "d12_entity_by_id", "e2_nested_authors",
    "f1_backfill", "l1_people", "l2_objects", "m8_using_tool", "m12_objects_of_activities",
]
# TEST_QUERIES=all compares every query of the catalog, or those named with commas between.
CHOSEN = os.environ.get("TEST_QUERIES", ",".join(SAMPLE))
COMPARED = sorted(QUERIES) if CHOSEN == "all" else CHOSEN.split(",")

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def texts(rows):
    return sorted(tuple("" if v is None or v != v else str(v) for v in row) for row in rows)


def test_every_query_of_the_catalog_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@needs_tables
@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    wanted = con.execute(oracle_sql()[name]).df()
    assert sorted(wanted.columns) == columns
    rows = wanted[columns].astype(object).itertuples(index=False, name=None)
    assert texts(got.select(*columns).collect()) == texts(rows)


@needs_tables
@pytest.mark.parametrize("name", ["d8_activities_by_author", "l2_objects", "d10_objects_by_institution"])
def test_plans_have_no_pairs_and_no_python(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert bad not in plan


@needs_tables
@pytest.mark.parametrize("name", ["d3_object_rows", "c1_by_identifier", "d2_object_values", "l2_objects"])
def test_raw_tables_are_not_read_again_by_the_views(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders" not in plan
