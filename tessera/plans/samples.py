"""The model's raw input, derived from the tables under test.

Three object sources and two process sources with gaps, conflicts, misspelt classes, nameless
authors, dangling references and invalid activities. Which row gets which flaw follows from its
own columns. Every row of the tables used yields a raw row.

* a line item is a row about its part, authored by its supplier; the return flag picks the source;
* an order is a row about its customer, mostly without an author; the status picks the source;
* an event is an activity on a part or a customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.activities import activities_from, unpivot_activities
from tessera.operators.objects import Facts, facts_from
from tessera.sources.store import kept_facts

OBJECT_SOURCES, ACTIVITY_SOURCES = (1, 2, 3), (1, 2)

_PART_ROWS = (
    "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS source",
    'CAST(l_partkey AS STRING) AS identifier',
    """
    CASE
      WHEN l_returnflag = 'R' AND p_brand = 'Brand#7' THEN 'Nauticall chart'
      WHEN p_type = 'ECONOMY' THEN 'Nautical chart'
      WHEN p_type = 'LARGE' THEN ' manuscript plate '
      WHEN p_type = 'MEDIUM' THEN 'PRINTED   volume'
      WHEN p_type = 'PROMO' THEN 'herbarium'
      WHEN p_type = 'SMALL' THEN 'Printed Material'
      ELSE 'Map'
    END AS class
    """,
    """
    CASE
      WHEN p_type = 'SMALL' AND l_returnflag <> 'N' THEN '  '
      WHEN p_type = 'PROMO' AND l_returnflag = 'A' THEN NULL
      WHEN p_type = 'ECONOMY' AND l_returnflag <> 'A' THEN NULL
      WHEN p_type = 'LARGE' AND l_returnflag = 'N' THEN NULL
      WHEN p_brand = 'Brand#3' AND l_returnflag = 'R' AND l_linestatus = 'F' THEN p_name || ' bis'
      ELSE ' ' || p_name || '\t'
    END AS title
    """,
    "CASE WHEN l_returnflag = 'N' THEN CAST(1500 + p_size AS STRING) END AS date",
    """
    CASE
      WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND s_acctbal > 9000 THEN 'unknown hand'
      WHEN l_returnflag = 'N' AND s_acctbal < 3000 THEN ' (S:' || l_suppkey || ')'
      WHEN l_returnflag = 'R' AND l_linestatus = 'O'
        THEN s_name || ' (S:' || l_suppkey || '); Maker, ' || p_type || ' ( M:' || p_brand || ' )'
      ELSE s_name || ' (S:' || l_suppkey || ')'
    END AS hasAuthor
    """,
    """
    CASE
      WHEN l_returnflag = 'N' AND p_size > 25 THEN NULL
      WHEN l_returnflag = 'R' AND p_size > 40 THEN ''
      WHEN l_returnflag = 'A' AND p_size <= 5 THEN NULL
      ELSE p_brand
    END AS owner
    """,
    "CASE WHEN l_returnflag = 'A' AND p_retailprice < 905 THEN NULL ELSE 'Hall ' || p_type END AS place",
)

_CUSTOMER_ROWS = (
    "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS source",
    "'C' || o_custkey AS identifier",
    "CASE WHEN c_nationkey < 12 THEN 'Model' ELSE 'painting ' END AS class",
    "CASE WHEN o_orderstatus = 'O' AND c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS title",
    'CAST(NULL AS STRING) AS date',
    """
    CASE
      WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND c_acctbal < 5000
        THEN '(N:' || c_nationkey || ')'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AND c_acctbal < 1000
        THEN c_name || ' (self)'
    END AS hasAuthor
    """,
    "CASE WHEN o_orderstatus = 'P' AND c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS owner",
    """
    CASE
      WHEN o_orderstatus = 'F' AND c_mktsegment = 'FURNITURE' THEN ' '
      ELSE 'Room ' || c_nationkey
    END AS place
    """,
)

# The same kinds of activity under the names they have in files.
_KINDS = {
    "signup": "acquisition",
    "view": "processing",
    "click": "modelling",
    "purchase": "optimising",
    "error": "exporting",
}

_EVENT_FIELDS = (
    'event_id',
    'event_type',
    'k',
    'CASE WHEN value < 35 THEN 1 ELSE 2 END AS source',
    """
    CASE
      WHEN k >= 95 THEN 'X' || user_id
      WHEN event_type IN ('error', 'click') AND k < 40 THEN 'C' || user_id
      ELSE CAST(user_id AS STRING)
    END AS refersTo
    """,
    "CASE WHEN value > 150 THEN ' ' ELSE ' ' || c_mktsegment || ' ' END AS institute",
    "CASE WHEN value < 10 THEN '' ELSE c_name END AS person",
    """
    CASE
      WHEN event_type = 'signup' AND k < 6 THEN ''
      WHEN event_type = 'signup' AND value < 30 THEN 'Photogrammetry'
      WHEN event_type = 'signup' THEN ' Laser scanning'
      WHEN k BETWEEN 50 AND 54 THEN 'Photogrammetry'
    END AS technique
    """,
    'CAST(CAST(ts AS DATE) AS STRING) AS start',
    "CASE WHEN k >= 10 THEN CAST(date_add(CAST(ts AS DATE), CAST(k DIV 10 AS INT)) AS STRING) ELSE '' END AS end",
    """
    CASE
      WHEN k < 25 THEN CAST(array() AS array<string>)
      WHEN k < 50 THEN array('Blender')
      WHEN k < 75 THEN array('Gimp ', 'Blender', 'Instant Meshes')
      WHEN k < 90 THEN array('Metashape', 'Metashape')
      ELSE array('3DF Zephyr', NULL)
    END AS tool
    """,
)


def table(spark: SparkSession, sf_dir: str, name: str, key: list[str] | None = None) -> DataFrame:
    """A table, spread over the cores if its files split into fewer tasks than there are cores.

    That is so for small tables in a single row group; large ones are read as they are.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if key and rows.rdd.getNumPartitions() < cores:
        return rows.repartition(cores, *key)
    return rows


def raw_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of object files with their source. Part, supplier and customer are joined on keys."""
    lines = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    # Few columns of a supplier are needed and many of a part, so its part is what a line meets last. Lines of a part lie together then.
    of_suppliers = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    of_parts = of_suppliers.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return of_parts.selectExpr(*_PART_ROWS).unionByName(raw_customers(spark, sf_dir))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", ["o_orderkey"])
    customer = table(spark, sf_dir, "customer")
    of_customers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return of_customers.selectExpr(*_CUSTOMER_ROWS)


def facts(spark: SparkSession, sf_dir: str) -> Facts:
    return kept_facts(raw_objects(spark, sf_dir))


def people(spark: SparkSession, sf_dir: str) -> Facts:
    """Facts for queries that read the people of all sources once and nothing else: no table is written."""
    raw = raw_objects(spark, sf_dir)
    return Facts(lambda: facts_from(raw).records, lambda: facts_from(raw).authored, lambda: facts_from(raw).person)


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", ["event_id"])
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    known = events.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
    k = F.get_json_object("props", "$.k").cast("int")
    return known.withColumn("k", k).selectExpr(*_EVENT_FIELDS)


def wide_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with a struct per kind of activity; some purchases export as well."""
    rows = event_fields(spark, sf_dir)
    fields = [
        F.col("institute").alias("responsible institute"),
        F.col("person").alias("responsible person"),
        F.col("tool"),
        F.col("start").alias("start date"),
        F.col("end").alias("end date"),
    ]
    body = F.struct(F.col("technique"), *fields)
    plain = F.struct(F.lit(None).cast("string").alias("technique"), *fields)
    also_exported = (F.col("event_type") == "purchase") & (F.col("k") >= 80)
    kinds = {
        kind: F.when(F.col("event_type") == event, body) for event, kind in _KINDS.items()
    }
    kinds["exporting"] = F.when(also_exported, plain).otherwise(kinds["exporting"])
    return rows.select(
        "source",
        F.col("refersTo").alias("object id"),
        *[column.alias(kind) for kind, column in kinds.items()],
    )


def raw_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_activities(wide_activities(spark, sf_dir))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activities_from(raw_activities(spark, sf_dir))
