"""Repeated pushes from a folder: each file that lands is pushed once, also across restarts.

The cleaning and validation are those of a single push. A batch that is retried after a failure
changes nothing: object facts are a set, and a batch of activities replaces its own earlier try.
Batches are told apart by the id that a streaming query keeps in its progress folder, so no two
queries, whatever folders they follow, ever replace each other's batches.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera import config
from tessera import functions as fn
from tessera.operators.objects import Facts, clean_objects
from tessera.sources.activity_json import activities_from_documents
from tessera.sources.object_csv import csv_options, drop_long_rows, schema_with_corrupt
from tessera.sources.store import ObjectStore, ProcessStore


def follow_objects(
    spark: SparkSession, folder: str, store: ObjectStore, progress: str, multiline: bool = True
) -> StreamingQuery:
    """Push the object files that are in the folder now and were not pushed before.

    ``progress`` is a folder of this query's own, on storage that outlives the session.
    ``multiline`` as in ``read_object_csv``.
    """
    rows = spark.readStream.schema(schema_with_corrupt()).options(**csv_options(multiline)).csv(folder)

    def push(batch: DataFrame, _: int) -> None:
        # Three tables are derived from the batch.
        landed = drop_long_rows(batch).persist()
        try:
            store.push(landed)
        finally:
            landed.unpersist()

    return _start(rows, push, progress)


def follow_new_objects(
    spark: SparkSession, folder: str, store: ObjectStore, progress: str, multiline: bool = True
) -> StreamingQuery:
    """Like ``follow_objects``, but the query itself remembers the facts that it has seen, so no batch reads the store.

    The facts of all files are one stream, without those seen before (the state keeps each distinct fact, on disk where
    the session's state store is RocksDB, and so grows with the store itself; there is no time after which a fact could not come
    again). What remains is added as it is. The store has to be this query's own: pushes of others are refused, and so is a store that holds
    any. A batch that is tried again replaces what its first try added.
    """
    rows = spark.readStream.schema(schema_with_corrupt()).options(**csv_options(multiline)).csv(folder)
    seen = fact_stream(drop_long_rows(rows)).dropDuplicates()

    def add(batch: DataFrame, number: int) -> None:
        query = _query_id(spark, progress)
        landed = batch.persist()
        try:
            store.append(facts_of_stream(landed), label=f"{query}-{number}", stream=query)
        finally:
            landed.unpersist()

    return _start(seen, add, progress)


def fact_stream(raw: DataFrame) -> DataFrame:
    """Raw object rows as facts, a row each: kind and the columns of all three tables, null where a table lacks them."""
    cleaned = clean_objects(raw.withColumn("source", F.lit(0)))
    cells = F.coalesce(F.split("hasAuthor", config.OBJECT["hasAuthor"].separator), F.array().cast("array<string>"))
    # A row for the record, without a cell, and one for each author's cell.
    cells = F.concat(F.array(F.lit(None).cast("string")), cells)
    rows = cleaned.select(*config.OBJECT_COLUMNS, F.posexplode(cells).alias("number", "cell"))
    rows = fn.parse_authors(rows, "cell").filter((F.col("number") == 0) | F.col("p_identifier").isNotNull())
    nothing = F.lit(None).cast("string")

    def fact(kind: str, *columns: str) -> Column:
        every = (*config.OBJECT_COLUMNS, *config.AUTHOR_COLUMNS)
        return F.struct(F.lit(kind).alias("kind"), *[(F.col(c) if c in columns else nothing).alias(c) for c in every])

    told = F.when(F.col("number") == 0, F.array(fact("records", *config.OBJECT_COLUMNS))).otherwise(
        F.array(fact("authored", "identifier", "p_identifier"), fact("person", *config.AUTHOR_COLUMNS))
    )
    return rows.select(F.explode(told).alias("fact")).select("fact.*")


def facts_of_stream(rows: DataFrame) -> Facts:
    """The three tables of rows as ``fact_stream`` gives them."""

    def table(kind: str, *columns: str) -> DataFrame:
        return rows.filter(F.col("kind") == kind).select(*columns)

    return Facts(
        lambda: table("records", *config.OBJECT_COLUMNS),
        lambda: table("authored", "identifier", "p_identifier"),
        lambda: table("person", "p_identifier", "p_name"),
    )


def follow_activities(
    spark: SparkSession, folder: str, store: ProcessStore, progress: str
) -> StreamingQuery:
    """Push the activity files, one document per line, that were not pushed before."""
    lines = spark.readStream.text(folder).filter(F.trim("value") != "")
    documents = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    rows = lines.select(documents.alias("document"))

    def push(batch: DataFrame, number: int) -> None:
        store.push(activities_from_documents(batch), label=f"{_query_id(spark, progress)}-{number}")

    return _start(rows, push, progress)


def _query_id(spark: SparkSession, progress: str) -> str:
    """The id that Spark wrote to the progress folder when the query first started."""
    return json.loads(spark.read.text(f"{progress}/metadata").first()["value"])["id"]


def _start(rows: DataFrame, push, progress: str) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(push).option("checkpointLocation", progress)
    return writer.trigger(availableNow=True).start()
