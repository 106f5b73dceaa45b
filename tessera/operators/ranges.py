"""Scans along the order of each key, with no key in one task.

Rows are dealt to tasks by ranges of (key, order), so a key with very many rows goes over several stretches, each of which is in one
task and as large as any other. What a scan needs to know of the stretches before or after its own is a row per key and
stretch, and only for keys that go over more than one, of which each border between stretches makes one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.folders import kept

STRETCH = "_stretch"


def in_stretches(rows: DataFrame, key: str, order: list[Column], stretches: int | None = None) -> DataFrame:
    """The rows with the number of their stretch; a later one holds later rows.

    Written, as the borders follow from a sample of the rows: all that builds on them has to see the same ones. How many
    there are is the session's number of shuffle partitions.
    """
    stretches = stretches or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(stretches, F.col(key).asc_nulls_first(), *order)
    return kept(placed.withColumn(STRETCH, F.spark_partition_id()), "stretches")


def across_stretches(per_stretch: DataFrame, key: str) -> DataFrame:
    """Of rows per key and stretch those of keys that go over several."""
    several = per_stretch.groupBy(F.col(key).alias("_several")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return per_stretch.join(several, F.col(key).eqNullSafe(F.col("_several")), "left_semi")


def from_later(per_stretch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """What the nearest later stretch with a value offers: the key, ``_of`` (a stretch), ``_next_`` and each column."""
    later = Window.partitionBy(key).orderBy(F.col(STRETCH).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return across_stretches(per_stretch, key).select(
        F.col(key).alias("_key"),
        F.col(STRETCH).alias("_of"),
        *[F.last(c, ignorenulls=True).over(later).alias(f"_next_{c}") for c in columns],
    )


def rows_before(per_stretch: DataFrame, key: str) -> DataFrame:
    """How many rows (``n``) of the key are in earlier stretches: the key, ``_of`` (a stretch), ``_before``."""
    earlier = Window.partitionBy(key).orderBy(STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return across_stretches(per_stretch, key).select(F.col(key).alias("_key"), F.col(STRETCH).alias("_of"), before.alias("_before"))


def beside(rows: DataFrame, told: DataFrame, key: str) -> DataFrame:
    """The rows with what is told of their key and stretch, if anything."""
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(STRETCH) == F.col("_of"))
    return rows.join(told, same, "left").drop("_key", "_of")
