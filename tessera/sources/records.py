"""Records of large files that no single character ends, found by all tasks at once.

A record ends at a certain character (the brace of a document, the break of a line) only outside of quotes and outside of all
brackets, which depends on everything before. Spark's text reader cuts a file at every such character, each block of the file in a
task of its own. What a piece does to the state, from either state that it may start in, combines over pieces and then over
blocks, a row per block, so each block learns how it starts without anybody reading the file from its beginning.
Pieces are put together within their block; only the first and last record of a block go on to meet those of its neighbours.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Effect:
    """What a piece does, with the character that ends it: whether quotes are open after it, and by how many brackets the
    depth rises, each for a piece that starts outside of quotes and for one that starts inside."""

    from_out: Column
    from_in: Column
    rise_out: Column
    rise_in: Column

    def columns(self) -> list[Column]:
        return [getattr(self, n).alias(n) for n in _EFFECT]


_EFFECT = ("from_out", "from_in", "rise_out", "rise_in")
_PLACE = ["file", "block"]


def _earlier(keys: list[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _up_to(keys: list[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_states(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``if_out`` and ``if_in``: whether quotes are open before a row, if the key starts outside, or inside of them.

    A row keeps the state, swaps it, or sets it whatever it was; so the state is that of the last row that set
    it, or else the first one, swapped as often as rows have done so since.
    """
    swaps = F.col("from_out") & ~F.col("from_in")
    sets = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("state"), "swaps"))
    counted = rows.withColumn("swaps", F.sum(swaps.cast("long")).over(_up_to(keys, order)))
    known = counted.withColumn("set", F.last(sets, ignorenulls=True).over(_earlier(keys, order)))
    known = known.withColumn("before", F.coalesce(F.last("swaps").over(_earlier(keys, order)), F.lit(0)))
    odd = (F.col("before") - F.coalesce(F.col("set.swaps"), F.lit(0))) % 2 == 1
    states = [(F.coalesce(F.col("set.state"), F.lit(start)) != odd).alias(n) for n, start in (("if_out", False), ("if_in", True))]
    return known.select(*rows.columns, *states)


def _after(state: str) -> Column:
    return F.when(F.col(state), F.col("from_in")).otherwise(F.col("from_out"))


def _rise(state: str) -> Column:
    return F.when(F.col(state), F.col("rise_in")).otherwise(F.col("rise_out"))


def _pieces(spark: SparkSession, path: str | list[str], end: str, effect: Callable[[Column], Effect]) -> DataFrame:
    """The pieces of files, numbered (``nth``) within their block, with their effects and states."""
    meta = F.col("_metadata")
    rows = spark.read.text(path, lineSep=end).select(
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
        meta["file_size"].alias("size"),
        # A block is read in order and by one task, so this follows the order of its pieces.
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    rows = rows.select("*", *effect(F.col("value")).columns())
    return _with_states(rows.withColumn("nth", F.row_number().over(Window.partitionBy(*_PLACE).orderBy("at"))), _PLACE, "at")


def _blocks(pieces: DataFrame) -> DataFrame:
    """A row per block: how it starts (``open``, ``depth``), the file's ``opening`` (its first piece that is not
    blank: place, first character and last one), and the number of the file's last piece where no character ends that (``loose``)."""
    written = F.col("value").rlike(r"\S")
    first = F.struct(
        "block", "nth", F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1).alias("sign"), F.substring("value", -1, 1).alias("stop")
    )
    whole = pieces.groupBy(*_PLACE).agg(
        F.max_by(_after("if_out"), "at").alias("from_out"),
        F.max_by(_after("if_in"), "at").alias("from_in"),
        F.sum(_rise("if_out")).alias("rise_out"),
        F.sum(_rise("if_in")).alias("rise_in"),
        F.max("nth").alias("last"),
        F.max("size").alias("size"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.min(F.when(written, first)).alias("opening"),
    )
    file = Window.partitionBy("file")
    # The reader leaves out a byte order mark of three bytes.
    ends_loose = (F.sum("bytes").over(file) - F.col("size")).isin(1, -2) & (F.col("block") == F.max("block").over(file))
    return (
        _with_states(whole, ["file"], "block")
        .withColumnRenamed("if_out", "open")
        .select(
            *_PLACE,
            "open",
            F.coalesce(F.sum(_rise("open")).over(_earlier(["file"], "block")), F.lit(0)).alias("depth"),
            F.min("opening").over(file).alias("opening"),
            F.when(ends_loose, F.col("last")).alias("loose"),
        )
    )


def _text(*order: str) -> Column:
    parts = F.array_sort(F.collect_list(F.struct(*order, "text")))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")


def read_records(spark: SparkSession, path: str | list[str], end: str, effect: Callable[[Column], Effect]) -> DataFrame:
    """The records of files, in no order: ``text`` with all that lies between it and the record before.

    ``sign`` is the first character of the file that is not blank and ``stop`` the one before the ``end`` that follows it;
    ``leads`` tells whether the record holds it, ``ended`` whether it ends as
    records do (what follows a file's last record does not), ``final`` whether nothing follows it in its file.

    Compressed files are read by one task each. A record is one value, so below 2 GB.
    """
    pieces = _pieces(spark, path, end, effect)
    rows = pieces.join(_blocks(pieces).alias("b"), _PLACE)
    rows = rows.withColumn("state", F.when(F.col("open"), F.col("if_in")).otherwise(F.col("if_out")))
    depth = F.col("depth") + F.sum(_rise("state")).over(_up_to(_PLACE, "nth"))
    loose = F.coalesce(F.col("nth") == F.col("loose"), F.lit(False))
    rows = rows.withColumn("ended", ~_after("state") & (depth == 0) & ~loose)
    rows = rows.withColumn("number", F.coalesce(F.sum(F.col("ended").cast("long")).over(_earlier(_PLACE, "nth")), F.lit(0)))
    rows = rows.withColumn("text", F.when(loose, F.col("value")).otherwise(F.concat("value", F.lit(end))))
    leads = (F.col("opening.block") == F.col("block")) & (F.col("opening.nth") == F.col("nth"))
    in_block = rows.groupBy(*_PLACE, "number").agg(
        _text("nth"),
        F.max("ended").alias("ended"),
        F.max(F.coalesce(leads, F.lit(False))).alias("leads"),
        F.max("opening.sign").alias("sign"),
        F.max("opening.stop").alias("stop"),
    )
    in_block = in_block.withColumn("last", F.max("number").over(Window.partitionBy(*_PLACE)))
    at_border = (F.col("number") == 0) | (F.col("number") == F.col("last"))
    found = ["file", "sign", "stop", "leads", "ended", "final", "text"]
    inner = in_block.filter(~at_border).withColumn("final", F.lit(False)).select(*found)
    # Two rows a block at most.
    borders = in_block.filter(at_border)
    borders = borders.withColumn(
        "record", F.coalesce(F.sum(F.col("ended").cast("long")).over(_earlier(["file"], "block", "number")), F.lit(0))
    )
    borders = borders.withColumn("final", F.col("record") == F.max("record").over(Window.partitionBy("file")))
    met = borders.groupBy("file", "record").agg(
        _text("block", "number"),
        *[F.max(c).alias(c) for c in ("sign", "stop", "leads", "ended", "final")],
    )
    return inner.unionByName(met.select(*found))
