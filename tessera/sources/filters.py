"""Bloom filters of the keys that stored facts have, as tables: built, kept and asked by Spark alone.

A filter is the set of its words of 64 bits that are not zero, a row each. Which filters may hold a key is a join on the words
that the key's bits are in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key and bits set per key: of the keys that are not there, one in a hundred looks as if it were.
BITS, HASHES = 10, 7


def _bits(key: str, words: Column) -> Column:
    """A row per bit of a key in a filter of so many words."""
    numbers = F.sequence(F.lit(1), F.lit(HASHES))
    return F.explode(F.transform(numbers, lambda i: F.pmod(F.xxhash64(i, F.col(key)), words * 64)))


def words_for(keys: int) -> int:
    """Words of a filter of so many keys."""
    return -(-keys * BITS // 64)


def built(keys: DataFrame, of: list[str], sizes: DataFrame) -> DataFrame:
    """Filters of keys (``of``, which filter, and ``key``): of, word, bits. ``sizes`` has ``words`` for each filter."""
    bits = keys.join(sizes, of).select(*of, _bits("key", F.col("words")).alias("bit"))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
    flags = bits.select(*of, F.floor(F.col("bit") / 64).alias("word"), flag.alias("flag"))
    return flags.groupBy(*of, "word").agg(F.bit_or("flag").alias("bits"))


def may_hold(keys: DataFrame, of: list[str], sizes: DataFrame, filters: DataFrame) -> DataFrame:
    """The filters (columns of ``sizes`` but ``words``) that may hold at least one of the keys.

    ``keys`` has ``of`` and ``key``; ``sizes`` may name several filters for one ``of``.
    """
    named = [c for c in sizes.columns if c != "words"]
    asked = keys.join(sizes, of).select("key", *named, _bits("key", F.col("words")).alias("bit"))
    word, place = F.floor(F.col("bit") / 64).alias("word"), F.pmod("bit", F.lit(64)).cast("int").alias("place")
    asked = asked.select("key", *named, word, place)
    held = asked.join(filters, [*named, "word"], "left")
    there = F.coalesce(F.call_function("getbit", F.col("bits"), F.col("place")) == 1, F.lit(False))
    return held.groupBy("key", *named).agg(F.min(there).alias("all_there")).filter("all_there").select(*named).distinct()
