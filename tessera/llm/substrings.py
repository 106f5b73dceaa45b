"""Passages that occur more than once in a corpus, found by seeds, extended both ways, and taken out.

Seeds are winnowed: of the hashes of all runs of ``SEED`` words, those smallest among ``words`` - ``SEED`` + 1
neighbours. Every stretch of ``words`` words holds a seed that follows from the stretch alone, so two equal stretches
share one at the same place. Occurrences are joined on seeds that occur twice and extended to both sides, as far as a stretch around
the seed can reach. Where two extend alike, all stretches around the seed are repeats. What is left, seeds whose surroundings
differ from those of all others, is compared with one representative of each kind of surroundings of the seed, extension by
extension: every stretch around the seed. Overlapping repeats merge to the maximal ones.

Texts are known by a digest of themselves, so ids may repeat, and of the copies of a text one is looked into.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blobs, written
from tessera.llm.shingles import WordHashes, mixed, run_hashes, stretch_hashes

#: Words of a seed.
SEED = 12


def seeds(words: np.ndarray, length: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the winnowed seeds: of each window of seeds the smallest hash, the first of equals."""
    hashes = run_hashes(words, seed)
    window = length - seed + 1
    if len(words) < length:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    seen = np.lib.stride_tricks.sliding_window_view(hashes, window)
    places = np.unique(seen.argmin(axis=1) + np.arange(len(seen)))
    return hashes[places].view(np.int64), places.astype(np.int32)


def _around(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Hashes of seeds extended both ways: of all words that share a stretch of ``length`` words with the seed."""
    reach = length - SEED
    starts, stops = np.maximum(0, places - reach), np.minimum(len(words), places + SEED + reach)
    return mixed(stretch_hashes(words, starts, stops) + (places - starts).astype(np.uint64)).view(np.int64)


def _seeded(docs: DataFrame, length: int) -> DataFrame:
    """k1, k2, seeds, around, places: one row per row of ``docs`` (columns k1, k2, text)."""
    lists = ("seeds", pa.list_(pa.int64())), ("around", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            found = []
            for blob in blobs(batch.column(2)):
                words = known.of(blob.split())
                hashes, places = seeds(words, length)
                found.append((hashes, _around(words, places, length), places))
            columns = [pa.array([f[i] for f in found], schema.types[2 + i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=schema)

    kind = "k1 long, k2 long, seeds array<long>, around array<long>, places array<int>"
    return docs.select("k1", "k2", "text").mapInArrow(run, kind)


def _reached(places: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """Where stretches of ``length`` words start that hold a seed at one of the places."""
    edges = np.zeros(n_words + 2, dtype=np.int32)
    np.add.at(edges, np.maximum(0, places - (length - SEED)), 1)
    np.add.at(edges, places + 1, -1)
    return np.flatnonzero(np.cumsum(edges)[: max(0, n_words - length + 1)] > 0)


def _extended(found: DataFrame, length: int) -> DataFrame:
    """All stretches of ``length`` words that hold one of a text's places: k1, k2, two lists of hashes, starts."""
    lists = ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows = []
            for text, places in zip(blobs(batch.column(2)), batch.column(3), strict=True):
                words = known.of(text.split())
                starts = _reached(np.asarray(places.values), len(words), length)
                hashes = [stretch_hashes(words, starts, starts + length, salt).view(np.int64) for salt in (1, 2)]
                rows.append((*hashes, starts.astype(np.int32)))
            columns = [pa.array([r[i] for r in rows], schema.types[2 + i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=schema)

    kind = "k1 long, k2 long, first array<long>, second array<long>, starts array<int>"
    return found.select("k1", "k2", "text", "places").mapInArrow(run, kind)


def _key() -> tuple[Column, Column]:
    return F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("other"), "text").alias("k2")


def _shared(keyed: DataFrame, length: int) -> DataFrame:
    """seed, around, k1, k2, place of all occurrences of seeds that occur twice; written."""
    seeded = written(_seeded(keyed, length), "seeds").filter(F.size("seeds") > 0)
    flat = seeded.select("k1", "k2", F.explode(F.arrays_zip("seeds", "around", "places")).alias("s"))
    flat = flat.select(F.col("s.seeds").alias("seed"), F.col("s.around").alias("around"), "k1", "k2", F.col("s.places").alias("place"))
    twice = flat.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    # Written, so that both sides of the join are shuffled for it alone and hot seeds can be split.
    return written(flat.join(written(twice, "shared-seeds"), "seed"), "shared")


def without_repeats(docs: DataFrame, words: int = 35, layout: bool = False) -> DataFrame:
    """Each row's columns, with the repeated words taken out of ``text``; n_words and n_removed tell how many.

    A word goes if a stretch of ``words`` words that covers it also starts anywhere else, in this text or
    another; all such stretches go, the first one too. Kept words are joined by one blank; with ``layout``, texts that
    lose nothing stay as they are. Null texts have no words and become empty; so do texts of which nothing is left: their rows stay. Repeated rows, and texts that are copies of
    another, repeat each other. Other columns may have any name but n_words and n_removed, which are
    replaced. No documents give no rows. Stretches are told apart by 128 bits.
    """
    names = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    rest = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.lit(None).cast("int")
    keyed = docs.select(*_key(), rest.alias("rest"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = _shared(keyed, words)
    kinds = shared.groupBy("seed", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one")
    )
    kinds = written(kinds, "surroundings")
    alike = kinds.filter("n > 1").select("seed", "around")
    whole = shared.join(alike, ["seed", "around"]).groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))
    # Seeds with an occurrence whose surroundings no other has: it and one of each other kind.
    lonely = kinds.filter("n = 1").select("seed").distinct()
    asked = kinds.join(lonely, "seed").groupBy("one.k1", "one.k2").agg(F.collect_list("one.place").alias("places"))
    texts = keyed.select("k1", "k2", "text").join(asked, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    stretches = _extended(texts, words)
    flat = stretches.select("k1", "k2", F.explode(F.arrays_zip("first", "second", "starts")).alias("s"))
    flat = flat.select(F.col("s.first").alias("first"), F.col("s.second").alias("second"), "k1", "k2", F.col("s.starts").alias("start"))
    flat = written(flat, "stretches")
    repeated = flat.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("first", "second")
    repeated = written(repeated, "repeats")
    starts = flat.join(repeated, ["first", "second"]).groupBy("k1", "k2").agg(F.collect_list("start").alias("starts"))
    found = whole.join(starts, ["k1", "k2"], "full")
    return _cut(keyed.join(written(found, "found"), ["k1", "k2"], "left"), names, words, layout)


def _cut(rows: DataFrame, names: list[str], length: int, layout: bool) -> DataFrame:
    """Take out the words that the stretches cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed = [], [], []
            for text, places, starts in zip(blobs(batch.column(1)), batch.column(2), batch.column(3), strict=True):
                words = text.split()
                kept = words
                if starts.is_valid or places.is_valid:
                    at = np.asarray(starts.values) if starts.is_valid else np.empty(0, np.int32)
                    if places.is_valid:  # stretches around a place are all repeats
                        at = np.union1d(at, _reached(np.asarray(places.values), len(words), length))
                    edges = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + length, -1)
                    covered = np.cumsum(edges)[:-1] > 0
                    kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                texts.append(text if layout and len(kept) == len(words) else b" ".join(kept))
                totals.append(len(words))
                removed.append(len(words) - len(kept))
            columns = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["rest", "text", "n_words", "n_removed"])

    kind = rows.schema["rest"].dataType.simpleString()
    done = rows.select("rest", "text", "places", "starts").mapInArrow(run, f"rest {kind}, text string, n_words long, n_removed long")
    return done.select(*[F.col(f"rest.`{c}`").alias(c) for c in names], "text", "n_words", "n_removed")
