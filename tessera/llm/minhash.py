"""Near-duplicate documents by min-max hashing, confirmed on their full sets of shingles.

Each permutation of the hashes gives two signature values, the smallest and the largest. Bands of four values
put documents into buckets. Documents with the same set are one class, told apart by a digest, so copies cost nothing
beyond their own row. Whatever the size of a bucket, its classes are compared on their full sets as far as they
do not hang together already: first each class with the smallest that it shares a bucket with, then, in buckets that are still
mixed, classes of different components, in tasks that hold two blocks at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blobs, written
from tessera.llm.components import components
from tessera.llm.shingles import WordHashes, run_hashes

#: Bands of values; half as many permutations as values. A pair at 0.8 shares no bucket once in 300,000.
BANDS, ROWS = 24, 4
#: Most classes, and shingles, that one block of a bucket holds (about).
BLOCK_CLASSES, BLOCK_SHINGLES = 2_000, 500_000

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 2**32, BANDS * ROWS // 2, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADDENDS = _RANDOM.integers(0, 2**32, BANDS * ROWS // 2, dtype=np.uint64).astype(np.uint32)


def shingles(text: bytes, words: WordHashes, length: int) -> np.ndarray:
    """The text's distinct shingles, as sorted hashes; of a shorter text, all its words are one."""
    found = text.lower().split()  # of bytes, so only A to Z change
    if not found:
        return np.empty(0, dtype=np.uint64)
    return np.unique(run_hashes(words.of(found), min(length, len(found))))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A bucket for each band of the signature."""
    values = np.empty(2 * len(_FACTORS), dtype=np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(_FACTORS), 16):
        part = slice(start, start + 16)
        permuted = low[None, :] * _FACTORS[part, None] + _ADDENDS[part, None]
        values[2 * start : 2 * start + 32 : 2] = permuted.min(axis=1)
        values[2 * start + 1 : 2 * start + 33 : 2] = permuted.max(axis=1)
    bands = values.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh3_64_intdigest(v.tobytes(), seed=i) for i, v in enumerate(bands)], np.uint64).view(np.int64)


def _sketched(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, digest (of the set; null if empty), n_shingles, keys."""
    fields = [pa.field("digest", pa.binary()), pa.field("n_shingles", pa.int64()), pa.field("keys", pa.list_(pa.int64()))]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            rows = []
            for text in blobs(batch.column(1)):
                found = shingles(text, words, length)
                some = len(found) > 0
                rows.append((xxhash.xxh3_128_digest(found.tobytes()) if some else None, len(found), band_keys(found) if some else None))
            digests, counts, keys = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(c, f.type) for c, f in zip((digests, counts, keys), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=pa.schema([batch.schema.field(0), *fields]))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sketch, f"doc_id {kind}, digest binary, n_shingles long, keys array<long>")


def _sets(docs: DataFrame, length: int) -> DataFrame:
    """digest and shingles (sorted 64-bit hashes) of rows with a text."""
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            found = [shingles(text, words, length).tobytes() for text in blobs(batch.column(0))]
            digests = [xxhash.xxh3_128_digest(f) for f in found]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(found, pa.binary())], schema=schema)

    return docs.select("text").mapInArrow(sets, "digest binary, shingles binary")


def near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    places = np.minimum(np.searchsorted(many, few), len(many) - 1)
    both = int(np.count_nonzero(many[places] == few))
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Counts:
    """Intersections of one set with all others, through lists of who holds a shingle."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self._m = len(sets)
        self._codes = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1).astype(np.int32)
        self._bounds = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(self._codes, kind="stable")
        self._holders = np.repeat(np.arange(self._m, dtype=np.int32), sizes)[order]
        self._starts = np.concatenate([[0], np.cumsum(np.bincount(self._codes))])

    def of(self, i: int) -> np.ndarray:
        mine, both = self._codes[self._bounds[i] : self._bounds[i + 1]], np.zeros(self._m, dtype=np.int64)
        step = max(1, 500_000 // self._m)  # shingles at a time, which all sets can hold at most
        for at in range(0, len(mine), step):
            some = mine[at : at + step]
            first, count = self._starts[some], self._starts[some + 1] - self._starts[some]
            places = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            both += np.bincount(self._holders[places], minlength=self._m)
        return both


def linked(sets: list[np.ndarray], left: int, percent: int, labels: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that make the components among sets whose similarity is at least ``percent`` / 100.

    ``left`` = 0: of all pairs; otherwise of pairs of one of the first ``left`` sets and one of the others. Sets of equal ``labels``
    are known to hang together and not compared. A set is tried with a few of each large component so far; one link
    settles the component. With what is left it is compared set by set, or, if that is much, by one count of all intersections.
    """
    m, sizes = len(sets), np.array([len(s) for s in sets])
    root = np.unique(labels, return_inverse=True)[1].reshape(-1) if labels is not None else np.arange(m)
    counts, links = None, []
    for i in range(max(1, left), m):
        before = slice(0, left or i)
        fits = 100 * np.minimum(sizes[before], sizes[i]) >= percent * np.maximum(sizes[before], sizes[i])

        def others(fits: np.ndarray = fits, before: slice = before, i: int = i) -> np.ndarray:
            return np.flatnonzero(fits & (root[before] != root[i]))

        def join(j: int, i: int = i) -> None:
            links.append((i, j))
            root[root == root[j]] = root[i]

        open_ones = others()
        if not len(open_ones):
            continue
        parts, count = np.unique(root[open_ones], return_counts=True)
        for part in parts[np.argsort(-count)[:4]]:
            for j in open_ones[root[open_ones] == part][:2].tolist():
                if near(sets[i], sets[j], percent):
                    join(j)
                    break
        open_ones = others()
        if len(open_ones) <= 32:
            for j in open_ones.tolist():
                if root[j] != root[i] and near(sets[i], sets[j], percent):
                    join(j)
        else:
            counts = counts or _Counts(sets, sizes)
            both = counts.of(i)[before]
            for j in np.flatnonzero(fits & (100 * both >= percent * (sizes[before] + sizes[i] - both))).tolist():
                if root[j] != root[i]:
                    join(j)
    return links


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found, strict=True)], schema=_LINK)


def _first_links(wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of classes and their ``leader``, which is sent once to each stretch of the classes that it leads."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leader = None, None
        for batch in batches:
            found = []
            names = zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)
            for k, (number, stretch, side, member) in enumerate(names):
                shingles_of = np.frombuffer(batch.column(4)[k].as_py(), np.uint64)
                if side == 0:
                    now, leader = (number, stretch), shingles_of
                elif now == (number, stretch) and near(leader, shingles_of, percent):
                    found.append((member, number))
            yield from _pairs(found)

    stretches = F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).cast("int")
    led = wanted.groupBy("leader").agg(stretches.alias("stretches"))
    members = wanted.join(led, "leader").select(
        "leader", F.pmod(F.xxhash64("number"), "stretches").cast("int").alias("stretch"), F.lit(1).alias("side"), "number"
    )
    leaders = led.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("stretches") - 1)).alias("stretch"), F.lit(0).alias("side"),
        F.col("leader").alias("number"),
    )
    rows = members.unionByName(leaders).join(sets, "number")
    dealt = rows.repartition("leader", "stretch").sortWithinPartitions("leader", "stretch", "side", "number")
    return dealt.select("leader", "stretch", "side", "number", "shingles").mapInArrow(compare, "a long, b long")


def _blocks(shared: DataFrame) -> DataFrame:
    """Rows of pairs of blocks to compare: key, pair (four numbers), side (0 or 1), number, label.

    Of ``shared`` (key, number, label, n_shingles) each bucket is cut into blocks. Classes of a label that fills blocks have blocks of
    their own, which are never compared with each other; all other labels share blocks.
    """
    load = F.sum(1 / F.lit(BLOCK_CLASSES) + F.col("n_shingles") / BLOCK_SHINGLES)
    labels = shared.groupBy("key", "label").agg(load.alias("load"))
    team = F.when(F.col("load") > 1, F.col("label")).otherwise(-1)
    teams = labels.withColumn("team", team)
    sizes = teams.groupBy("key", "team").agg(F.ceil(F.sum("load")).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("number"), "parts").cast("int").alias("part")
    placed = shared.join(teams.select("key", "label", "team"), ["key", "label"]).join(sizes, ["key", "team"])
    placed = placed.select("key", "team", part, "number", "label")
    blocks = sizes.select("key", "team", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    a, b = blocks.alias("a"), blocks.alias("b")
    apart = F.col("a.team") < F.col("b.team")
    together = (F.col("a.team") == -1) & (F.col("b.team") == -1) & (F.col("a.part") <= F.col("b.part"))
    pairs = a.join(b, F.col("a.key").eqNullSafe(F.col("b.key")) & (apart | together)).select(
        F.col("a.key").alias("key"),
        F.array(F.col("a.team"), F.col("a.part").cast("long"), F.col("b.team"), F.col("b.part").cast("long")).alias("pair"),
    )
    sides = pairs.select("key", "pair", F.explode(F.array_distinct(F.array(F.slice("pair", 1, 2), F.slice("pair", 3, 2)))).alias("block"))
    sides = sides.select(
        "key", "pair", F.col("block")[0].alias("team"), F.col("block")[1].cast("int").alias("part"),
        F.when(F.col("block") == F.slice("pair", 1, 2), 0).otherwise(1).alias("side"),
    )
    return placed.join(sides, ["key", "team", "part"]).select("key", "pair", "side", "number", "label")


def _last_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between labels within the pairs of blocks."""

    def compare(group: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        left = sum(side == 0 for side, *_ in group)
        if len({label for _, _, label, _ in group}) > 1 and left:
            found = [np.frombuffer(s, np.uint64) for *_, s in group]
            links = linked(found, left if left < len(group) else 0, percent, [label for _, _, label, _ in group])
            yield from _pairs([(group[i][1], group[j][1]) for i, j in links])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for k, (key, pair, *rest) in enumerate(zip(*columns, strict=True)):
                if (key, pair) != now:
                    yield from compare(group)
                    now, group = (key, pair), []
                group.append((*rest, batch.column(5)[k].as_py()))
        yield from compare(group)

    dealt = blocks.join(sets, "number").repartition("key", "pair").sortWithinPartitions("key", "pair", "side", "number")
    return dealt.select("key", "pair", "side", "number", "label", "shingles").mapInArrow(run, "a long, b long")


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """key, number, n_shingles, least (number) and size of buckets with more than one class; of buckets with the same classes, one."""
    in_buckets = classes.select(F.explode("keys").alias("key"), "number", "n_shingles")
    buckets = in_buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("number").alias("least"), F.bit_xor(F.xxhash64("number")).alias("members"),
        F.sum(F.xxhash64("number", F.lit(1)).cast("decimal(38,0)")).alias("members_too"),
    )
    buckets = buckets.filter("size > 1").groupBy("size", "least", "members", "members_too").agg(F.min("key").alias("key"))
    return in_buckets.join(buckets.select("key", "size", "least"), "key")


def _numbered_sets(docs: DataFrame, length: int, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """number and shingles of the ``wanted`` classes, from the texts of their first documents."""
    wanted = classes.select("number", "digest", "first").join(wanted.select("number").distinct(), "number")
    firsts = wanted.select("first").distinct()
    texts = docs.select("doc_id", "text")
    chosen = texts.join(firsts, texts["doc_id"].eqNullSafe(firsts["first"]), "left_semi")
    # Where ids repeat, the digest tells which row is meant, and one row stands for all copies.
    sets = _sets(chosen, length).join(wanted.select("digest", "number"), "digest").select("number", "shingles")
    return sets.dropDuplicates(["number"])


def _links(docs: DataFrame, length: int, classes: DataFrame, percent: int) -> DataFrame:
    """Links that make the components of classes: of all pairs that share a bucket and are similar enough, confirmed on full sets.

    First each class is compared with the smallest one that it shares a bucket with. What hangs together then has a label, and only
    buckets with more than one label go on, in which classes of different labels are compared.
    """
    shared = written(_shared_buckets(classes), "minhash-shared")
    leaders = shared.groupBy("number").agg(F.min("least").alias("leader"))
    sets = written(_numbered_sets(docs, length, classes, leaders), "minhash-sets")
    wanted = leaders.filter("leader <> number")
    first = written(_first_links(wanted, sets, percent), "minhash-first-links")
    labels = components(first).select(F.col("node").alias("number"), F.col("root").alias("label"))
    known = shared.join(labels, "number", "left").withColumn("label", F.coalesce("label", "number"))
    known = known.join(leaders, "number")
    told = F.col("leader") == F.col("least")  # compared with the bucket's smallest class already, as far as it isn't that itself
    mixed = known.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
        F.max(told & (F.col("number") != F.col("least"))).alias("told"),
    )
    mixed = mixed.filter("low <> high and not (n = 2 and told)").select("key")
    rest = written(known.join(mixed, "key", "left_semi").select("key", "number", "label", "n_shingles"), "minhash-rest")
    if rest.isEmpty():
        return first
    last = _last_links(_blocks(rest), sets, percent)
    return written(first.unionByName(last), "minhash-links")


def near_duplicates(docs: DataFrame, length: int, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id linked with it, itself included), kept.

    Documents are linked where the similarity of their sets of ``length``-word shingles is at least ``percent`` / 100. A text
    of fewer words is one shingle; one without words is linked with nothing, not even its like. ``kept`` marks the document
    whose id is the component's; of repeated rows of that id, all. A null doc_id takes part in links; a component of
    such rows alone has a null id and is kept. No documents give no rows.
    """
    key = F.col("doc_id").cast("long").alias("doc_id")
    return _grouped(docs.select(key, F.col("text").cast("string").alias("text")), length, percent)


def one_of_each(docs: DataFrame, length: int, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, but of each group of near copies one: the smallest doc_id, of equal ones any one text.

    Links as in ``near_duplicates``. Each row stands for itself, whatever its id: rows without an id, and different texts under one id, are
    kept or dropped by their own text, an id before none. Equal rows become one. Rows without words are linked with nothing and stay.
    """
    text = F.col("text").cast("string")
    own = F.md5(F.coalesce(F.encode(text, "UTF-8"), F.lit(b"")))
    key = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id").cast("long").alias("id"), own.alias("own"))
    groups = _grouped(docs.select(key.alias("doc_id"), text.alias("text")), length, percent)
    kept = groups.filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.withColumn("_key", key)
    return rows.join(kept, rows["_key"].eqNullSafe(kept["_kept"]), "left_semi").drop("_key").dropDuplicates()


def _grouped(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """``near_duplicates`` of doc_id, of any type that has an order, and text."""
    sketch = written(_sketched(docs, length), "minhash-sketch")
    classes = sketch.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")
    )
    classes = written(classes.withColumn("number", F.monotonically_increasing_id()), "minhash-classes")
    links = _links(docs, length, classes, percent)
    named = classes.select("digest", "first", F.col("number").alias("node")).join(components(links), "node")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    linked_ids = named.join(ids, "root").select("digest", F.col("component_id").alias("linked_id"))
    own = classes.select("digest", "first").join(linked_ids, "digest", "left")
    own = own.select("digest", F.coalesce("linked_id", "first").alias("class_id"))
    rows = sketch.select("doc_id", "digest", "n_shingles").join(own, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    rows = rows.withColumn("component_id", component)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
