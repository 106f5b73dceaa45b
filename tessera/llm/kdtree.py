"""Exact top-k search by inner product over KD-trees, one for each shard of the vectors.

Vectors are dealt to cells by median splits of the widest component, as a bounded sample of them says, and a cell to shards of a
bounded number of vectors. A shard's tree splits on in the same way and keeps the tight box of each node.
No inner product of a query with a vector in a box exceeds the sum of its largest products with the box's sides. A query
visits nodes by that bound, best first, and stops at a bound below its k-th score so far. It starts
with the k-th score that it reached in its own shard, which is searched first, and goes to the shards of those cells alone whose tight
box allows as much.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

LEAF = 256
#: Vectors of a shard, about; most cells; vectors of one length that say where cells split.
SHARD_VECTORS, CELLS, SAMPLE = 8_000, 512, 20_000


class KDTree:
    """Vectors (float64 rows) with ids; among equal scores the smaller id comes first."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.vectors, self.ids = vectors, ids
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self._leaf = leaf
        if len(ids):
            self._node(np.arange(len(ids)))
            self._low, self._high = np.array(self.low), np.array(self.high)

    def _node(self, rows: np.ndarray) -> int:
        part = self.vectors[rows]
        me = len(self.children)
        self.low.append(part.min(axis=0))
        self.high.append(part.max(axis=0))
        self.children.append(None)
        self.rows.append(rows)
        if len(rows) > self._leaf and part.shape[1]:
            widest = int((self.high[me] - self.low[me]).argmax())
            half = len(rows) // 2
            order = np.argpartition(part[:, widest], half)  # splits equal values as well
            self.rows[me] = rows[:0]
            self.children[me] = (self._node(rows[order[:half]]), self._node(rows[order[half:]]))
        return me

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores of at least ``floor``, without the id ``own``; all ties at the k-th place are seen."""
        if not len(self.ids):
            return self.ids, np.empty(0)
        # Bounds of all nodes in one product each: positive parts meet the upper sides, negative the lower.
        bounds = np.maximum(query, 0) @ self._high.T + np.minimum(query, 0) @ self._low.T
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= floor:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.vectors[rows] @ query
            good = (scores >= floor) & (self.ids[rows] != own)
            ids, scores = np.concatenate([best_ids, self.ids[rows[good]]]), np.concatenate([best, scores[good]])
            order = np.lexsort((ids, -scores))[:k]
            best_ids, best = ids[order], scores[order]
            if len(best) == k:
                floor = max(floor, float(best[-1]))
        return best_ids, best


def _found(rows: DataFrame, k: int) -> DataFrame:
    """Search each shard: rows (shard, query, vec_id, vector, floor), a shard's vectors before its queries.

    A task holds one shard's vectors and one batch of queries at a time.
    """
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, vectors, ids, tree = None, [], [], None
        for batch in batches:
            shards = batch.column(0).to_pylist()
            asks = batch.column(1).to_pylist()
            numbers = batch.column(2).to_pylist()
            floors = batch.column(4).to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for i, shard in enumerate(shards):
                if shard != now:
                    now, vectors, ids, tree = shard, [], [], None
                vector = np.asarray(batch.column(3)[i].values, dtype=np.float64)
                if not asks[i]:
                    vectors.append(vector)
                    ids.append(numbers[i])
                    continue
                if not ids:
                    continue
                if tree is None:
                    tree = KDTree(np.array(vectors).reshape(len(ids), -1), np.array(ids, dtype=np.int64))
                    vectors = []
                floor = -np.inf if floors[i] is None else floors[i]
                found, scores = tree.search(vector, numbers[i], k, floor)
                out[0].extend([numbers[i]] * len(found))
                out[1].extend(found.tolist())
                out[2].extend(scores.astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    dealt = rows.repartition("shard").sortWithinPartitions("shard", "query", "vec_id")
    return dealt.select("shard", "query", "vec_id", "vector", "floor").mapInArrow(run, "query_id long, vec_id long, score long")


def whole_numbers(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vec_id and ``vector`` of floor(scale * x), one row per vec_id; rows with nulls, NaN or infinities are left out."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))

    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    rows = rows.filter("vec_id is not null and x is not null").filter(~F.exists("x", bad))
    rows = rows.select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("vector"))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


class Cells:
    """A complete binary tree of median splits; its leaves are the cells."""

    def __init__(self, sample: np.ndarray, wanted: int):
        self.depth = max(0, int(wanted - 1).bit_length()) if sample.shape[1] else 0
        self.sides = np.zeros(2**self.depth - 1, dtype=np.int64)
        self.cuts = np.full(2**self.depth - 1, np.inf)
        parts = [sample]
        for node in range(len(self.sides)):
            part = parts[node]
            if len(part):
                self.sides[node] = int((part.max(axis=0) - part.min(axis=0)).argmax())
                self.cuts[node] = np.median(part[:, self.sides[node]])
            right = part[:, self.sides[node]] >= self.cuts[node]
            parts += [part[~right], part[right]]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(vectors), dtype=np.int64), np.arange(len(vectors))
        for _ in range(self.depth):
            node = 2 * node + 1 + (vectors[rows, self.sides[node]] >= self.cuts[node])
        return node - len(self.sides)


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors (as rows of one array) of those of each length."""
    sizes = np.asarray(column.value_lengths())
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        part = column.take(pa.array(at))
        yield at, np.asarray(part.flatten(), dtype=np.float64).reshape(len(at), size)


def _in_cells(rows: DataFrame, shard_vectors: int) -> DataFrame:
    """vec_id, vector, size and cell; written. Lengths with few vectors are one cell each."""
    cells = {}
    counts = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    # Few lengths have so many vectors: at most one for each that many rows.
    for size, n in counts.filter(F.col("n") > shard_vectors).orderBy(F.desc("n")).limit(16).collect():
        of_size = rows.filter(F.size("vector") == size)
        sample = of_size.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("vector").collect()
        cells[size] = Cells(np.array([r["vector"] for r in sample], dtype=np.float64).reshape(len(sample), size), min(CELLS, -(-n // shard_vectors)))
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("size", pa.int32()), ("cell", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, dtype=np.int32)
            for at, vectors in _by_size(batch.column(1)):
                if (tree := cells.get(vectors.shape[1])) is not None:
                    found[at] = tree.of(vectors)
            sizes = batch.column(1).value_lengths()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(schema.types[1]), sizes, pa.array(found)], schema=schema)

    return written(rows.mapInArrow(place, "vec_id long, vector array<long>, size int, cell int"), "kd-cells")


def _boxes(placed: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length its cells with their tight boxes: numbers, lower and upper sides. At most ``CELLS`` for each of a few lengths."""
    schema = pa.schema([("size", pa.int32()), ("cell", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cells = np.asarray(batch.column(1))
            for at, vectors in _by_size(batch.column(0)):
                for cell in np.unique(cells[at]):
                    part = vectors[cells[at] == cell]
                    low, high = part.min(axis=0), part.max(axis=0)
                    key = (vectors.shape[1], int(cell))
                    if key in found:
                        low, high = np.minimum(low, found[key][0]), np.maximum(high, found[key][1])
                    found[key] = (low, high)
        if found:
            columns = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()], [v[1] for v in found.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    # Only lengths that have several cells need boxes.
    several = placed.groupBy("size").agg(F.max("cell").alias("last")).filter("last > 0").select("size")
    parts = placed.join(several, "size", "left_semi").select("vector", "cell").mapInArrow(bound, "size int, cell int, low array<double>, high array<double>")
    sides = parts.select("size", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("place", "side"))
    tight = sides.groupBy("size", "cell", "place").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
    tight = tight.groupBy("size", "cell").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("sides"))
    by_size: dict[int, list] = {}
    for r in tight.collect():
        by_size.setdefault(r["size"], []).append((r["cell"], [s["low"] for s in r["sides"]], [s["high"] for s in r["sides"]]))
    return {size: tuple(np.array(c) for c in zip(*cells, strict=True)) for size, cells in by_size.items()}


def _to_search(queries: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Queries (vec_id, vector, size, home cell, number, floor) with the cells (``other``) whose box may hold a score of the floor or more."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = np.array([-np.inf if f is None else f for f in batch.column(5).to_pylist()])
            chosen: list = [[0]] * batch.num_rows
            for at, vectors in _by_size(batch.column(1)):
                if vectors.shape[1] in boxes:
                    cells, low, high = boxes[vectors.shape[1]]
                    bounds = np.maximum(vectors, 0) @ high.T + np.minimum(vectors, 0) @ low.T
                    for k, i in enumerate(at.tolist()):
                        chosen[i] = cells[bounds[k] >= floors[i]].tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    columns = "vec_id long, vector array<long>, size int, cell int, number int, floor double, cells array<int>"
    asked = queries.select("vec_id", "vector", "size", "cell", "number", "floor").mapInArrow(choose, columns)
    return asked.withColumn("other", F.explode("cells")).drop("cells")


def top_k(vectors: DataFrame, column: str, is_query: Column, k: int = 20, scale: int = 64, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """Each query's k best other vectors: query_id, rank (from 1), vec_id, score; all of them if there are fewer.

    Components become floor(scale * x); scores are exact integer inner products (below 2 ** 53 in size), ties go to the smaller
    vec_id. ``is_query`` is a condition on vec_id. Vectors that are null, or hold null, NaN or infinite components, take no part, nor do rows
    without vec_id; of rows with one vec_id the smallest vector counts. Vectors of another
    length than the query's are no candidates; empty vectors are candidates of each other, with a score of 0. Any number of equal
    vectors may stand in a cell and a shard. No vectors give no rows.

    At worst, where boxes tell nothing apart, work is queries times shards, as any exact search has it; no query's candidates meet
    in one task but the k best of each shard. Cells follow from at most ``SAMPLE`` vectors of a length; what they hold, and their boxes,
    from all.
    """
    placed = _in_cells(written(whole_numbers(vectors, column, scale), "kd-vectors"), shard_vectors)
    shards = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard_vectors)).cast("int")
    counts = written(placed.groupBy("size", "cell").agg(shards.alias("shards")), "kd-counts")
    placed = placed.join(counts, ["size", "cell"]).withColumn("number", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    shard = F.struct("size", "cell", "number")
    no_floor = F.lit(None).cast("double").alias("floor")
    base = placed.select(shard.alias("shard"), F.lit(0).alias("query"), "vec_id", "vector", no_floor)
    queries = placed.filter(is_query)
    at_home = queries.select(shard.alias("shard"), F.lit(1).alias("query"), "vec_id", "vector", no_floor)
    first = written(_found(base.unionByName(at_home), k), "kd-home")
    floors = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("floor")
    )
    others = _to_search(queries.join(floors, "vec_id", "left"), _boxes(placed))
    there = counts.select("size", F.col("cell").alias("other"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard_number"))
    others = others.join(there, ["size", "other"]).filter("other <> cell or shard_number <> number").select(
        F.struct("size", F.col("other").alias("cell"), F.col("shard_number").alias("number")).alias("shard"),
        F.lit(1).alias("query"), "vec_id", "vector", "floor",
    )
    found = first.unionByName(_found(base.unionByName(others), k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
