"""Packing documents into sequences of bounded length by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.tokens import token_pieces


class SumOfSquares:
    """Open bins by residual gap; an item goes where the sum of the squared counts becomes smallest.

    With N(g) open bins of gap g, putting an item of size s into one of gap g changes the sum by
    2 - 2 N(g) + 2 N(g - s), less 1 if the bin gets full. Equal changes are settled by the smaller gap; a
    bin is opened only where no open one fits, which packs finite lists tighter. Only gaps that occur
    are looked at, so an item costs one pass over the counts, however many bins are open.
    """

    def __init__(self, size: int):
        self.size = size
        self.bins = 0
        self._count = np.zeros(size + 1, dtype=np.int64)
        self._open: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, item: int) -> tuple[int, int]:
        """The bin of an item and its offset there."""
        size, count = self.size, self._count
        if not 0 < item <= size:
            raise ValueError("an item must fit a bin and not be empty")
        gaps = np.flatnonzero(count[item:])
        if len(gaps):
            change = 2 * (count[gaps] - count[gaps + item])  # count[0] stays 0: full bins are not open
            change[0] -= gaps[0] == 0
            gap = item + int(gaps[change.argmin()])
            bin_id = self._open[gap].pop()
            count[gap] -= 1
        else:
            bin_id, gap = self.bins, size
            self.bins += 1
        if gap > item:
            self._open[gap - item].append(bin_id)
            count[gap - item] += 1
        return bin_id, size - gap


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    The pieces are dealt by a hash of all their columns, so no group hangs on a key, and each task packs what it
    gets, longest first; it leaves only its last sequences partly filled. How much a task gets is for
    adaptive execution to say (its advisory partition size). A task's memory holds its open bins, not its
    rows. A lost task is dealt and packed the same way again, as both follow from the contents.
    Sequence ids hold the task in the high bits and the bin, from 0, in the low ones.
    """
    names = pieces.columns
    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*pieces.schema.fields, *added])
    at = names.index(length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 40
        packer = SumOfSquares(capacity)
        for batch in batches:
            placed = [packer.place(n) for n in batch.column(at).to_pylist()]
            bins = pa.array([group + b for b, _ in placed], pa.int64())
            offsets = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, bins, offsets], names=[*names, "sequence_id", "offset"])

    mixed = F.xxhash64(*[F.col(c) for c in names])
    dealt = pieces.repartition(mixed).sortWithinPartitions(F.desc(length), mixed)
    return dealt.mapInArrow(place, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Documents' token pieces (see ``token_pieces``) with their place in the sequences.

    A document longer than ``capacity`` is cut, any other stays whole. Null and empty texts are the end
    id alone; null or repeated ``doc_id`` values are packed like others; no documents give no rows.
    Columns: doc_id, piece, start, length, ids, sequence_id, offset.
    """
    return pack(token_pieces(docs, tokenizer_path, end_id, capacity), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The training rows: a sequence's ids in order, and the offsets at which its pieces start."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("parts.offset").alias("offsets"))
