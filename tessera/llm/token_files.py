"""Token files: ids of many documents as a wavelet matrix, readable at any place.

A file holds the documents of one stretch of the doc_id order. The ids are kept as one bit-plane per
bit of the largest id, highest first; each plane stands in the order that a stable partition by the
plane above leaves. With a count of ones before every 512 bits, a plane answers rank and select, and so
the file gives the id at a place (``access``), how often an id occurs before a place (``rank``), and where
its k-th occurrence is (``select``), all without unpacking the rest. Documents' ids and lengths stand deflated in front.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import blobs, shared_folder
from tessera.llm.tokens import word_encoder

MAGIC = b"TWM1"
BLOCK = 512
#: Ids that a file holds, or one document's if those are more.
FILE_TOKENS = 4_000_000


@dataclass
class WaveletMatrix:
    """Succinct sequence of n ids below 2**len(planes)."""

    n: int
    planes: list[np.ndarray]  # bytes, lowest bit first, padded to whole blocks
    ones: list[np.ndarray]  # ones before each block, and in all
    zeros: list[int]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n, bits = len(ids), int(ids.max(initial=0)).bit_length()
        level = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        below = np.empty_like(level)
        planes, zeros = [], []
        for b in reversed(range(bits)):
            bit = level & level.dtype.type(1 << b) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            zeros.append(n - int(np.count_nonzero(bit)))
            np.compress(~bit, level, out=below[: zeros[-1]])
            np.compress(bit, level, out=below[zeros[-1] :])
            level, below = below, level
        return cls._ranked(n, planes, zeros)

    @classmethod
    def _ranked(cls, n: int, planes: list[np.ndarray], zeros: list[int]) -> WaveletMatrix:
        blocks = -(-n // BLOCK)
        padded, ones = [], []
        for plane in planes:
            full = np.zeros(blocks * BLOCK // 8, dtype=np.uint8)
            full[: len(plane)] = plane
            counts = np.bitwise_count(full.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            padded.append(full)
            ones.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))
        return cls(n, padded, ones, zeros)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes), *self.zeros], dtype="<u8").tobytes()
        used = -(-self.n // 8)
        parts = [x for p, o in zip(self.planes, self.ones, strict=True) for x in (o.tobytes(), p[:used].tobytes())]
        return b"".join([head, *parts])

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        n, bits = (int(x) for x in np.frombuffer(blob, "<u8", 2))
        zeros = [int(x) for x in np.frombuffer(blob, "<u8", bits, 16)]
        at, blocks, used = 16 + 8 * bits, -(-n // BLOCK), -(-n // 8)
        planes, ones = [], []
        for _ in range(bits):
            ones.append(np.frombuffer(blob, "<u4", blocks + 1, at))
            at += 4 * (blocks + 1)
            plane = np.zeros(blocks * BLOCK // 8, dtype=np.uint8)
            plane[:used] = np.frombuffer(blob, np.uint8, used, at)
            at += used
            planes.append(plane)
        return cls(n, planes, ones, zeros)

    def _bit(self, level: int, place: int) -> int:
        return int(self.planes[level][place >> 3] >> (place & 7)) & 1

    def _rank1(self, level: int, place: int) -> int:
        """Ones before a place."""
        block = place // BLOCK
        part = self.planes[level][block * BLOCK // 8 : -(-place // 8)]
        if not len(part):
            return int(self.ones[level][block])
        last = int(part[-1]) & ((1 << (place & 7)) - 1) if place & 7 else int(part[-1])
        return int(self.ones[level][block]) + int(np.bitwise_count(part[:-1]).sum()) + last.bit_count()

    def _select(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) one or zero of a plane."""
        ones = self.ones[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, place), self._rank1(level, place)
            value = value << 1 | bit
            place = self.zeros[level] + ones if bit else place - ones
        return value

    def rank(self, token: int, place: int) -> int:
        """How often an id occurs before a place."""
        start, end = self._walk(token, place)
        return end - start

    def _walk(self, token: int, place: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        start, end = 0, place
        for level in range(len(self.planes)):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if token >> (len(self.planes) - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def select(self, token: int, k: int) -> int:
        """The place of an id's k-th occurrence, from 0."""
        start, end = self._walk(token, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        place = start + k
        for level in reversed(range(len(self.planes))):
            bit = token >> (len(self.planes) - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def all(self) -> np.ndarray:
        """All ids, by undoing the partitions from the lowest plane up."""
        level = np.zeros(self.n, dtype="<u4")
        for b, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty_like(level)
            above[~bit] = level[:zeros]
            above[bit] = level[zeros:] | np.uint32(1 << b)
            level = above
        return level


def file_bytes(docs: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in docs], dtype=np.uint8).tobytes()
    numbers = np.array([0 if d is None else d for d in docs], dtype="<i8").tobytes()
    head = zlib.compress(known + numbers + np.array(lengths, dtype="<u8").tobytes(), 1)
    return b"".join([MAGIC, np.array([len(docs), len(head)], dtype="<u8").tobytes(), head, WaveletMatrix.build(ids).to_bytes()])


def file_contents(blob: bytes) -> tuple[list[int | None], list[int], WaveletMatrix]:
    """Documents, their numbers of ids, and the ids."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token file")
    n, size = (int(x) for x in np.frombuffer(blob, "<u8", 2, 4))
    head = zlib.decompress(blob[20 : 20 + size])
    known, numbers = head[:n], np.frombuffer(head, "<i8", n, n).tolist()
    lengths = np.frombuffer(head, "<u8", n, 9 * n).tolist()
    return [d if k else None for k, d in zip(known, numbers, strict=True)], lengths, WaveletMatrix.from_bytes(blob[20 + size :])


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None, file_tokens: int = FILE_TOKENS
) -> str:
    """Write every document's ids and ``end_id`` in ascending doc_id order; returns the folder.

    Null texts are empty, null doc_ids come first, rows of one doc_id stand in the order of their texts;
    other columns are not read. Tasks cover ranges of doc_id and write a file each time enough ids have come. File names
    follow from task and number, and a file appears by a rename, so a task that runs again replaces
    its own files by the same. ``folder``/manifest lists the files with their numbers of documents and ids.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    fields = pa.schema([("file", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())])
    tail = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(f"{root}/files")
        encoder = word_encoder(tokenizer_path)
        ids, lengths, names, held, number = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            if not names:
                return
            name = f"part-{task.partitionId():06d}-{number:06d}.twm"
            blob = file_bytes(names, lengths, np.frombuffer(b"".join(ids), "<u4"))
            draft = f"{root}/files/.{name}-{task.taskAttemptId()}"
            with files.open_output_stream(draft) as out:
                out.write(blob)
            files.move(draft, f"{root}/files/{name}")
            yield pa.RecordBatch.from_pylist(
                [{"file": name, "task": task.partitionId(), "number": number, "docs": len(names), "tokens": held}], schema=fields
            )
            ids.clear(), lengths.clear(), names.clear()
            held, number = 0, number + 1

        for batch in batches:
            for doc, made in zip(batch.column(0).to_pylist(), encoder.encode_all(blobs(batch.column(1))), strict=True):
                got = made + tail
                if held and held + len(got) // 4 > file_tokens:
                    yield from flush()
                ids.append(got)
                lengths.append(len(got) // 4)
                names.append(doc)
                held += len(got) // 4
        yield from flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = ranged.mapInArrow(write, "file string, task int, number int, docs long, tokens long")
    manifest.write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with the number of ids before it; one small row per file."""
    files = spark.read.schema("file string, task int, number int, docs long, tokens long").parquet(f"{folder}/manifest")
    earlier = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy("task").agg(F.sum("tokens").alias("of_task"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("of_task").over(before), F.lit(0)).alias("of_earlier"))
    inside = F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    return files.withColumn("inside", inside).join(tasks, "task").select("file", "docs", "tokens", (F.col("of_earlier") + F.col("inside")).alias("before"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids as the files have them: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    Spark reads the files, one row each, so they may lie in any store that it reaches.
    """
    listed = manifest(spark, folder)
    if listed.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, lengths, matrix = file_contents(blob.as_py())
                ends = np.cumsum([0, *lengths])
                ids = matrix.all().tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(before + ends[:-1], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                    ],
                    schema=fields,
                )

    found = spark.read.format("binaryFile").load(f"{folder}/files/*.twm").select("path", "content")
    found = found.withColumn("file", F.element_at(F.split("path", "/"), -1))
    placed = found.join(listed, "file")
    return placed.select("before", "content").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")
