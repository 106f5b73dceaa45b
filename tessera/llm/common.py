"""What the operators of this package share: words, shared folders, written tables."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but blank and the characters 9 to 13. ``bytes.split()`` cuts UTF-8 so.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters or bytes of texts whose words are told apart at once, or those of one text if these are more.
STRETCH = 4_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors reach.

    It lies in ``spark.checkpoint.dir``. Only a local session, whose executors are the driver, may
    leave that unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tessera-llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: cuts lineage, survives lost executors."""
    spark = rows.sparkSession
    path = shared_folder(spark, name)
    rows.write.parquet(path)
    release(spark)
    return spark.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let executors drop shuffle files of finished parts now.

    They go once the driver has collected the plans that used them as garbage, which it does when its memory
    fills up, not when disks do.
    """
    spark.sparkContext._jvm.System.gc()


class Kept(dict):
    """Results kept by what they were made from, until they take more than ``room`` bytes; then ``tidy`` starts anew."""

    def __init__(self, room: int):
        super().__init__()
        self._room = self._left = room

    def add(self, key, value, size: int = 0) -> None:
        """``size``: bytes of the value, where they are many."""
        self[key] = value
        self.added(1, getsizeof(key) + size)

    def added(self, number: int, size: int) -> None:
        """Account for entries put in by other means; ``size``: bytes of all their keys and values."""
        self._left -= size + 140 * number  # entry and small value

    def tidy(self) -> None:
        """To be called where nothing kept is in use."""
        if self._left < 0:
            self.clear()
            self._left = self._room


class Made(Kept):
    """What ``make`` gives for each key that was asked for."""

    def __init__(self, make: Callable[[str], bytes], room: int):
        super().__init__(room)
        self._make = make

    def __missing__(self, key: str) -> bytes:
        made = self[key] = self._make(key)
        self.added(1, getsizeof(key) + len(made))
        return made


def stretches(texts: list, size: int = STRETCH) -> Iterator[list]:
    """The texts in order, as many at a time as hold ``size`` in all."""
    some, held = [], 0
    for text in texts:
        if some and held + len(text) > size:
            yield some
            some, held = [], 0
        some.append(text)
        held += len(text)
    if some:
        yield some


def looked_up(words: pa.ListArray, made: Callable[[str], bytes]) -> list[bytes]:
    """For each list of words what ``made`` gives for them, joined. It is asked once for each word, whatever lists hold it."""
    told = words.flatten().dictionary_encode()
    if not len(told):
        return [b""] * len(words)
    values = pa.array([made(w) for w in told.dictionary.to_numpy(zero_copy_only=False)], pa.large_binary())
    joined = values.take(told.indices)
    at = words.offsets.to_numpy()
    ends = np.frombuffer(joined.buffers()[1], "<i8")[at - at[0]].tolist()
    data = memoryview(joined.buffers()[2] or b"")
    return [data[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]


_of_worker: dict[str, dict] = {}


def kept_by_worker(operator: str) -> dict:
    """What this worker keeps for an operator from task to task; what it kept for another one goes.

    Workers pass from stage to stage, and one that still held what an earlier stage needed would take room that the present
    one counts on. To be asked for at the start of each task, also by operators that keep nothing. What Arrow holds back of
    earlier batches goes back to the system too, and so does what the C library holds of the dropped.
    """
    if operator not in _of_worker:
        _of_worker.clear()
        _of_worker[operator] = {}
        gc.collect()  # encoders and what they keep refer to each other
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
        if trim:
            trim(0)
    pa.default_memory_pool().release_unused()
    return _of_worker[operator]


def blobs(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Where executors do not see that folder, the package is installed there or given by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
