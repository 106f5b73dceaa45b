"""Tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(rows_or_session, name: str) -> str:
    """A new path in the folder that all executors share."""
    spark = getattr(rows_or_session, "sparkSession", rows_or_session)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the folder that all executors share, and read from there.

    What was shuffled for it goes with the job, as nothing reads it again; else it would lie on disk until the driver happens to
    collect its garbage.
    """
    return kept_at(rows, shared_path(rows, name))


def kept_at(rows: DataFrame, path: str) -> DataFrame:
    conf = rows.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
