"""Where intermediate tables go.

A few operators need a result that is computed once and then read several times
(a numbered sort, a feature store). They write it as Parquet below the folder
named by ``spark.checkpoint.dir``, which every executor can reach, so a lost
executor costs a re-read and never a recomputation.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="stayscope-")


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, from the session's ``spark.checkpoint.dir``.

    Only a local-mode session may leave the setting out; it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def discard(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)


#: Whether Spark deletes a query's shuffle files as the query ends, not when the driver's memory is next cleared.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run within are deleted as each of them ends.

    For chains of queries that each write their result: what is read again is a table, never a shuffle.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, exactly the intermediate paths made within it.

    Results read after the end must have been written elsewhere.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            discard(spark, path)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative models cut their lineage in the shared folder, unless a folder is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that scans the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
