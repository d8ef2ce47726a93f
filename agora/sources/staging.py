"""Staged tables: how iterative jobs cut their lineage.

A staged table is an ordinary Parquet table in the shared folder named by
``spark.checkpoint.dir``.  Compared with an RDD checkpoint it is columnar and
compressed, filters and column selection reach it, and its file sizes are
known to the planner, so a join broadcasts it only when its measured size
allows it.  Losing executors never loses a staged table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: Folder of the step that is under way, if there is one.
_step: ContextVar[str | None] = ContextVar("step", default=None)


def scratch_root(spark: SparkSession) -> str:
    """Folder for staged tables, taken from the session's own settings."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a folder all executors share"
        )
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="agora-")
    return _local_roots[app]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder of that name exists on its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def _folder(spark: SparkSession) -> str:
    """Where this application's staged tables lie."""
    return f"{scratch_root(spark)}/agora-{spark.sparkContext.applicationId}"


def _place(spark: SparkSession, label: str) -> str:
    """A new folder for a staged table."""
    return f"{_step.get() or _folder(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged inside are deleted in the end."""
    path = _place(spark, "step")
    before = _step.set(path)
    try:
        yield
    finally:
        _step.reset(before)
        _delete(spark, path)


@contextmanager
def lasting() -> Iterator[None]:
    """Tables that are staged inside stay, whatever step is under way."""
    before = _step.set(None)
    try:
        yield
    finally:
        _step.reset(before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return it as a fresh scan."""
    spark = df.sparkSession
    path = _place(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_steps(parts: list[DataFrame], label: str) -> DataFrame:
    """Write parts of one table one after the other and return them as one scan.

    Each is a job of its own, whose shuffle files go before the next one starts.
    """
    spark = parts[0].sparkSession
    path = _place(spark, label)
    for part in parts:
        part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def stage_each(spark: SparkSession, count: int, make: Callable[[int], DataFrame], label: str) -> DataFrame:
    """Write ``make(0)`` to ``make(count - 1)`` one after the other and return them as one scan.

    What a step stages is deleted when its rows are written, so the scratch disk is that of one step.
    """
    path = _place(spark, label)
    for i in range(count):
        with passing(spark):
            part = make(i)
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete one staged table that nothing reads any more."""
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, name)


def release(spark: SparkSession) -> None:
    """Delete all staged tables of this application.

    To be called when every result has been written; DataFrames that still
    read staged tables can no longer be evaluated.
    """
    _delete(spark, _folder(spark))
