"""Tables that are replaced in one step.

Each write goes to a folder of its own; a small pointer file beside them names the one that
counts.  The pointer is written under another name and then renamed over the old one.
Readers look it up once and see the old table or the new one, never a half-written or a
missing one, and a write that fails leaves everything as it was.  Older versions stay
until ``prune`` is called, so that readers can finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts; None where nothing was published."""
    pointer = _path(spark, f"{path}/{POINTER}")
    files = _files(spark, pointer)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name.strip()}"


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] | None = None) -> str:
    """Write a new version of the table and make it the one that counts; the version's folder.

    ``write`` puts the rows into a folder that does not exist yet (default: Parquet).
    """
    spark = df.sparkSession
    name = f"version-{uuid.uuid4().hex}"
    (write or (lambda rows, folder: rows.write.parquet(folder)))(df, f"{path}/{name}")
    fresh, pointer = _path(spark, f"{path}/{POINTER}-{name}"), _path(spark, f"{path}/{POINTER}")
    stream = _files(spark, fresh).create(fresh, True)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _files(spark, pointer).getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(fresh, pointer, options)
    return f"{path}/{name}"


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version that counts now; versions published later are not seen by this DataFrame."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(folder)


def prune(spark: SparkSession, path: str, keep: str | None = None) -> int:
    """Delete all versions but the one that counts and ``keep`` (its folder); how many they were."""
    kept = {(folder or "").rsplit("/", 1)[-1] for folder in (current_version(spark, path), keep)}
    root = _path(spark, path)
    files, gone = _files(spark, root), 0
    for found in files.listStatus(root):
        name = found.getPath().getName()
        if name.startswith("version-") and name not in kept:
            files.delete(found.getPath(), True)
            gone += 1
    return gone
