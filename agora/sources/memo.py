"""Build-once tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.sources.staging import path_exists
from agora.sources.versions import current_version, publish, read_published


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a finished write is present; a half-written folder is not one."""
    return path_exists(spark, f"{path}/_SUCCESS")


def drop_table(spark: SparkSession, path: str) -> None:
    """Invalidate a table made by ``materialize``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    refresh: bool = False,
) -> DataFrame:
    """Read the table at ``path``; build and publish it first when it is missing.

    With ``refresh`` the new table replaces the old one in one step, once it is whole.
    """
    if refresh or current_version(spark, path) is None:
        publish(build(), path)
    return read_published(spark, path)


def resume_predictions(
    df: DataFrame,
    path: str,
    score: Callable[[DataFrame], DataFrame],
    columns: tuple[str, ...] = ("id", "log_score", "split"),
) -> DataFrame:
    """Join saved predictions by id, scoring and saving them on the first run.

    ``score`` maps the table to ``(id, predictions)``.  The join is inner: rows
    without a saved prediction leave the result.
    """
    saved = materialize(
        df.sparkSession, path, lambda: score(df).select("id", "predictions")
    )
    return df.select(*[F.col(c) for c in columns]).join(saved, "id")
