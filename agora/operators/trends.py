"""Counts and means over values and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str, pct: bool = False) -> DataFrame:
    """Rows per value, largest first; ``pct`` adds the share in percent, 2 digits."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if pct:
        total = df.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("percent", F.round(F.col("count") / total * 100, 2))
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(column))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def _period(unit: str, column: str):
    if unit == "quarter":
        return F.date_trunc("quarter", F.col(column)).cast("timestamp_ntz").alias("year_quarter")
    if unit == "month":
        return F.date_format(column, "yyyy-MM").alias("month")
    raise ValueError(f"unknown period {unit!r}")


def count_by_period(
    df: DataFrame,
    unit: str,
    column: str = "time",
    alias: str = "num_stories",
    mean_of: str | None = None,
    mean_alias: str = "avg_score",
) -> DataFrame:
    """Rows with an id per quarter (its first moment) or month (``yyyy-MM``).

    ``mean_of`` adds the mean of a column in the same pass.
    """
    figures = [F.count("id").alias(alias)]
    if mean_of is not None:
        figures.append(F.avg(mean_of).alias(mean_alias))
    grouped = df.groupBy(_period(unit, column)).agg(*figures)
    return grouped.orderBy(grouped.columns[0])


def mean_by_period(
    df: DataFrame, unit: str, value: str = "score", column: str = "time", alias: str = "avg_score"
) -> DataFrame:
    grouped = df.groupBy(_period(unit, column)).agg(F.avg(value).alias(alias))
    return grouped.orderBy(grouped.columns[0])


def mean_by_group(df: DataFrame, key: str, value: str, alias: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(alias))
