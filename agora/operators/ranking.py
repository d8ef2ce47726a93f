"""Top lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.sources.staging import stage

LEADERBOARDS = {
    # list name: (column, descending, only this score)
    "top_predicted": ("predicted_score", True, None),
    "top_actual": ("score", True, None),
    "bottom_predicted": ("predicted_score", False, None),
    "top_underperform": ("score_diff", False, None),
    "top_overperform": ("score_diff", True, None),
    "top_predicted_score_1": ("predicted_score", True, 1),
}


def _direction(column: str, desc: bool) -> Column:
    return F.desc_nulls_first(column) if desc else F.asc_nulls_first(column)


def top_n(df: DataFrame, column: str, n: int, desc: bool = True, tie: str = "id") -> DataFrame:
    """First n rows by a column, nulls in front, ties by id; every task keeps only n rows."""
    return df.orderBy(_direction(column, desc), tie).limit(n)


def bottom_n(df: DataFrame, column: str, n: int, tie: str = "id") -> DataFrame:
    return top_n(df, column, n, desc=False, tie=tie)


def with_score_diff(df: DataFrame) -> DataFrame:
    return df.withColumn("score_diff", F.col("score") - F.col("predicted_score"))


def score_leaderboards(df: DataFrame, n: int = 100) -> DataFrame:
    """Six top lists, tagged by ``list``.

    The lists are picked on ids and figures alone, staged because they are read
    six times; the other columns are fetched in one pass for the at most 6 n
    rows that made a list.  The limits tell the planner that this is little,
    so it broadcasts them.
    """
    figures = stage(
        with_score_diff(df).select("id", "score", "predicted_score", "score_diff"), "figures"
    )

    def picked(name: str) -> DataFrame:
        column, desc, only = LEADERBOARDS[name]
        pool = figures if only is None else figures.where(F.col("score") == only)
        top = top_n(pool, column, n, desc)
        return top.select(F.lit(name).alias("list"), "id")

    members = reduce(DataFrame.unionByName, [picked(name) for name in LEADERBOARDS])
    return with_score_diff(df).join(members, "id")


def report_rows(df: DataFrame) -> DataFrame:
    """Display columns: the title as a link, predicted and actual score."""
    return df.select(
        F.format_string('<a href="%s">%s</a>', "link", "title").alias("Story"),
        F.col("predicted_score").alias("Predicted Score"),
        F.col("score").alias("Actual Score"),
    )
