"""Row filters.  All are plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import fixed_values as fixed


def _moment(value: str | dt.datetime):
    return F.lit(value).cast(T.TimestampNTZType())


def filter_stories_with_text(items: DataFrame) -> DataFrame:
    """Stories that have a time and a text."""
    return items.where(
        (F.col("type") == "story") & F.col("time").isNotNull() & F.col("text").isNotNull()
    )


def filter_text_stories(items: DataFrame) -> DataFrame:
    """Live text posts: as above, without a url and neither deleted nor dead."""
    return filter_stories_with_text(items).where(
        F.col("url").isNull() & F.col("deleted").isNull() & F.col("dead").isNull()
    )


def filter_time_range(
    df: DataFrame, ge=None, gt=None, lt=None, column: str = "time"
) -> DataFrame:
    time = F.col(column)
    for bound, test in ((ge, time.__ge__), (gt, time.__gt__), (lt, time.__lt__)):
        if bound is not None:
            df = df.where(test(_moment(bound)))
    return df


def filter_calendar(
    df: DataFrame, year: int, month: int | None = None, op: str = "==", column: str = "time"
) -> DataFrame:
    """Rows of a year or of a month, or of a year and later (``op=">="``).

    Written as a time range, which Parquet statistics can use and ``year()``
    cannot.
    """
    start = dt.datetime(year, month or 1, 1)
    if op == ">=":
        return filter_time_range(df, ge=start, column=column)
    if op != "==":
        raise ValueError(f"unsupported comparison {op!r}")
    if month is None or month == 12:
        end = dt.datetime(year + 1, 1, 1)
    else:
        end = dt.datetime(year, month + 1, 1)
    return filter_time_range(df, ge=start, lt=end, column=column)


def filter_min_score(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("score") >= n)


def filter_sibling_band(
    df: DataFrame, lo: int = fixed.MIN_SIBLINGS, hi: int = fixed.MAX_SIBLINGS
) -> DataFrame:
    return df.where((F.col("siblings_count") >= lo) & (F.col("siblings_count") < hi))


def filter_usable_text(df: DataFrame, min_chars: int = fixed.MIN_TEXT_CHARS) -> DataFrame:
    """Ranked comments whose text is longer than ``min_chars`` characters."""
    return df.where((F.char_length("text") > min_chars) & (F.col("sibling_rank") > 0))


def filter_scraped_ok(df: DataFrame) -> DataFrame:
    return df.where((F.col("scraping_error") == "no_error") & F.col("text").isNull())


def exclude_title_containing(df: DataFrame, piece: str = fixed.HIRING_TITLE) -> DataFrame:
    """Case-sensitive; rows without a title leave as well."""
    return df.where(~F.contains(F.col("title"), F.lit(piece)))


def filter_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("type") == kind)


def filter_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def filter_score_eq(df: DataFrame, score: int) -> DataFrame:
    return df.where(F.col("score") == score)


def drop_nan_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where neither value is NaN or missing."""
    def usable(name):
        return F.col(name).isNotNull() & ~F.isnan(name)

    return df.where(usable(a) & usable(b))
