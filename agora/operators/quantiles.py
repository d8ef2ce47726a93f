"""Exact percentiles in two passes, without gathering a group on one task or the driver.

``percentile`` keeps every distinct value of a group in one task's memory.  Here the
first pass makes a mergeable quantile summary of every group (the one behind
``approx_percentile``), whose ranks are off by at most one part in ``ACCURACY``.  Values
a few such parts below and above a wanted place bracket the order statistics around
it.  The second pass counts what lies below each bracket and counts the values
inside, distinct ones once; a running sum over these then meets the wanted places.
A bracket holds about two in a thousand of a group's values, which one task sorts
(with spilling) and reads in order; groups of up to ``ACCURACY`` values are their
own bracket.  Groups, brackets and results are tables joined by group, so any number
of groups will do.

Infinite values are values like any others, below and above all the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.joins import attach
from agora.sources.staging import stage

ACCURACY = 10_000
#: Brackets reach so many parts of ``ACCURACY`` to either side: the summary's own error
#: and the one or two ranks by which places are rounded leave half of it unused.
_MARGIN = 8
_INF = float("inf")


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float]
) -> DataFrame:
    """``keys`` plus one double column per entry of ``probs``, named ``p0``, ``p1``, ...

    Linear interpolation between order statistics; nulls are skipped and a NaN
    makes the group's results NaN.  Between an infinite and a finite value lies
    the infinite one, between both infinities NaN.  The values are staged, so
    ``df`` is evaluated once.
    """
    return percentiles_of_staged(stage(df.select(*keys, value), "values"), keys, value, probs)


def _brackets(x: Column, probs: list[float]) -> list[Column]:
    """The group's size and, by place in ``probs``, the values around each wanted place."""
    around = [min(max(p + side * _MARGIN / ACCURACY, 0.0), 1.0) for p in probs for side in (-1, 1)]
    real = F.when(~F.isnan(x), x)
    return [
        F.count("x").alias("n"),
        F.max(F.isnan(x)).alias("has_nan"),
        F.min(real).alias("least"),
        F.max(real).alias("most"),
        F.approx_percentile(real, around, ACCURACY).alias("around"),
    ]


def percentiles_of_staged(
    df: DataFrame, keys: list[str], value: str, probs: list[float]
) -> DataFrame:
    """``exact_percentiles`` of a table that is cheap to read twice."""
    groups = [f"_g{i}" for i in range(max(len(keys), 1))]
    named = [F.col(k).alias(g) for k, g in zip(keys, groups)] or [F.lit(0).alias(groups[0])]
    values = df.select(*named, F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    spans = values.groupBy(*(groups if keys else [])).agg(*_brackets(F.col("x"), probs))
    spans = stage(spans if keys else spans.withColumn(groups[0], F.lit(0)), "spans")

    few = F.col("n") <= ACCURACY

    def bracket(i: int, p: float) -> Column:
        height = F.lit(float(p)) * (F.col("n") - 1)
        low = F.when(few | F.lit(p <= _MARGIN / ACCURACY), F.col("least")).otherwise(F.get("around", F.lit(2 * i)))
        high = F.when(few | F.lit(p >= 1 - _MARGIN / ACCURACY), F.col("most")).otherwise(F.get("around", F.lit(2 * i + 1)))
        return F.struct(
            F.lit(i).alias("prob"),
            low.alias("lo"),
            high.alias("hi"),
            F.floor(height).alias("low"),
            F.ceil(height).alias("high"),
        )

    wanted = spans.where((F.col("n") > 0) & ~F.col("has_nan")).select(
        *groups, F.array(*[bracket(i, p) for i, p in enumerate(probs)]).alias("brackets")
    )
    # below a bracket all values are one, inside they are themselves
    reached = attach(values, wanted, groups, "inner").select(*groups, "x", F.inline("brackets"))
    counts = (
        reached.where(F.col("x") <= F.col("hi"))
        .groupBy(*groups, "prob", "low", "high", F.when(F.col("x") >= F.col("lo"), F.col("x")).alias("inside"))
        .agg(F.count("x").alias("times"))
    )
    along = Window.partitionBy(*groups, "prob").orderBy(F.col("inside").asc_nulls_first())
    upto = F.sum("times").over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", upto).where("inside is not null")
    meets = lambda place: (F.col(place) < F.col("upto")) & (F.col(place) >= F.col("upto") - F.col("times"))
    picks = [
        F.max(F.when((F.col("prob") == i) & meets(place), F.col("inside"))).alias(f"_at{i}_{place}")
        for i in range(len(probs))
        for place in ("low", "high")
    ]
    found = placed.where(meets("low") | meets("high")).groupBy(*groups).agg(*picks)
    renamed = found.withColumnsRenamed({g: f"_r_{g}" for g in groups})
    same = reduce(Column.__and__, [spans[g].eqNullSafe(renamed[f"_r_{g}"]) for g in groups])
    joined = spans.join(renamed, same, "left")

    def percentile(i: int, p: float) -> Column:
        low, high = F.col(f"_at{i}_low"), F.col(f"_at{i}_high")
        height = F.lit(float(p)) * (F.col("n") - 1)
        between = low + (high - low) * (height - F.floor(height))
        one_end = F.when(low == high, low).when((low == -_INF) & (high == _INF), float("nan"))
        settled = one_end.when(low == -_INF, low).when(high == _INF, high).otherwise(between)
        missed = (F.col("n") > 0) & (low.isNull() | high.isNull())
        checked = F.when(missed, F.raise_error(F.lit("a bracket misses its place")).cast("double")).otherwise(settled)
        return F.when(F.col("has_nan"), F.lit(float("nan"))).otherwise(checked).alias(f"p{i}")

    out = [F.col(g).alias(k) for g, k in zip(groups, keys)]
    return joined.select(*out, *[percentile(i, p) for i, p in enumerate(probs)])
