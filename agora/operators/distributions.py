"""Histograms, density grids and distribution summaries."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.numbers import bucket_of
from agora.operators.joins import attach
from agora.operators.quantiles import percentiles_of_staged
from agora.sources.staging import stage

SUMMARY_PROBS = (0.05, 0.5, 0.95)
#: A kernel reaches so many of its own deviations; what lies beyond is under 4e-6 of its peak.
KERNEL_REACH = 5.0


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def _values(df: DataFrame, column: str, *keys: str) -> DataFrame:
    return df.select(*keys, F.col(column).cast("double").alias("x")).where(_finite(F.col("x")))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``(bin, count)`` of equal-width bins between minimum and maximum.

    The values are staged and their range looked up, as one row.  Only finite
    values have a place in a range, others are not counted; empty bins have no
    row.
    """
    values = stage(_values(df, column), "values")
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    lo, hi = (F.lit(ends[name]).cast("double") for name in ("lo", "hi"))
    return values.groupBy(bucket_of(F.col("x"), lo, hi, bins).alias("bin")).agg(
        F.count("x").alias("count")
    )


def histogram_by(df: DataFrame, key: str, column: str, bins: int = 20) -> DataFrame:
    """``(key, bin, count)``, every group over its own range."""
    values = stage(_values(df, column, key), "values")
    ends = values.groupBy(key).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return (
        attach(values, ends, [key], "inner")
        .groupBy(key, bucket_of(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .agg(F.count("x").alias("count"))
    )


def density_grid(
    df: DataFrame, x: str, y: str, lo: float, hi: float, bins: int = 50
) -> DataFrame:
    """``(x_bin, y_bin, count)`` over the square from lo to hi; points outside are left out."""
    low, high = F.lit(float(lo)), F.lit(float(hi))
    cells = df.select(
        bucket_of(F.col(x).cast("double"), low, high, bins).alias("x_bin"),
        bucket_of(F.col(y).cast("double"), low, high, bins).alias("y_bin"),
    )
    return (
        cells.where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
        .groupBy("x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def density_kernel(df: DataFrame, x: str, y: str, lo: float, hi: float, points: int = 50) -> DataFrame:
    """``(x_point, y_point, density)``: a Gaussian kernel density on a square grid from lo to hi.

    The kernel has the rows' own covariance, times n ** (-1/3) (Scott's rule in two dimensions).
    Every row takes part: its weight is shared linearly by the four grid points around it, and the
    points' weights are spread over the offsets the kernel reaches.  Rows are gone after one
    aggregate; what follows is as large as the grid.  Rows around the grid count where
    their kernel reaches it.  Pairs with a null, NaN or infinite side are left out.  Without
    a covariance of full rank there is no density and no row.
    """
    pairs = stage(
        df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(
            _finite(F.col("x")) & _finite(F.col("y"))
        ),
        "values",
    )
    rows, xx, xy, yy = pairs.agg(
        F.count("x"), F.var_samp("x"), F.covar_samp("x", "y"), F.var_samp("y")
    ).first()
    empty = "x_point int, y_point int, density double"
    if rows < 2 or xx * yy - xy * xy <= 1e-12 * xx * yy:
        return df.sparkSession.createDataFrame([], empty)
    scale, step = rows ** (-1 / 3), (float(hi) - float(lo)) / points
    xx, xy, yy = xx * scale, xy * scale, yy * scale
    det = xx * yy - xy * xy
    reach = [math.ceil(KERNEL_REACH * math.sqrt(v) / step) for v in (xx, yy)]

    along = [(F.col(c) - float(lo)) / step for c in ("x", "y")]
    low = [F.floor(a) for a in along]
    part = [a - b for a, b in zip(along, low)]
    near = [((b >= -r - 1) & (b <= points + r)) for b, r in zip(low, reach)]
    corners = F.array(*[
        F.struct(
            (low[0] + i).alias("i"),
            (low[1] + j).alias("j"),
            ((part[0] if i else 1 - part[0]) * (part[1] if j else 1 - part[1])).alias("weight"),
        )
        for i in (0, 1)
        for j in (0, 1)
    ])
    cells = pairs.where(near[0] & near[1]).select(F.inline(corners)).groupBy("i", "j").agg(F.sum("weight").alias("weight"))

    def targets(at: str, r: int) -> Column:
        """Grid points a kernel at this place reaches."""
        first, last = F.greatest(F.col(at) - r, F.lit(0)), F.least(F.col(at) + r, F.lit(points))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    spread = (
        cells.where("weight > 0")
        .select("i", "j", "weight", F.explode(targets("i", reach[0])).alias("x_point"))
        .select("i", "j", "weight", "x_point", F.explode(targets("j", reach[1])).alias("y_point"))
    )
    dx, dy = (F.col("x_point") - F.col("i")) * step, (F.col("y_point") - F.col("j")) * step
    power = (yy * dx * dx - 2 * xy * dx * dy + xx * dy * dy) / (2 * det)
    peak = 1 / (rows * 2 * math.pi * math.sqrt(det))
    return spread.groupBy(F.col("x_point").cast("int").alias("x_point"), F.col("y_point").cast("int").alias("y_point")).agg(
        (F.sum(F.col("weight") * F.exp(-power)) * peak).alias("density")
    )


def _summary(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """mean, p5, median, p95 and population deviation per group."""
    df = stage(df.select(*keys, column), "values")
    shape = df.groupBy(*keys).agg(
        F.avg(column).alias("mean"), F.stddev_pop(column).alias("std_dev")
    )
    p5, median, p95 = (f"p{i}" for i in range(3))
    cuts = percentiles_of_staged(df, keys, column, list(SUMMARY_PROBS)).select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col(p5).alias("p5"),
        F.col(median).alias("median"),
        F.col(p95).alias("p95"),
    )
    same = [shape[k].eqNullSafe(cuts[f"_{k}"]) for k in keys]
    on = reduce(Column.__and__, same, F.lit(True))
    # One row per group on both sides.
    joined = shape.join(cuts, on, "left")
    return joined.select(*keys, "mean", "p5", "median", "p95", "std_dev")


def distribution_summary(df: DataFrame, column: str) -> DataFrame:
    return _summary(df, [], column)


def metric_summaries(df: DataFrame, map_col: str) -> DataFrame:
    """The same figures for every key found in a map column."""
    entries = df.select(F.explode(map_col).alias("metric", "value"))
    return _summary(entries, ["metric"], "value")
