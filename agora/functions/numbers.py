"""Number expressions with explicit null, zero and NaN behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nan() -> Column:
    return F.lit(float("nan"))


def natural_log(value: Column) -> Column:
    """ln with the IEEE edge values: 0 gives -inf, negatives give NaN, null stays null."""
    v = value.cast("double")
    return (
        F.when(v == 0, F.lit(float("-inf"))).when(v < 0, _nan()).otherwise(F.ln(v))
    )


def score_from_log(prediction: Column) -> Column:
    """exp of a log prediction as a whole number, truncated; NaN and overflow give null."""
    return F.exp(prediction).try_cast("bigint")


def pearson_r(x: Column, y: Column) -> Column:
    """Aggregate: Pearson r over the complete pairs, NaN where it is undefined.

    ``corr`` divides by zero on a constant column, which ANSI mode turns into a
    failed query.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.coalesce(F.try_divide(F.covar_pop(px, py), spread), _nan())


def rmse_over_rows(squared_error_sum: Column) -> Column:
    """Aggregate: root of a summed squared error over all rows, nulls included."""
    return F.sqrt(squared_error_sum / F.count(F.lit(1)))


def bucket_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bucket between low and high; the last bucket is closed.

    A zero-width range is widened by one half on each side, as plotting
    libraries do.  Values outside the range give null.
    """
    lo = F.when(low == high, low - 0.5).otherwise(low).cast("double")
    hi = F.when(low == high, high + 0.5).otherwise(high).cast("double")
    number = F.least(
        F.floor((value - lo) / (hi - lo) * bins).cast("int") + 1, F.lit(bins)
    )
    return F.when((value >= lo) & (value <= hi), number)
