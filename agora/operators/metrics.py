"""Error and agreement measures, each one partial aggregate away from its input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.numbers import natural_log, pearson_r, rmse_over_rows
from agora.operators.filters import drop_nan_pairs


def with_log_score(df: DataFrame, score: str = "score") -> DataFrame:
    return df.withColumn("log_score", natural_log(F.col(score)))


def metrics_by_split(
    df: DataFrame,
    label: str = "log_score",
    prediction: str = "predictions",
    split: str | list[str] = "split",
) -> DataFrame:
    """Per split: RMSE of the mean label, RMSE and correlation of the model, rows.

    Both errors divide by all rows of the split, including rows whose label or
    prediction is missing.  The first one needs no second pass for the mean:
    the squared deviations sum to variance times the labels counted.
    """
    keys = [split] if isinstance(split, str) else split
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*keys).agg(
        rmse_over_rows(F.var_pop(y) * F.count(y)).alias("baseline_rmse"),
        rmse_over_rows(F.sum(F.pow(y - p, 2))).alias("model_rmse"),
        pearson_r(y, p).alias("model_correlation"),
        F.count(F.lit(1)).alias("num_rows"),
    )


def eval_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE and correlation over the rows free of NaN."""
    y, p = F.col(label), F.col(prediction)
    return drop_nan_pairs(df, label, prediction).agg(
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"), pearson_r(y, p).alias("correlation")
    )


def with_correct(df: DataFrame) -> DataFrame:
    return df.withColumn("correct", F.col("chosen_reward") > F.col("rejected_reward"))


def correct_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("correct").agg(F.count("correct").alias("count"))


def pair_accuracy(df: DataFrame) -> DataFrame:
    """Share of pairs scored in the right order, in percent."""
    return df.agg((F.avg(F.col("correct").cast("int")) * 100).alias("accuracy"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x."""
    a, b = F.col(x), F.col(y)
    return df.agg(
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        pearson_r(a, b).alias("r_value"),
    )


def joint_range(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(
        F.least(F.min(a), F.min(b)).alias("low"), F.greatest(F.max(a), F.max(b)).alias("high")
    )


def presence_rates(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(
        F.avg(F.col("has_reasoning").cast("int")).alias("reasoning_presence_rate"),
        F.avg(F.col("has_answer").cast("int")).alias("answer_presence_rate"),
    )
