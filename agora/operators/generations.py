"""The table of sampled generations, one row per validation step, and the log of steps.

The log keeps a partition per step.  Logging a step writes that partition and no other, so a
step that is run again replaces itself and earlier files stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.sources.staging import path_exists


def metrics_text(metrics: Column) -> Column:
    """``key=value`` lines of a map, in its own order."""
    lines = F.transform(
        F.map_entries(metrics), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return F.array_join(lines, "\n")


def generation_table(
    df: DataFrame, n: int, step: str = "step", order: str = "sample", fields: tuple[str, ...] = (
        "input", "output", "score", "metrics")
) -> DataFrame:
    """Per step the first n samples side by side as ``input_1, output_1, ...``.

    ``metrics`` may be a map, which prints as lines.  The rank filter is cut
    down to n rows per step before the shuffle, and the pivot values are given,
    so no extra job looks them up.
    """
    kinds = dict(df.dtypes)
    shown = [
        metrics_text(F.col(c)).alias(c) if kinds[c].startswith("map") else F.col(c) for c in fields
    ]
    first = Window.partitionBy(step).orderBy(order)
    ranked = (
        df.select(step, order, *fields)
        .withColumn("_i", F.row_number().over(first))
        .where(F.col("_i") <= n)
        .select(step, "_i", *shown)
    )
    cells = ranked.groupBy(step).agg(
        *[
            F.max(F.when(F.col("_i") == i, F.col(c))).alias(f"{c}_{i}")
            for i in range(1, n + 1)
            for c in fields
        ]
    )
    return cells


def accumulate_steps(tables: list[DataFrame]) -> DataFrame:
    """The rows of all steps logged so far."""
    return reduce(DataFrame.unionByName, tables)


def log_step(df: DataFrame, path: str, step: int) -> None:
    """Log the rows of one step; what the step logged before is replaced, even by nothing."""
    spark = df.sparkSession
    rows = df.withColumn("step", F.lit(step).cast("int"))
    if df.isEmpty():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/step={step}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("step").parquet(path)


def read_steps(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """All logged rows with their ``step``, or those of steps up to a given one; others are not read."""
    found = spark.read.parquet(path)
    return found if upto is None else found.where(F.col("step") <= upto)


def logged_steps(spark: SparkSession, path: str) -> list[int]:
    """Steps that have rows, in order."""
    if not path_exists(spark, path):
        return []
    return sorted(r[0] for r in spark.read.parquet(path).select("step").distinct().collect())
