"""What several operators share: inputs, held-out rows, running starts, Arrow loops."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.operators.joins import running_start  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(key: Column, parts: int) -> Column:
    """crc32 of an id's decimal digits modulo ``parts``; null for a null id."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts)).cast("int")


def spread(*columns: Column) -> Column:
    """A pseudorandom long that only depends on the values."""
    return F.xxhash64(*columns)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (x for x in source if x.num_rows)


def fitting_rows(bags: DataFrame, order: list[str], size: str, budget: int, both: Column) -> pa.Table:
    """Rows to fit on, gathered: in ``order``, until their sizes add up to ``budget``.

    Rows of more than a hundredth of the budget stay out, so that none shuts out the rows behind
    it; where they are needed to have rows with and without ``both``, they compete like the others.
    """
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = None
    for most in (max(1, budget // 100), budget):
        few = bags.where(F.col(size) <= most).withColumn("_upto", F.sum(size).over(upto))
        found = few.where(F.col("_upto") <= budget).withColumn("_both", both).drop("_upto").toArrow()
        if len(set(found.column("_both").to_pylist()) - {None}) > 1:
            break
    return found.drop_columns(["_both"])
