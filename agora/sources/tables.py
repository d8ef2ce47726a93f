"""Table sources and sinks.  Paths may be local or any Hadoop file system.

Tables and split sets are published as versions: a new one is written beside the old one and
then takes its place in one step.  Readers here find the version that counts, or read a
plain folder where nothing was published.  The version before stays for readers that have
started; older ones go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import schemas
from agora.sources.versions import current_version, prune, publish


def _folder(spark: SparkSession, path: str) -> str:
    return current_version(spark, path) or path


def _replace(df: DataFrame, path: str, write=None) -> None:
    before = current_version(df.sparkSession, path)
    publish(df, path, write)
    prune(df.sparkSession, path, keep=before)


def scan_items(spark: SparkSession, path: str) -> DataFrame:
    """The full item table; a missing column or another type is an error."""
    found = schemas.require_columns(spark.read.parquet(_folder(spark, path)), schemas.ITEMS)
    return found.select(*schemas.ITEMS.fieldNames())


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Any Parquet table; a schema, when given, saves the footer inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_folder(spark, path))


def scan_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table written by ``write_splits``; other splits are not read."""
    return spark.read.parquet(_folder(spark, path)).where(F.col("split") == split)


def scan_results_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested benchmark results."""
    return spark.read.schema(schemas.NESTED_RESULTS).json(path)


def write_table(df: DataFrame, path: str) -> None:
    """Publish the table; a failed write leaves the old one as it was."""
    _replace(df, path)


def write_splits(
    df: DataFrame, path: str, renames: dict[str, str] | None = None
) -> None:
    """All splits as one dataset with a folder per split.

    ``renames`` maps split labels to the labels on disk, such as
    ``{"val": "validation"}``.
    """
    label = F.col("split")
    for old, new in (renames or {}).items():
        label = F.when(F.col("split") == old, F.lit(new)).otherwise(label)
    tagged = df.withColumn("split", label)
    _replace(tagged, path, lambda rows, folder: rows.write.partitionBy("split").parquet(folder))


def write_csv_report(df: DataFrame, path: str) -> None:
    """A ranked report as CSV with a header; quotes are doubled, whitespace is kept.

    A report that was sorted and limited is one file, any other as many as it has partitions.
    """
    df.write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def scan_csv_report(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> DataFrame:
    """Read a report back; a null mark that no text holds keeps empty texts from turning null."""
    return spark.read.csv(
        path, schema=schema, header=True, quote='"', escape='"', multiLine=True, nullValue="\0"
    )


def write_results_json(df: DataFrame, path: str) -> None:
    """One JSON document per row, null fields written out."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def union_splits(parts: dict[str, DataFrame]) -> DataFrame:
    """Tag each part with its split label and stack them."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)
