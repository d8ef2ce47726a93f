"""Keyed result table: compute a function's value once per argument set.

The table is an append-only Parquet log.  A row holds the argument hash, the value as
JSON text and the version (driver clock, in nanoseconds) at which it was written.  It is
partitioned by ``fn_id`` and by the first digits of the hash, and each append writes
one file a partition, in order of the hash: a reader that knows which hashes it wants
opens the partitions they can be in and no others.

Evicting appends a marker instead of rewriting files: a marker with a hash hides older
rows of that key, one without a hash hides everything older of that function, and one
under ``ALL_FUNCTIONS`` hides everything older in the table.  Markers without a hash have
a partition of their own.  Readers therefore never meet a half-replaced file, and a lost
executor costs a task retry only.  Partitions that many appends have left with many
files are compacted one by one: their visible rows are written beside them, with the
versions they have, and the files they came from go afterwards; what is read in between
holds some rows twice, which changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import schemas
from agora.operators.joins import attach
from agora.operators.scoring import batch_score
from agora.sources.memo import table_exists
from agora.sources.staging import stage, stage_steps

DIRECT_FN = "__direct"
ALL_FUNCTIONS = "__all"
#: Part of the format: so many hexadecimal digits of the hash name a partition.
HASH_DIGITS = 2
NO_HASH = "none"
#: Partitions with more files than this are worth compacting.
MAX_FILES = 32


def arg_hash(df: DataFrame, arg_cols: list[str] | tuple[str, ...]) -> Column:
    """SHA-256 over the arguments, each with its length in front; null is a value of its own."""
    def marked(name: str) -> Column:
        kind = df.schema[name].dataType
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        value = F.to_json(name) if nested else F.col(name).cast("string")
        sized = F.concat(F.length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(sized, F.lit("null,"))

    return F.sha2(F.concat(*[marked(name) for name in arg_cols]), 256)


def hash_part(key: Column) -> Column:
    """The partition of a hash."""
    return F.coalesce(F.substring(key, 1, HASH_DIGITS), F.lit(NO_HASH))


class ResultStore:
    """The log at one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _log(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schemas.RESULT_LOG)
        return self.spark.read.schema(schemas.RESULT_LOG).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        """Append ``(fn_id, arg_hash, result, evicted)`` rows under a new version."""
        self._write(rows.withColumn("version", F.lit(time.time_ns())))

    def _write(self, rows: DataFrame) -> None:
        placed = rows.withColumn("hash_part", hash_part(F.col("arg_hash"))).select(*schemas.RESULT_LOG.fieldNames())
        (
            placed.repartition("fn_id", "hash_part")
            .sortWithinPartitions("fn_id", "hash_part", "arg_hash")
            .write.mode("append")
            .partitionBy("fn_id", "hash_part")
            .parquet(self.path)
        )

    def _append_one(self, fn_id: str, key: str | None, result: str | None, evicted: bool) -> None:
        row = self.spark.createDataFrame(
            [(key, result, evicted, fn_id)], "arg_hash string, result string, evicted boolean, fn_id string"
        )
        self.append(row)

    def compacted(self, path: str) -> ResultStore:
        """A new log at ``path`` with the visible rows alone; this one stays as it is."""
        log = self._log()
        marks = log.where(F.col("arg_hash").isNull()).groupBy("fn_id").agg(F.max("version").alias("floor"))
        everything = marks.where(F.col("fn_id") == ALL_FUNCTIONS).agg(F.coalesce(F.max("floor"), F.lit(0))).scalar()
        rows = (
            log.where(F.col("arg_hash").isNotNull())
            .join(marks, "fn_id", "left")
            .where(F.col("version") > F.greatest(F.coalesce("floor", F.lit(0)), everything))
            .groupBy("fn_id", "arg_hash")
            .agg(F.max_by(F.struct("result", "evicted"), "version").alias("last"))
            .where(~F.col("last.evicted"))
        )
        other = ResultStore(self.spark, path)
        other.append(rows.select("fn_id", "arg_hash", "last.result", "last.evicted"))
        return other

    def _rows_of(self, fn_id: str) -> DataFrame:
        """Rows with a hash that no marker of the function or of the whole table hides."""
        log = self._log().where(F.col("fn_id").isin(fn_id, ALL_FUNCTIONS))
        floor = (
            log.where(F.col("hash_part") == NO_HASH)
            .agg(F.coalesce(F.max("version"), F.lit(0)).alias("floor"))
            .scalar()
        )
        return log.where((F.col("hash_part") != NO_HASH) & (F.col("version") > floor))

    def live(self, fn_id: str, wanted: DataFrame | None = None) -> DataFrame:
        """Visible ``(arg_hash, result)`` rows of one function.

        ``wanted`` (with an ``arg_hash``) names the partitions to open and cuts their rows
        down before they are grouped; there are at most ``16 ** HASH_DIGITS`` names.  The join
        repeats rows that are wanted more than once, which the grouping undoes; unlike a
        semi-join it lets the planner broadcast whichever side is small.
        """
        rows = self._rows_of(fn_id)
        if wanted is not None:
            parts = wanted.select(hash_part(F.col("arg_hash"))).distinct().collect()
            rows = rows.where(F.col("hash_part").isin([x[0] for x in parts]))
            rows = rows.join(wanted.select("arg_hash"), "arg_hash")
        return (
            rows.groupBy("arg_hash")
            .agg(F.max_by(F.struct("result", "evicted"), "version").alias("last"))
            .where(~F.col("last.evicted"))
            .select("arg_hash", F.col("last.result").alias("result"))
        )

    def compact(self, fn_id: str, max_files: int = MAX_FILES) -> list[str]:
        """Rewrite the function's partitions with more than ``max_files`` files; their names."""
        files: dict[str, list[str]] = {}
        for file in self._log().where((F.col("fn_id") == fn_id) & (F.col("hash_part") != NO_HASH)).inputFiles():
            files.setdefault(file.rsplit("/", 2)[1].partition("=")[2], []).append(file)
        full = sorted(part for part, own in files.items() if len(own) > max_files)
        if not full:
            return []
        old = [file for part in full for file in files[part]]
        listed = self.spark.read.schema(schemas.RESULT_LOG).option("basePath", self.path).parquet(*old)
        floor = self._log().where(
            F.col("fn_id").isin(fn_id, ALL_FUNCTIONS) & (F.col("hash_part") == NO_HASH)
        ).agg(F.coalesce(F.max("version"), F.lit(0)).alias("floor")).scalar()
        last = listed.groupBy("arg_hash").agg(F.max_by(F.struct("result", "evicted", "version"), "version").alias("last"))
        visible = last.where(~F.col("last.evicted") & (F.col("last.version") > floor))
        self._write(visible.select(F.lit(fn_id).alias("fn_id"), "arg_hash", "last.result", "last.evicted", "last.version"))
        for file in old:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)
        return full


def key_rows(
    df: DataFrame, arg_cols: list[str], read: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Staged rows with their ``arg_hash``: texts are hashed once, for all functions of the same arguments.

    Rows that have an ``arg_hash`` stay as they are.
    """
    if "arg_hash" in df.columns:
        return df
    # texts that lie apart are moved step by step, which bounds the scratch disk
    parts = [df] if read is None else read.steps(df) if hasattr(read, "steps") else [read(df)]
    keyed = [part.withColumn("arg_hash", arg_hash(part, arg_cols)).select(*df.columns, "arg_hash") for part in parts]
    return stage(keyed[0], "keyed") if len(keyed) == 1 else stage_steps(keyed, "keyed")


def score_incremental(
    df: DataFrame,
    fn_id: str,
    arg_cols: list[str],
    scorer: Callable,
    store: ResultStore,
    text_col: str,
    cache_only: bool = False,
    refresh: bool = False,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Attach ``score`` and ``error``, running the scorer only on unseen arguments.

    Rows with equal arguments are scored once, however many copies there are.
    Failures are reported in ``error`` and never stored.  ``cache_only`` makes
    any miss an error; ``refresh`` recomputes everything.  ``df`` may come from ``key_rows``.  Where texts are stored apart,
    ``read`` adds them to rows of ``df``: texts are then read twice, to be hashed and
    to be scored, and never stored; the result has no texts.  A ``read`` with ``steps`` and
    ``only``, such as ``TextReader``, moves a part of the texts at a time, and those to be scored alone.
    """
    keyed = key_rows(df, arg_cols, read)
    hashes = keyed.select("arg_hash").distinct()
    # Misses are found on hashes alone; when they are few, the planner can
    # broadcast them and texts that were scored before are not moved.
    known = None
    if refresh:
        missing = hashes
    else:
        found = store.live(fn_id, keyed.select("arg_hash")).withColumn("known", F.lit(True))
        judged = stage(attach(hashes, found, ["arg_hash"]), "hashes")
        known, missing = judged.where("known"), judged.where("known is null").select("arg_hash")
    if cache_only and not missing.isEmpty():
        raise KeyError(f"result table has no value for some arguments of {fn_id}")
    needed = F.struct(*([text_col] if read is None else [c for c in df.columns if c != "arg_hash"])).alias("row")
    unseen = keyed.select("arg_hash", needed).join(missing, "arg_hash", "left_semi")
    once = unseen.groupBy("arg_hash").agg(F.first("row").alias("row")).select("arg_hash", "row.*")
    if hasattr(read, "only"):  # of all rows that may be the first
        read = read.only(unseen.select("row.*"))
    todo = once if read is None else read(once)
    fresh = stage(batch_score(todo, "arg_hash", text_col, scorer), "scores")
    done = fresh.where(F.col("error").isNull() & F.col("score").isNotNull())
    store.append(
        done.select(
            F.lit(fn_id).alias("fn_id"),
            "arg_hash",
            F.col("score").cast("string").alias("result"),
            F.lit(False).alias("evicted"),
        )
    )
    values = fresh.select("arg_hash", "score", "error")
    if known is not None:  # known and fresh hashes never meet
        stored = F.col("result").cast("double").alias("score")
        values = known.select("arg_hash", stored, F.lit(None).cast("string").alias("error")).unionByName(values)
    return attach(keyed, values, ["arg_hash"])


def lookup_results(
    df: DataFrame, fn_id: str, arg_cols: list[str], store: ResultStore,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Attach ``hit`` and ``score`` without computing anything; ``df`` and ``read`` as in ``score_incremental``."""
    keyed = key_rows(df, arg_cols, read)
    # staged, so that rows and their hashes are not moved to meet a few values
    values = stage(store.live(fn_id, keyed.select("arg_hash")), "values").withColumn("hit", F.lit(True))
    return (
        attach(keyed, values, ["arg_hash"])
        .withColumn("hit", F.coalesce("hit", F.lit(False)))
        .withColumn("score", F.col("result").cast("double"))
        .drop("result")
    )


def evict_results(
    store: ResultStore, fn_id: str | None = None, keys: DataFrame | None = None
) -> None:
    """Forget some keys of a function, a whole function, or everything.

    ``keys`` holds an ``arg_hash`` column.
    """
    if fn_id is None:
        store._append_one(ALL_FUNCTIONS, None, None, True)
    elif keys is None:
        store._append_one(fn_id, None, None, True)
    else:
        store.append(
            keys.select(
                F.lit(fn_id).alias("fn_id"),
                "arg_hash",
                F.lit(None).cast("string").alias("result"),
                F.lit(True).alias("evicted"),
            )
        )


def _direct_key(key: str) -> str:
    return hashlib.sha256(key.encode()).hexdigest()


def put_result(store: ResultStore, key: str, value) -> None:
    """Set a value directly under a string key; a later value wins."""
    store._append_one(DIRECT_FN, _direct_key(key), json.dumps(value), False)


def get_result(store: ResultStore, key: str):
    """Value under a string key; a missing key is an error."""
    wanted = store.spark.createDataFrame([(_direct_key(key),)], "arg_hash string")
    row = store.live(DIRECT_FN, wanted).first()
    if row is None:
        raise KeyError(key)
    return json.loads(row["result"])
