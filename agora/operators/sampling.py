"""Deterministic splits, shuffles and samples.

Random order is an expression of the row's key and a seed, so it survives
retries and does not depend on partitioning.  Taking n rows means finding the
key value of the n-th row first and filtering by it: the wide rows are never
sorted, shuffled or gathered.  The key is looked for in two or three passes
over the id column, so stage an input whose ids are costly to compute.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora import fixed_values as fixed

_SPACE = 2.0**32


def hash_unit(key: Column, seed: int = fixed.SAMPLE_SEED) -> Column:
    """A number in [0, 1) from the first 32 bits of md5 over ``seed:key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / _SPACE


def split_label(
    key: Column, weights=fixed.SPLIT_WEIGHTS, seed: int = fixed.SAMPLE_SEED
) -> Column:
    """Split of a key by its hash; a null key belongs to no split and gets null."""
    unit, label, upto = hash_unit(key, seed), None, 0.0
    for name, weight in weights[:-1]:
        upto = round(upto + weight, 9)
        test = unit < upto
        label = F.when(test, name) if label is None else label.when(test, name)
    last = F.lit(weights[-1][0])
    return F.when(unit.isNotNull(), last if label is None else label.otherwise(last))


def split_by_group(
    df: DataFrame, key: str, weights=fixed.SPLIT_WEIGHTS, seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """Add ``split`` by group key; rows of a group always share it."""
    return df.withColumn("split", split_label(F.col(key), weights, seed))


def split_rows(
    df: DataFrame, id_col: str = "id", weights=fixed.SPLIT_WEIGHTS, seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    return split_by_group(df, id_col, weights, seed)


def with_shuffle_key(df: DataFrame, id_col: str = "id", seed: int = fixed.SAMPLE_SEED) -> DataFrame:
    """Add ``shuffle_key``: sorting by it (then by id) is a full shuffle."""
    return df.withColumn("shuffle_key", hash_unit(F.col(id_col), seed))


def _counts(keys: DataFrame) -> dict[str, int]:
    rows = keys.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).collect()
    return {row["grp"]: row["rows"] for row in rows}


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def _nth_keys(keys: DataFrame, sizes: dict[str, int]) -> dict[str, tuple | None]:
    """(u, id) of the n-th row in each group of ``(grp, u, id)``; None where rows run out.

    Hash units are uniform, so the n-th of N lies close to n/N and only rows in
    a narrow window around there are ordered; those below it are merely counted.
    Should a window miss the row, it is widened and the step repeated, until it
    covers all units.  Rows without id have no unit and are no part of a sample.
    """
    wanted = {g: n for g, n in sizes.items() if n > 0}
    keys = keys.where(F.col("u").isNotNull())
    totals = _counts(keys.where(F.col("grp").isin(list(wanted))))
    found: dict[str, tuple | None] = {g: None for g, n in wanted.items() if totals.get(g, 0) <= n}
    todo = {g: 8 * n**0.5 + 32 for g, n in wanted.items() if g not in found}
    grp, u = F.col("grp"), F.col("u")
    while todo:
        windows = {
            g: (
                max(0.0, (wanted[g] - margin) / totals[g]),
                (wanted[g] + margin) / totals[g],
            )
            for g, margin in todo.items()
        }
        lower = [(grp == g) & (u < lo) for g, (lo, _) in windows.items() if lo > 0]
        below = _counts(keys.where(_any(lower))) if lower else {}
        parts = [
            keys.where((grp == g) & (u >= lo) & (u < hi))
            .orderBy("u", "id")
            .offset(wanted[g] - 1 - below.get(g, 0))
            .limit(1)
            for g, (lo, hi) in windows.items()
            if below.get(g, 0) < wanted[g]
        ]
        rows = reduce(DataFrame.union, parts).collect() if parts else []
        found |= {row["grp"]: (row["u"], row["id"]) for row in rows}
        todo = {g: margin * 4 for g, margin in todo.items() if g not in found}
    return found


def _up_to(unit: Column, id_col: Column, last: tuple | None) -> Column:
    if last is None:
        return unit.isNotNull()
    u, key = last
    return (unit < u) | ((unit == u) & (id_col <= key))


def sample_n(
    df: DataFrame, n: int, id_col: str = "id", seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """Exactly n rows (all of them when there are fewer), the first n in shuffled order."""
    if n <= 0:
        return df.limit(0)
    unit = hash_unit(F.col(id_col), seed)
    keys = df.select(F.lit("all").alias("grp"), unit.alias("u"), F.col(id_col).alias("id"))
    last = _nth_keys(keys, {"all": n})["all"]
    return df.where(_up_to(unit, F.col(id_col), last))


def sample_per_split(
    df: DataFrame,
    sizes: dict[str, int],
    id_col: str = "id",
    split: str = "split",
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """The first ``sizes[s]`` rows of each split in shuffled order; other splits leave."""
    unit = hash_unit(F.col(id_col), seed)
    keys = df.select(F.col(split).alias("grp"), unit.alias("u"), F.col(id_col).alias("id"))
    last = _nth_keys(keys, sizes)
    wanted = [
        (F.col(split) == name) & _up_to(unit, F.col(id_col), last[name])
        for name, n in sizes.items()
        if n > 0
    ]
    return df.where(_any(wanted))


def head_of_split(
    df: DataFrame, split: str, n: int, id_col: str = "id", seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """First n rows of one split in shuffled order."""
    return sample_per_split(df, {split: n}, id_col, seed=seed)


def take_first(
    df: DataFrame, n: int, id_col: str = "id", seed: int = fixed.SAMPLE_SEED
) -> DataFrame:
    """First n rows in shuffled order, after whatever filter made ``df``."""
    return sample_n(df, n, id_col, seed)


#: Shuffle and take the first n are one step here.
shuffle_take = sample_n

#: Folders of a shuffled table; a prefix of the order is a prefix of the folders.
SHUFFLE_PARTS = 64


def write_shuffled(
    df: DataFrame, path: str, id_col: str = "id", split: str | None = None,
    parts: int = SHUFFLE_PARTS, seed: int = fixed.SAMPLE_SEED,
) -> None:
    """Store a table in shuffled order: a folder for each range of shuffle keys, rows in order of key and id.

    Keys are uniform, so folders (under each value of ``split``, if given) are of equal size
    whatever the ids are like.  Rows without id have no key; they lie in a folder behind all others.
    """
    keyed = with_shuffle_key(df, id_col, seed)
    part = F.coalesce(F.floor(F.col("shuffle_key") * parts), F.lit(parts)).cast("int")
    folders = ([split] if split else []) + ["shuffle_part"]
    placed = keyed.withColumn("shuffle_part", part).repartition(*folders)
    # rows without id are dealt on by their other columns' place, not by a key they do not have
    placed.sortWithinPartitions(*folders, "shuffle_key", id_col).write.partitionBy(*folders).parquet(path)


def read_shuffled(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A table stored by ``write_shuffled``, without the columns that say where its rows lie."""
    found = spark.read.parquet(path)
    return (found if split is None else found.where(F.col("split") == split)).drop("shuffle_part")


def head_of_shuffled(
    spark: SparkSession, path: str, n: int, id_col: str = "id", split: str | None = None, split_col: str = "split"
) -> DataFrame:
    """The first n rows of the stored order, of one split if given; only the folders they lie in are read.

    How many rows a folder holds comes from the files' footers.
    """
    found = spark.read.parquet(path)
    if split is not None:
        found = found.where(F.col(split_col) == split)
    keyed = found.where(F.col("shuffle_key").isNotNull())
    sizes = found.groupBy("shuffle_part").agg(F.count("*").alias("rows")).orderBy("shuffle_part").collect()
    last, rows = -1, 0
    for size in sizes:
        if rows >= n:
            break
        last, rows = size["shuffle_part"], rows + size["rows"]
    near = keyed.where(F.col("shuffle_part") <= last)
    return near.orderBy("shuffle_key", id_col).limit(n).drop("shuffle_part")
