"""Joins by key.

The streamed (left) side is the one that may hold hot keys; the other side is
unique per key.  That shape needs no salting by hand: adaptive execution can
split a hot partition of the streamed side and repeat the single matching row.
It can do so only where both sides of the join come straight out of a shuffle.
An aggregate joined back on its own keys does not, as its partitioning is
reused; ``attach`` is the join for that case.

Nothing is broadcast by hand: the planner does so on measured sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def attach(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join facts that were aggregated per key to all rows of their key.

    Null keys match each other.  The null-safe comparison also makes the
    planner shuffle the facts anew instead of building on the aggregate's
    partitioning, and so leaves hot partitions open to being split.
    """
    named = facts.withColumnsRenamed({key: f"_fact_{key}" for key in keys})
    same = [df[key].eqNullSafe(named[f"_fact_{key}"]) for key in keys]
    return df.join(named, reduce(Column.__and__, same), how).drop(*[f"_fact_{k}" for k in keys])


def running_start(df: DataFrame, group: list[str], within: str, order: list, size: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``size`` over all earlier rows of the same group.

    Rows come in the order of ``within`` (an integer that deals a group into
    pieces small enough for one task) and then of ``order``.  Only the pieces'
    totals are summed along a whole group, so no task holds a large group.
    """
    totals = df.groupBy(*group, within).agg(F.sum(size).alias("_total"))
    along = Window.partitionBy(*group).orderBy(within).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*group, within, F.coalesce(F.sum("_total").over(along), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    added = df.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, within]]
    joined = added.alias("l").join(bases.alias("r"), match, "left")
    kept = [F.col(f"l.{c}") for c in df.columns]
    return joined.select(*kept, (F.col("r._base") + F.col("l._inside")).cast("long").alias(out))


def _keys(ids: DataFrame, column: str) -> DataFrame:
    """The first column of ``ids`` under the name to join on."""
    return ids.select(F.col(ids.columns[0]).alias(column))


def keep_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose value occurs in the id table."""
    return df.join(_keys(ids, column), column, "left_semi")


def exclude_in(df: DataFrame, column: str, *ids: DataFrame) -> DataFrame:
    """Rows whose value occurs in none of the id tables; null values leave."""
    gone = reduce(DataFrame.unionByName, [_keys(part, column) for part in ids])
    return df.where(F.col(column).isNotNull()).join(gone, column, "left_anti")


def with_story_info(comments: DataFrame, items: DataFrame) -> DataFrame:
    """Add title and url of the story each comment belongs to."""
    stories = items.where(F.col("type") == "story").select(
        F.col("id").alias("top_level_parent"),
        F.col("title").alias("story_title"),
        F.col("url").alias("story_url"),
    )
    return comments.join(stories, "top_level_parent", "left")


def join_metrics(left: DataFrame, right: DataFrame, on: str = "split") -> DataFrame:
    return left.join(right, on)


def cross_models(items: DataFrame, models: list[str]) -> DataFrame:
    """Every item once per model.

    The models are an argument list, so they travel inside the plan as an
    array and each row is repeated in place; no join takes place.
    """
    names = F.array(*[F.lit(name) for name in models]).cast(T.ArrayType(T.StringType()))
    return items.withColumn("model", F.explode(names))
