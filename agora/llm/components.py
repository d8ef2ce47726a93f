"""Connected components by alternating large and small stars.

Each round joins every node to the smallest node it has seen: first among its
larger neighbours, then among its smaller ones.  The number of rounds grows with
the logarithm of the longest path.  Neighbourhoods are never gathered: minima are
partial aggregates, joined back to the links.  Rounds are cut by staged tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.sources.staging import stage


def _star(links: DataFrame) -> DataFrame:
    """Join neighbours to the smallest of their neighbourhood, larger ones first, then the smaller ones."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = large.where(F.col("a") != F.col("b")).distinct()  # a > b from here on
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(low, "a")
    moved = small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Nodes that have links, with the smallest node they reach: node, label.  ``links`` has a and b."""
    now = stage(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    mark = None
    while True:
        digest = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if digest == mark:
            break
        mark = digest
        now = stage(_star(now), "links")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
