"""Exact top-k search with M-trees.

Rows are dealt by a hash into trees of about ``tree_rows`` vectors, each one row of
a table.  A tree is made of pages of at most ``page_rows`` entries under metric
nodes; a node stores a routing vector, its covering radius and its distance to the
parent's routing vector, an entry its distance to the page's.

Large inner products become small distances by one more coordinate: with M the
largest squared length in a tree, x' = (x, sqrt(M - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + M - 2 q.x.  The search keeps nodes in a queue by the least
distance that anything below them can have, and opens the nearest first.  By the
triangle inequality a node or entry is left out, without computing its distance,
when |d(q, parent) - d(entry, parent)| already puts it beyond the k-th best so far.
Bounds are compared with a margin of half a unit of score, more than rounding can
make of them, and scores are integer products, so results are exact and ties go to
the smaller id.

Queries are a stated set.  They are packed into blocks of ``block_queries``; a task
holds a few trees and meets one block after the other, so each block meets each tree once,
and the best k of all trees are merged per query.  A row is never its own partner; two rows that share an id are one
another's partner unless they are the same id.

Vectors that are null or hold a null or a value that is not finite take no part,
nor do rows without id.  Shorter vectors count as padded with zeros.  Repeated
rows are candidates each.  Empty tables give an empty result.  The trees hold rows whose
components are within 2**20 after scaling, where the arithmetic of bounds and scores is
exact.  Rows and queries beyond that are met apart, in the shards of ``multi_index``,
which score them in Python integers; a score outside of 64 bits is given as the nearest
64-bit value.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.llm.common import batches, shuffle_parts
from agora.llm.multi_index import Index, usable_rows
from agora.sources.staging import stage

TREE_ROWS = 8192
PAGE_ROWS = 512
FANOUT = 16
BLOCK_QUERIES = 256
#: Trees that a task holds at once, and copies of a tree where there are few of them.
TASK_TREES = 16
MOST_SHARES = 3


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    if len({len(x) for x in vectors}) == 1 and len(vectors[0]) == 4 * width:
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int32)
    for row, x in zip(out, vectors):
        row[: len(x) // 4] = np.frombuffer(x, "<i4")
    return out


def _pages(points: np.ndarray, own: np.ndarray, page_rows: int, fanout: int) -> list[np.ndarray]:
    """Split rows by their nearest of a few pivots, far from each other; equal points by position."""
    base = points[own]
    far = [0]
    nearest = ((base - base[0]) ** 2).sum(axis=1)
    labels = np.zeros(len(own), np.int64)
    while len(far) < fanout:
        pick = int(nearest.argmax())
        if nearest[pick] <= 0:
            break
        distance = ((base - base[pick]) ** 2).sum(axis=1)
        labels[distance < nearest] = len(far)
        nearest = np.minimum(nearest, distance)
        far.append(pick)
    groups = [own[labels == k] for k in range(len(far))]
    if max(len(x) for x in groups) > 0.9 * len(own):  # nothing to tell them apart
        return list(np.array_split(own, min(fanout, math.ceil(len(own) / page_rows))))
    return [x for x in groups if len(x)]


def build(ids: np.ndarray, vectors: np.ndarray, page_rows: int = PAGE_ROWS, fanout: int = FANOUT) -> dict[str, np.ndarray]:
    """A tree as flat arrays: nodes with routing row, radius, distance to the parent and children, then the pages' rows.

    Node 0 is the root.  ``first`` and ``last`` are children (nodes) of an inner
    node and rows of a page.
    """
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    most = float(squares.max())
    points = np.hstack([vectors.astype(np.float64), np.sqrt(most - squares)[:, None]])
    nodes: list[list] = []  # routing row, radius, distance to parent, first, last, is page
    rows: list[np.ndarray] = []
    gaps: list[np.ndarray] = []
    placed = 0
    queue: list[tuple[int, np.ndarray]] = []

    def routed(own: np.ndarray) -> tuple[int, np.ndarray]:
        centre = points[own].mean(axis=0)
        pick = int(own[((points[own] - centre) ** 2).sum(axis=1).argmin()])
        return pick, np.sqrt(((points[own] - points[pick]) ** 2).sum(axis=1))

    everything = np.arange(len(ids))
    pick, distance = routed(everything)
    nodes.append([pick, float(distance.max()), 0.0, 0, 0, False])
    queue.append((0, everything))
    while queue:
        node, own = queue.pop(0)
        if len(own) <= page_rows:
            distance = np.sqrt(((points[own] - points[nodes[node][0]]) ** 2).sum(axis=1))
            rows.append(own)
            gaps.append(distance)
            nodes[node][3:6] = [placed, placed + len(own), True]
            placed += len(own)
            continue
        parts = _pages(points, own, page_rows, fanout)
        nodes[node][3:6] = [len(nodes), len(nodes) + len(parts), False]
        for part in parts:
            pick, distance = routed(part)
            up = float(np.sqrt(((points[pick] - points[nodes[node][0]]) ** 2).sum()))
            queue.append((len(nodes), part))
            nodes.append([pick, float(distance.max()), up, 0, 0, False])
    order = np.concatenate(rows)
    routing = np.array([x[0] for x in nodes])
    return {
        "ids": ids[order],
        "vectors": vectors[order],
        "gaps": np.concatenate(gaps),
        "routing": vectors[routing],
        "radius": np.array([x[1] for x in nodes]),
        "up": np.array([x[2] for x in nodes]),
        "first": np.array([x[3] for x in nodes]),
        "last": np.array([x[4] for x in nodes]),
        "page": np.array([x[5] for x in nodes]),
        "most": np.array([most]),
    }


def search(tree: dict[str, np.ndarray], key: int, query: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) of a tree, best first, and how many distances were computed."""
    most = float(tree["most"][0])
    q = query.astype(np.float64)
    length = float(q @ q)
    routing, vectors, ids = tree["routing"], tree["vectors"], tree["ids"]
    computed = 1
    best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first

    def gaps_to(rows: np.ndarray) -> np.ndarray:
        # routing vectors are data, so their extra coordinate is sqrt(most - |x|^2)
        return np.sqrt(np.maximum(length + most - 2 * (rows.astype(np.float64, copy=False) @ q), 0))

    def least() -> float:
        """Distance beyond which no score can reach the k-th best."""
        if len(best) < k:
            return math.inf
        return math.sqrt(max(length + most - 2 * (best[0][0] - 0.5), 0)) * (1 + 1e-12) + 1e-6

    root = float(gaps_to(routing[:1])[0])
    queue = [(max(root - float(tree["radius"][0]), 0.0), 0, root)]
    while queue:
        bound, node, distance = heapq.heappop(queue)
        reach = least()
        if bound > reach:
            break
        first, last = int(tree["first"][node]), int(tree["last"][node])
        if tree["page"][node]:
            near = np.abs(distance - tree["gaps"][first:last]) <= reach
            rows = np.flatnonzero(near) + first
            rows = rows[ids[rows] != key]
            computed += len(rows)
            scores = (vectors[rows].astype(np.float64, copy=False) @ q).astype(np.int64)  # exact within 2**20
            if len(best) == k:
                use = scores >= best[0][0]
                rows, scores = rows[use], scores[use]
            if len(rows) > k:
                top = np.lexsort((ids[rows], -scores))[:k]
                rows, scores = rows[top], scores[top]
            for score, own in zip(scores.tolist(), ids[rows].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -own))
                elif (score, -own) > best[0]:
                    heapq.heapreplace(best, (score, -own))
            continue
        children = np.arange(first, last)
        close = np.maximum(np.abs(distance - tree["up"][children]) - tree["radius"][children], 0)
        children = children[close <= reach]
        computed += len(children)
        away = gaps_to(routing[children])
        bounds = np.maximum(np.maximum(away - tree["radius"][children], 0), bound)
        for child, low, gap in zip(children.tolist(), bounds.tolist(), away.tolist()):
            if low <= reach:
                heapq.heappush(queue, (low, child, gap))
    return [(score, -own) for score, own in sorted(best, key=lambda x: (-x[0], -x[1]))], computed


_TREE = ("ids", "vectors", "gaps", "routing", "radius", "up", "first", "last", "page", "most")
_KINDS = ("<i8", "<i4", "<f8", "<i4", "<f8", "<f8", "<i8", "<i8", "?", "<f8")
TREES = "tree long, width int, " + ", ".join(f"{x} binary" for x in _TREE)


def _build_tree(width: int, page_rows: int):
    def make(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = _matrix(group.column("vector").to_pylist(), width)
        made = build(ids[order], vectors[order], page_rows)
        columns = {"tree": pa.array([group.column("tree")[0].as_py()], pa.int64()), "width": pa.array([width], pa.int32())}
        columns |= {x: pa.array([made[x].astype(t).tobytes()], pa.binary()) for x, t in zip(_TREE, _KINDS)}
        return pa.table(columns)

    return make


def _block(width: int):
    def make(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("vector").to_pylist(), width)
        return pa.table(
            {
                "block": pa.array([group.column("block")[0].as_py()], pa.int64()),
                "keys": pa.array([group.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "queries": pa.array([vectors.astype("<i4").tobytes()], pa.binary()),
            }
        )

    return make


def _tree(row: dict) -> dict[str, np.ndarray]:
    """A stored tree as arrays, its vectors as doubles."""
    tree = {x: np.frombuffer(row[x], t) for x, t in zip(_TREE, _KINDS)}
    for x in ("vectors", "routing"):
        tree[x] = tree[x].reshape(-1, row["width"]).astype(np.float64)
    return tree


def _meet(k: int):
    """Each task reads its trees, then one block of queries after the other; the k best of all its trees."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: list[dict[str, np.ndarray]] = []
        for batch in batches(source):
            for i in range(batch.num_rows):
                row = {x: batch.column(x)[i].as_py() for x in batch.schema.names}
                if row["keys"] is None:
                    trees.append(_tree(row))
                    continue
                keys = np.frombuffer(row["keys"], "<i8")
                queries = np.frombuffer(row["queries"], "<i4").reshape(len(keys), -1)
                out: list[tuple[int, int, int]] = []
                for key, query in zip(keys.tolist(), queries):
                    found = [x for tree in trees for x in search(tree, key, query, k)[0]]
                    out += [(key, own, score) for score, own in heapq.nsmallest(k, found, key=lambda x: (-x[0], x[1]))]
                columns = list(zip(*out)) if out else [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"]
                )

    return rows


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    tree_rows: int = TREE_ROWS,
    page_rows: int = PAGE_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k largest inner products of each query among ``rows``: query_id, rank, vec_id, score.

    Queries with the same id are one query; the smallest vector by its bytes stands for it.
    """
    spark = rows.sparkSession
    everything = stage(_unlabelled(rows, key, vector), "mtree-rows")
    one = _unlabelled(queries, key, vector).groupBy("id").agg(F.min(F.struct("vector", "label", "wide")).alias("x"))
    every_query = stage(one.select("id", "x.*"), "mtree-queries")
    data, asked = everything.where("not wide"), every_query.where("not wide")
    narrow = [F.count_if(~F.col("wide")), F.count_if("wide"), F.max(F.when(~F.col("wide"), F.length("vector")))]
    size, far_rows, widest = everything.agg(*narrow).first()
    n_queries, far_queries, wide = every_query.agg(*narrow).first()
    width = max(widest or 0, wide or 0) // 4
    parts = []
    if far_rows:
        parts.append(_apart(everything.where("wide"), every_query, k))
    if far_queries and size:
        parts.append(_apart(data, every_query.where("wide"), k))
    if size and n_queries and width:
        parts.append(_found_in_trees(data, asked, k, size, n_queries, width, tree_rows, page_rows, block_queries))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _unlabelled(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable vectors, all under one label."""
    return usable_rows(rows.select(key, vector, F.lit(0).alias("_label")), key, "_label", vector)


def _apart(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of ``rows`` that shards find for each query."""
    found = Index(rows).meet(queries.select("id", "label", "wide", "vector"), k)
    return found.select(F.col("anchor").alias("query_id"), F.col("id").alias("vec_id"), "score")


def _found_in_trees(
    data: DataFrame, asked: DataFrame, k: int, size: int, n_queries: int, width: int,
    tree_rows: int, page_rows: int, block_queries: int,
) -> DataFrame:
    """The k best of each tree for each query."""
    spark = data.sparkSession
    trees = max(1, math.ceil(size / tree_rows))
    blocks = max(1, math.ceil(n_queries / block_queries))
    # rows of one id may be many; the vector's bytes and a row number deal them out as well
    dealt = data.withColumn("tree", F.pmod(F.xxhash64("id", "vector", F.monotonically_increasing_id()), F.lit(trees)))
    forest = stage(dealt.groupBy("tree").applyInArrow(_build_tree(width, page_rows), TREES), "mtree-trees")
    packed = (
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_block(width), "block long, keys binary, queries binary")
    )
    return _meetings(spark, forest, packed, trees, blocks).mapInArrow(_meet(k), "query_id long, vec_id long, score long")


def _meetings(spark: SparkSession, forest: DataFrame, packed: DataFrame, trees: int, blocks: int) -> DataFrame:
    """Trees and the blocks that meet them in one partition, the trees first.

    A partition has up to ``TASK_TREES`` trees and meets all blocks, or where there are few trees a
    share of them.  Nothing is joined: blocks are as many rows as there are partitions of trees,
    which the planner could not know, and would take a copy of all of them to the driver.
    """
    parts = shuffle_parts(spark)
    groves = math.ceil(trees / min(TASK_TREES, math.ceil(trees / parts)))
    shares = min(blocks, MOST_SHARES, math.ceil(parts / groves))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    grown = forest.select("*", F.lit(-1).cast("long").alias("block"), numbers(shares).alias("share"))
    asked = packed.select("*", numbers(groves).alias("tree")).withColumn("share", F.pmod("block", F.lit(shares)))
    task = (F.pmod("tree", F.lit(groves)) * shares + F.col("share")).cast("int")
    dealt = grown.unionByName(asked, allowMissingColumns=True).repartitionById(groves * shares, task)
    return dealt.sortWithinPartitions("block", "tree").select("keys", "queries", "width", *_TREE)
