"""Hard negatives of anchors by an inverted multi-index.

Every vector is cut into two halves, each half goes to the nearest word of its
codebook, and the pair of words is the row's cell.  An index shard holds about
``shard_rows`` rows ordered by cell and, for each word, the largest distance
(radius) of a half that went to it.  With q the half of an anchor, c a word and r its
radius, no half x of that word can have q.x above q.c + |q| r.  The sum of two such
half-score bounds holds for every row of a cell.

A search sorts the words of both halves by their bounds and visits cells from the
largest sum down: a heap starts at the best pair and is offered the next word of either
half for each pair it gives out, so cells never visited are never summed.  Rows of the
visited cells are scored exactly.  The search stops when no cell that is left can
reach what is still wanted, which certifies the result:

* positives: the k rows of the anchor's own label with the highest scores;
* negatives of a positive: the first m rows of other labels in its window of scores,
  ``low_percent`` / 100 of the positive's score up to the score itself.  Its windows are
  served by one walk per anchor; the walk ends below the lowest of them, or below the m-th
  row found where a window is full.

Anchors are packed into blocks.  A shard lies in one task, which reads the shard once and
then one block of anchors after the other; the best of all shards are merged per anchor.
The codebooks are fitted on a sample of ``codebook_rows`` rows (by hash of the id);
every row is indexed, and results are exact whatever the codebooks are like.

Scores are integer inner products of floor(``SCALE`` * x).  Components within 2**20 are
multiplied as doubles, which is exact for up to 8192 of them.  Rows beyond that lie apart in
their shard and are scored in Python integers, as is everything for such anchors; a score
outside of 64 bits is given as the nearest 64-bit value.  Shorter vectors count as padded
with zeros.  Rows without id, label or vector or with a component that is null or not finite
take no part.  Repeated rows are candidates each, but never of an anchor with their own id; of
anchors with the same id the one with the smallest label and vector stands.  Ties go to
the smaller id.  Without rows or anchors the result is empty.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import batches
from agora.sources.staging import stage

SCALE = 256
SHARD_ROWS = 8192
WORDS = 16
CODEBOOK_ROWS = 16_384
BLOCK_ANCHORS = 128
SCORED_ROWS = 512
_NARROW = 1 << 20
_MOST_WIDTH = 8192
_LONGS = (-(1 << 63), (1 << 63) - 1)

ROWS = "id long, label long, wide boolean, vector binary"
_FOUND = "anchor long, place int, positive long, positive_score long, id long, score long"


def _usable(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that take part: scaled integers in four bytes, or as they are where these do not hold them."""
    for batch in batches(source):
        out: list[tuple] = []
        for key, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if not vector.is_valid or vector.values.null_count:
                continue
            x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            wide = len(x) > _MOST_WIDTH or bool(len(x) and np.abs(x).max() >= _NARROW / SCALE)
            out.append((key, label, wide, x.astype("<f8").tobytes() if wide else np.floor(SCALE * x).astype("<i4").tobytes()))
        columns = list(zip(*out)) if out else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "label", "wide", "vector"]
        )


def usable_rows(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    chosen = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    return chosen.where("id is not null and label is not null and v is not null").mapInArrow(_usable, ROWS)


def _integers(raw: bytes, wide: bool) -> list[int]:
    """The exact scaled components of a stored vector."""
    if not wide:
        return np.frombuffer(raw, "<i4").tolist()
    scaled = []
    for x in np.frombuffer(raw, "<f8").tolist():
        product = SCALE * x
        scaled.append(math.floor(product) if math.isfinite(product) else SCALE * int(x))
    return scaled


def _exact(a: list[int], b: list[int]) -> int:
    score = sum(x * y for x, y in zip(a, b))
    return min(max(score, _LONGS[0]), _LONGS[1])


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, raw in zip(out, vectors):
        x = np.frombuffer(raw, "<i4")
        row[: len(x)] = x
    return out


def _codebook(points: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Words of a half-space by k-means from points far from each other."""
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < words and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centres = points[chosen].copy()
    for _ in range(rounds):
        near = _nearest(points, centres)
        for k in range(len(centres)):
            own = points[near == k]
            if len(own):
                centres[k] = own.mean(axis=0)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def fit_codebooks(rows: DataFrame, width: int, words: int = WORDS, sample: int = CODEBOOK_ROWS) -> list[np.ndarray]:
    """One codebook for each half, from at most ``sample`` rows."""
    few = rows.where("not wide").orderBy(F.xxhash64("id", "vector")).limit(sample).select("vector").collect()
    cut = (width + 1) // 2
    points = _matrix([x[0] for x in few], width) if few else np.zeros((1, width))
    return [_codebook(half, words) for half in (points[:, :cut], points[:, cut:])]


class Shard:
    """Rows ordered by cell, the cells' first rows, the words' radii and the rows apart."""

    def __init__(self, books: list[np.ndarray], width: int, ids, labels, wide, vectors):
        self.books, self.cut = books, (width + 1) // 2
        apart = [k for k, x in enumerate(wide) if x]
        own = np.array([k for k, x in enumerate(wide) if not x], np.int64)
        points = _matrix([vectors[k] for k in own], width)
        halves = (points[:, : self.cut], points[:, self.cut :])
        near = [_nearest(half, book) for half, book in zip(halves, books)]
        self.radii = []
        for half, book, word in zip(halves, books, near):
            radius = np.zeros(len(book))
            np.maximum.at(radius, word, np.sqrt(((half - book[word]) ** 2).sum(axis=1)))
            self.radii.append(radius)
        ids, labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        cell = near[0] * len(books[1]) + near[1]
        order = np.lexsort((ids[own], cell))
        self.points, self.ids, self.labels = points[order], ids[own][order], labels[own][order]
        self.first = np.searchsorted(cell[order], np.arange(len(books[0]) * len(books[1]) + 1))
        self.apart = [(int(ids[k]), int(labels[k]), _integers(vectors[k], True)) for k in apart]

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, first row, row behind) of cells by falling bound."""
        bounds, orders = [], []
        for half, book, radius in zip((query[: self.cut], query[self.cut :]), self.books, self.radii):
            bound = book @ half + math.sqrt(float(half @ half)) * radius
            order = np.argsort(-bound, kind="stable")
            bounds.append(bound[order].tolist())
            orders.append(order.tolist())
        (left, right), (one, two), first = bounds, orders, self.first
        heap = [(-(left[0] + right[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = one[i] * len(two) + two[j]
            yield -bound, first[cell], first[cell + 1]
            if j == 0 and i + 1 < len(left):
                heapq.heappush(heap, (-(left[i + 1] + right[0]), i + 1, 0))
            if j + 1 < len(right):
                heapq.heappush(heap, (-(left[i] + right[j + 1]), i, j + 1))

    def walk(self, anchor: dict, reach) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(scores, ids, labels) of visited rows, until no cell left has a bound of at least ``reach()``."""
        key, wide = anchor["id"], anchor["wide"]
        exact = _integers(anchor["vector"], wide)
        far = self.apart if not wide else self.apart + list(
            zip(self.ids.tolist(), self.labels.tolist(), self.points.astype(np.int64).tolist())
        )
        rows = [(_exact(exact, x), k, label) for k, label, x in far if k != key]
        if rows:
            yield tuple(np.array(x, np.int64) for x in zip(*rows))
        if wide or not len(self.ids):
            return
        query = np.zeros(self.points.shape[1])
        query[: len(exact)] = exact
        held: list[np.ndarray] = []
        size = 0

        def scored():
            at = np.concatenate(held)
            at = at[self.ids[at] != key]
            return (self.points[at] @ query).astype(np.int64), self.ids[at], self.labels[at]

        for bound, first, behind in self.cells(query):
            # scores are whole numbers, so half a unit is more than rounding can take from a bound
            if bound * (1 + 1e-12) + 0.5 < reach():
                break
            if behind > first:
                held.append(np.arange(first, behind))
                size += behind - first
                if size >= SCORED_ROWS:
                    yield scored()
                    held, size = [], 0
        if held:
            yield scored()

    def positives(self, anchor: dict, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows of the anchor's label, best first."""
        best = np.empty(0, np.int64), np.empty(0, np.int64)

        def reach() -> float:
            return -math.inf if len(best[0]) < k else float(best[0][-1])

        for scores, ids, labels in self.walk(anchor, reach):
            own = labels == anchor["label"]
            best = _first(np.append(best[0], scores[own]), np.append(best[1], ids[own]), k)
        return list(zip(best[0].tolist(), best[1].tolist()))

    def negatives(self, anchor: dict, m: int, low_percent: int) -> list[tuple[int, list[tuple[int, int]]]]:
        """For each of the anchor's positives by place: (score, id) of the first m rows of its window in this shard."""
        windows = {x["place"]: (-(-low_percent * x["score"] // 100), x["score"]) for x in anchor["positives"]}
        open_ones = {k: w for k, w in windows.items() if w[0] <= w[1]}
        best = {k: (np.empty(0, np.int64), np.empty(0, np.int64)) for k in open_ones}
        if not open_ones:
            return []

        def reach() -> float:
            return min(low if len(best[k][0]) < m else max(low, float(best[k][0][-1])) for k, (low, _) in open_ones.items())

        for scores, ids, labels in self.walk(anchor, reach):
            other = labels != anchor["label"]
            scores, ids = scores[other], ids[other]
            for k, (low, high) in open_ones.items():
                inside = (scores >= low) & (scores <= high)
                if inside.any():
                    best[k] = _first(np.append(best[k][0], scores[inside]), np.append(best[k][1], ids[inside]), m)
        return [(k, list(zip(scores.tolist(), ids.tolist()))) for k, (scores, ids) in best.items()]


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[scores >= least], ids[scores >= least]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


SHARDS = "shard long, ids array<bigint>, labels array<bigint>, wide array<boolean>, vectors array<binary>"


def _pack(group: pa.Table) -> pa.Table:
    """A shard's rows as one row."""
    lists = {"ids": "id", "labels": "label", "wide": "wide", "vectors": "vector"}
    made = {"shard": group.column("shard").slice(0, 1)}
    for name, column in lists.items():
        values = group.column(column).combine_chunks()
        made[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pa.table(made)


def _meet(books: list[np.ndarray], width: int, k: int | None, m: int, low_percent: int):
    """Each shard reads its blocks of anchors: positives if k is given, negatives otherwise."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = number = None
        for batch in batches(source):
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                if row["ids"].is_valid:
                    shard = Shard(books, width, *(row[x].as_py() for x in ("ids", "labels", "wide", "vectors")))
                    number = row["shard"].as_py()
                    continue
                if row["shard"].as_py() != number:
                    continue  # no row was dealt to this shard
                out: list[tuple] = []
                for anchor in row["anchors"].as_py():
                    if k is not None:
                        found = shard.positives(anchor, k)
                        out += [(anchor["id"], None, None, None, own, score) for score, own in found]
                        continue
                    by_place = {x["place"]: x for x in anchor["positives"]}
                    for place, found in shard.negatives(anchor, m, low_percent):
                        positive = by_place[place]
                        start = (anchor["id"], place, positive["id"], positive["score"])
                        out += [(*start, own, score) for score, own in found]
                columns = list(zip(*out)) if out else [[]] * 6
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["anchor", "place", "positive", "positive_score", "id", "score"],
                )

    return rows


class Index:
    """An inverted multi-index over all usable rows, staged in shards."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD_ROWS, words: int = WORDS, codebook_rows: int = CODEBOOK_ROWS):
        """``rows`` as ``usable_rows`` gives them, staged."""
        size, self.width = rows.agg(
            F.count("*"), F.max(F.when(F.col("wide"), 0).otherwise(F.length("vector") / 4)).cast("int")
        ).first()
        self.width = max(self.width or 0, 2)
        self.count = max(1, math.ceil(size / shard_rows))
        self.books = fit_codebooks(rows, self.width, words, codebook_rows)
        # rows of one id may be many; a row number deals them out as well
        place = F.pmod(F.xxhash64("id", "vector", F.monotonically_increasing_id()), F.lit(self.count))
        self.shards = stage(rows.withColumn("shard", place).groupBy("shard").applyInArrow(_pack, SHARDS), "index-shards")

    def meet(self, anchors: DataFrame, k: int | None, m: int = 0, low_percent: int = 0) -> DataFrame:
        """What all shards find for all anchors (structs of id, label, wide, vector and perhaps positives)."""
        spark = anchors.sparkSession
        asked = stage(anchors, "index-anchors")
        blocks = max(1, math.ceil(asked.count() / BLOCK_ANCHORS))
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
        packed = asked.groupBy(block).agg(F.collect_list(F.struct(*asked.columns)).alias("anchors"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.count - 1).cast("long"))).alias("shard")
        calls = packed.select(every, "block", "anchors")
        meetings = self.shards.withColumn("block", F.lit(-1).cast("long")).unionByName(calls, allowMissingColumns=True)
        tasks = min(self.count, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = meetings.repartitionByRange(tasks, "shard").sortWithinPartitions("shard", "block")
        return dealt.select("shard", "ids", "labels", "wide", "vectors", "anchors").mapInArrow(
            _meet(self.books, self.width, k, m, low_percent), _FOUND
        )


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    words: int = WORDS,
    codebook_rows: int = CODEBOOK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each anchor and positive."""
    data = stage(usable_rows(rows, key, label, vector), "index-rows")
    same_id = usable_rows(anchors, key, label, vector).groupBy("id")
    asked = stage(same_id.agg(F.min(F.struct("label", "vector", "wide")).alias("x")).select("id", "x.*"), "index-queries")
    index = Index(data, shard_rows, words, codebook_rows)
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    near = index.meet(asked, positives).withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    lists = near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives")
    )
    ready = asked.join(lists.withColumnRenamed("anchor", "id"), "id").select("id", "label", "wide", "vector", "positives")
    first = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    return (
        index.meet(ready, None, negatives, low_percent)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= negatives)
        .select(
            F.col("anchor").alias("anchor_id"),
            F.col("positive").alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


SQL = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
    cast(list_sum(list_transform(range(1, len(r.v) + 1), lambda i: a.v[i] * r.v[i])) as bigint) as score
  from usable a join usable r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id
),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
),
ranked as (
  select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as n
  from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
    and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
)
select anchor_id, positive_id, cast(n as integer) as "rank", negative_id, positive_score, negative_score
from ranked where n <= 5
"""
