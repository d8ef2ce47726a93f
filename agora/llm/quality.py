"""Quality by co-training: a text classifier and a metadata classifier teach each other.

The text view are a document's words (hashed, by logarithmic frequency, scaled to
length one) and the shape of its text; the metadata view its source, language,
stated length and their pairs.  Both are logistic regressions.  They start from
the same labelled documents.  In each round each view scores a pool of documents
without label and hands those it is surest about, in the labels' proportions, to
the *other* view as examples.  Afterwards each view's scores are calibrated on
labelled documents it was not trained on, and the views are combined as
independent evidence: their log-odds add up, less the prior's.

The fit uses bounded samples: ``train_docs`` labelled documents, a quarter of them
for calibration, and as many without label, the smallest hashes of ``doc_id``, as
far as they have ``train_words`` distinct words together.  Every document is
scored.

Nulls: a null text is an empty one, null metadata are a value of their own, rows
with a null label or id do not train; of several labels of a document the worst
counts.  Without both kinds of labels every score is the labels' mean, or 0.5.
Repeated rows are scored alike.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import batches, fitting_rows, spread
from agora.llm.words import ALNUM, Block, Powers, blocks, scan

WORDS = 1 << 18
SHAPES = 9 * 16
META = 1 << 14
TRAIN_DOCS = 8_000
TRAIN_WORDS = 6_000_000
ROUNDS = 5
#: Share of the pool that a view hands over per round.
HANDED = 0.06


class Rows(NamedTuple):
    """A sparse matrix: where rows start, features and values."""

    starts: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def text_rows(block: Block, powers: Powers) -> Rows:
    """The text view of a block's documents."""
    docs = block.last - block.first
    words = scan(block, ALNUM, powers)
    key = np.sort(words.doc * WORDS + (words.hash % np.uint64(WORDS)).astype(np.int64))
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    doc, feature = key[head] // WORDS, key[head] % WORDS
    value = np.log1p(np.diff(np.append(head, len(key))))
    norm = np.sqrt(np.bincount(doc, weights=value * value, minlength=docs))
    value = value / np.maximum(norm[doc], 1e-9)
    shape = _shapes(block, words, np.bincount(doc, minlength=docs))
    doc = np.concatenate([doc, np.repeat(np.arange(docs), shape.shape[1])])
    by = np.argsort(doc, kind="stable")
    starts = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs))))
    feature = np.concatenate([feature, WORDS + shape.ravel()])[by]
    return Rows(starts, feature, np.concatenate([value, np.full(shape.size, 0.5)])[by])


def _shapes(block: Block, words, kinds: np.ndarray) -> np.ndarray:
    """Shares of characters and words, each cut into 16 steps: one feature per share."""
    docs = block.last - block.first
    data = block.data
    size = np.maximum(np.diff(block.offsets), 1)

    def share(member: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(member, dtype=np.int64)))
        return np.diff(total[block.offsets]) / size

    count = np.bincount(words.doc, minlength=docs)
    letters = np.bincount(words.doc, weights=words.end - words.start, minlength=docs)
    same = np.zeros(len(words.hash), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    punctuation = (data > 32) & (data < 127) & ~ALNUM[data]
    shares = [
        (share(punctuation), 0.4), (share((data >= 48) & (data < 58)), 0.3), (share((data >= 65) & (data < 91)), 0.6),
        (share(data == 10), 0.1), (share(data == 124), 0.2), (share((data == 33) | (data == 36) | (data == 37)), 0.2),
        (kinds / np.maximum(count, 1), 1.0), (letters / np.maximum(count, 1) / 16, 1.0),
        (np.bincount(words.doc[same], minlength=docs) / np.maximum(count, 1), 1.0),
    ]
    steps = [np.minimum(15, np.ceil(16 * np.sqrt(x / top) - 1e-9)).astype(np.int64).clip(0) for x, top in shares]
    return np.stack([16 * k + x for k, x in enumerate(steps)], axis=1)


def meta_columns(source: Column, lang: Column, n_chars: Column) -> Column:
    """The metadata view: numbers of the features that hold."""
    step = F.coalesce(F.floor(F.log2(n_chars.cast("double") + 1) * 2).cast("string"), F.lit("?"))
    src, tongue = F.coalesce(source, F.lit("\x00")), F.coalesce(lang, F.lit("\x00"))
    pairs = [("s", src), ("l", tongue), ("n", step), ("sl", F.concat_ws("\x01", src, tongue)), ("ln", F.concat_ws("\x01", tongue, step))]
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), v), F.lit(META)).cast("int") for k, v in pairs])


def fit(rows: Rows, labels: np.ndarray, size: int, rounds: int = 120, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Adam; the last weight is the bias."""
    row = rows.row_of()
    n = len(labels)
    weights, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    prior = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weights[-1] = np.log(prior / (1 - prior))
    for step in range(1, rounds + 1):
        z = weights[-1] + np.bincount(row, weights=weights[rows.feature] * rows.value, minlength=n)
        rest = labels - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        grad = np.append(np.bincount(rows.feature, weights=rest[row] * rows.value, minlength=size), rest.sum()) / n
        grad[:-1] -= ridge * weights[:-1] / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weights = weights + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return weights


def logits(rows: Rows, weights: np.ndarray) -> np.ndarray:
    n = len(rows.starts) - 1
    return weights[-1] + np.bincount(rows.row_of(), weights=weights[rows.feature] * rows.value, minlength=n)


def _chosen(rows: Rows, own: np.ndarray) -> Rows:
    size = np.diff(rows.starts)[own]
    ends = np.cumsum(size)
    at = np.repeat(rows.starts[:-1][own] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    return Rows(np.concatenate(([0], ends)), rows.feature[at], rows.value[at])


def _platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset that turn scores into log-odds."""
    w = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        w = w + np.linalg.solve(bend, x.T @ (y - p) - 0.05 * (w - [1, 0]))
    return np.array([max(w[0], 0.0), w[1]])


class Model(NamedTuple):
    """Weights of the views, how to calibrate them, and the labels' log-odds."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    prior: float


def co_train(views: tuple[Rows, Rows], labels: np.ndarray, held: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``labels`` are 0, 1 or -1 for the pool; ``held`` marks the labelled rows kept for calibration."""
    sizes = (WORDS + SHAPES, META)
    known = np.flatnonzero((labels >= 0) & ~held)
    pool = np.flatnonzero(labels < 0)
    if not len(known) or labels[known].min() == labels[known].max():
        mean = float(np.clip(labels[known].mean(), 1e-3, 1 - 1e-3)) if len(known) else 0.5
        flat = np.array([0.0, np.log(mean / (1 - mean))])
        return Model(np.zeros(sizes[0] + 1), np.zeros(sizes[1] + 1), flat, flat, float(flat[1]))
    share = labels[known].mean()
    guesses = [np.full(len(labels), -1), np.full(len(labels), -1)]  # what each view has been told
    weights = [np.empty(0), np.empty(0)]
    for turn in range(rounds + 1):
        for k in (0, 1):
            told = np.flatnonzero(guesses[k] >= 0)
            own = np.concatenate([known, told])
            target = np.concatenate([labels[known], guesses[k][told]]).astype(float)
            weights[k] = fit(_chosen(views[k], own), target, sizes[k])
        if turn == rounds or not len(pool):
            break
        for k in (0, 1):
            z = logits(_chosen(views[k], pool), weights[k])
            free = guesses[1 - k][pool] < 0
            most = max(1, int(HANDED * len(pool)))
            high = np.flatnonzero(free & (z > 2.0))
            low = np.flatnonzero(free & (z < -2.0))
            high = high[np.argsort(-z[high], kind="stable")][: max(1, int(most * share))]
            low = low[np.argsort(z[low], kind="stable")][: max(1, int(most * (1 - share)))]
            guesses[1 - k][pool[high]], guesses[1 - k][pool[low]] = 1, 0
    scales = []
    check = np.flatnonzero((labels >= 0) & held)
    for k in (0, 1):
        use = check if len(check) >= 20 and labels[check].min() != labels[check].max() else known
        scales.append(_platt(logits(_chosen(views[k], use), weights[k]), labels[use].astype(float)))
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    return Model(weights[0], weights[1], scales[0], scales[1], float(np.log(share / (1 - share))))


def _examples(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches(source):
        for block in blocks(batch.column("text")):
            docs = block.last - block.first
            rows = text_rows(block, powers)
            piece = batch.slice(block.first, docs)
            cut = list(zip(rows.starts[:-1].tolist(), rows.starts[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("order"), piece.column("label"), piece.column("meta"),
                    pa.array([b - a for a, b in cut], pa.int64()),
                    pa.array([rows.feature[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                    pa.array([rows.value[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary()),
                ],
                names=["order", "label", "meta", "n", "features", "values"],
            )


def train(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS, rounds: int = ROUNDS
) -> Model:
    """Fit to labels (doc_id, quality) and a pool of other documents of ``docs``."""
    given = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn("order", spread(F.col("doc_id")))
    known = given.join(ids, "doc_id").orderBy("order", "doc_id").limit(train_docs)
    pool = ids.join(given, "doc_id", "left_anti").orderBy("order", "doc_id").limit(train_docs)
    picked = known.select("doc_id", "order", "label").unionByName(pool.withColumn("label", F.lit(-1)).select("doc_id", "order", "label"))
    meta = meta_columns(F.col("source"), F.col("lang"), F.col("n_chars")).alias("meta")
    bags = (
        docs.select("doc_id", "text", meta)
        .join(F.broadcast(picked), "doc_id")  # at most 2 * train_docs rows of three numbers
        .select("order", "label", "meta", "text")
        .mapInArrow(_examples, "order long, label int, meta array<int>, n long, features binary, values binary")
        .orderBy("order", "n")
        .limit(4 * train_docs)
    )
    rows = fitting_rows(bags, ["order", "n"], "n", train_words, F.when(F.col("label") >= 0, F.col("label")))
    target = np.array(rows.column("label").to_pylist(), np.int64)
    starts = np.concatenate(([0], np.cumsum(np.array(rows.column("n").to_pylist(), np.int64)))).astype(np.int64)
    text = Rows(
        starts,
        np.frombuffer(b"".join(rows.column("features").to_pylist()), np.int32).astype(np.int64),
        np.frombuffer(b"".join(rows.column("values").to_pylist()), np.float32).astype(np.float64),
    )
    held = np.zeros(len(target), dtype=bool)
    labelled = np.flatnonzero(target >= 0)
    held[labelled[::4]] = True
    return co_train((text, meta_rows(rows.column("meta").to_pylist())), target, held, rounds)


def meta_rows(lists: list[list[int]]) -> Rows:
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))).astype(np.int64)
    flat = np.array([y for x in lists for y in x], np.int64)
    return Rows(starts, flat, np.ones(len(flat)))


def _scores(sent):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, powers = Model(*sent.value), Powers()
        for batch in batches(source):
            for block in blocks(batch.column("text")):
                docs = block.last - block.first
                piece = batch.slice(block.first, docs)
                text = logits(text_rows(block, powers), model.text) * model.text_scale[0] + model.text_scale[1]
                flat = piece.column("meta").flatten().to_numpy()
                each = len(flat) // docs
                own = model.meta[-1] + model.meta[flat].reshape(docs, each).sum(axis=1)
                meta = own * model.meta_scale[0] + model.meta_scale[1]
                chance = lambda z: pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), chance(text), chance(meta), chance(text + meta - model.prior)],
                    names=["doc_id", "text_score", "meta_score", "score"],
                )

    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, the calibrated views' scores and the combined one (label 1 likelier when higher)."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    meta = meta_columns(F.col("source"), F.col("lang"), F.col("n_chars")).alias("meta")
    schema = "doc_id long, text_score double, meta_score double, score double"
    return docs.select("doc_id", "text", meta).mapInArrow(_scores(sent), schema)
