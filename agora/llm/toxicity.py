"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a probability of being
toxic, a logistic function of the sum of its words' weights; the document's is
their noisy-or, 1 - prod(1 - p).  Labels exist for documents only: the weights
are those that make the labels likeliest, found by Adam on all training
documents at once.  Afterwards the sentences' own probabilities tell where the
offence is.

Sentences end at ``.``, ``!``, ``?``, a line feed or a text's end; words are runs
of letters, digits and characters beyond ASCII, lower-cased.  A word counts by
itself, by its first four and five bytes and by its last five, as related words
share these; each has a weight by its hash.  Weights are never negative: harmless
words around an offence do not excuse it.

Only features that toxic documents have more often than chance (``LIKELIER``
standard deviations, in at least ``LEAST_DOCS`` documents) can have a weight;
they are counted over a bounded sample of the labelled documents, ``train_docs`` of
them (the smallest hashes of ``doc_id``).  The weights are fitted to as many of these
as have ``train_words`` such features together.  Scoring reads every document.

Nulls: a null or empty text has no sentence and gets the score of a text without
evidence, 0.  Unlabelled rows and null labels do not train; if a document has
several labels it is toxic when one says so.  Without both kinds of labels every
score is 0.  Repeated rows are scored alike.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import batches, fitting_rows, spread
from agora.llm.words import ALNUM, Block, Powers, blocks, scan

BUCKETS = 1 << 19
TRAIN_DOCS = 20_000
TRAIN_WORDS = 4_000_000
LEAST_DOCS = 5
LIKELIER = 4.0
ROUNDS = 100
#: How much log-likelihood a unit of weight has to bring.
LASSO = 1.0

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 33, 46, 63]] = True


class Sentences(NamedTuple):
    """Features (bucket numbers) of a block by sentence, sentences by text."""

    bucket: np.ndarray
    sentence: np.ndarray  # of each feature, ascending
    doc: np.ndarray  # of each sentence
    start: np.ndarray  # first byte and end of each sentence's words
    end: np.ndarray


def sentences(block: Block, powers: Powers) -> Sentences:
    """All sentences that have words."""
    words = scan(block, ALNUM, powers)
    if not len(words.hash):
        none = np.empty(0, np.int64)
        return Sentences(none, none, none, none, none)
    ends = np.cumsum(_ENDS[block.data])[words.start]
    new = np.ones(len(ends), dtype=bool)
    new[1:] = (ends[1:] != ends[:-1]) | (words.doc[1:] != words.doc[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:] - 1, len(ends) - 1)
    size = words.end - words.start
    four, five = words.start + np.minimum(size, 4), words.start + np.minimum(size, 5)
    features = np.stack(
        [
            words.hash,
            words.part(words.start, four) ^ np.uint64(0x4000),
            words.part(words.start, five) ^ np.uint64(0x5000),
            words.part(words.end - np.minimum(size, 5), words.end) ^ np.uint64(0x9000),
        ],
        axis=1,
    )
    bucket = (features.ravel() % np.uint64(BUCKETS)).astype(np.int64)
    return Sentences(bucket, np.repeat(np.cumsum(new) - 1, 4), words.doc[head], words.start[head], words.end[last])


class Model(NamedTuple):
    """Weights per bucket and the weight of a sentence without words."""

    weights: np.ndarray
    bias: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(
    bags: list[tuple[np.ndarray, np.ndarray, int]], guess: np.ndarray, rounds: int = ROUNDS, lasso: float = LASSO
) -> Model:
    """Fit to documents (buckets of the features, features per sentence, label).

    ``guess`` has a log-odds ratio per bucket; where it is 0 the weight stays 0.
    """
    labels = np.array([x[2] for x in bags], np.float64)
    if not len(bags) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    bucket = np.concatenate([x[0] for x in bags]).astype(np.int32)
    size = np.concatenate([x[1] for x in bags]).astype(np.int32)
    doc = np.repeat(np.arange(len(bags), dtype=np.int32), [len(x[1]) for x in bags])
    sentence = np.repeat(np.arange(len(size), dtype=np.int32), size)
    known = guess > 0
    number = np.cumsum(known) - 1
    use = known[bucket]
    word, sentence = number[bucket[use]].astype(np.int32), sentence[use]
    n = int(known.sum())
    weights, bias = guess[known] * 0.5, -6.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(sentence, weights=weights[word], minlength=len(size))
        p = _sigmoid(z)
        clean = np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(bags)))
        pull = np.where(labels > 0, clean / np.maximum(1 - clean, 1e-6), -1.0)  # d log-likelihood over sum of p
        slope = pull[doc] * p
        grad = np.append(
            np.bincount(word, weights=slope[sentence], minlength=n) / len(bags) - (lasso + weights / 10) / len(bags),
            slope.sum() / len(bags),
        )
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        weights, bias = np.maximum(weights + move[:-1], 0), bias + move[-1]
    out = np.zeros(BUCKETS, np.float32)
    out[known] = weights
    return Model(out, float(bias))


def first_guess(seen: np.ndarray, hits: np.ndarray, docs: int, toxic: int) -> np.ndarray:
    """Log-odds ratio of features in ``seen`` documents, ``hits`` of them toxic; 0 where it is not clearly above 0."""
    prior = toxic / max(docs, 1)
    if not 0 < prior < 1:
        return np.zeros(len(seen))
    odds = np.log((hits + 5 * prior) / (seen - hits + 5 * (1 - prior))) - np.log(prior / (1 - prior))
    above = (hits - seen * prior) / np.sqrt(np.maximum(seen, 1) * prior * (1 - prior))
    return np.where((seen >= LEAST_DOCS) & (above >= LIKELIER), odds, 0.0)


def sentence_scores(found: Sentences, model: Model) -> np.ndarray:
    z = np.bincount(found.sentence, weights=model.weights[found.bucket], minlength=len(found.doc))
    return _sigmoid(z + model.bias)


def _occurrences(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents per feature, summed over what a task reads; feature -1 counts all."""
    powers = Powers()
    seen, hits = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
    for batch in batches(source):
        toxic = batch.column("toxic").to_numpy() > 0
        for block in blocks(batch.column("text")):
            docs, own = block.last - block.first, toxic[block.first : block.last]
            found = sentences(block, powers)
            key = np.sort(found.doc[found.sentence] * BUCKETS + found.bucket)
            key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
            doc, bucket = key // BUCKETS, key % BUCKETS
            seen[:-1] += np.bincount(bucket, minlength=BUCKETS)
            hits[:-1] += np.bincount(bucket[own[doc]], minlength=BUCKETS)
            seen[-1] += docs
            hits[-1] += int(own.sum())
    some = np.flatnonzero(seen)
    names = ["bucket", "seen", "hits"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.where(some == BUCKETS, -1, some), pa.int64()), pa.array(seen[some]), pa.array(hits[some])], names=names
    )


def _bags(sent):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(), sent.value > 0
        for batch in batches(source):
            for block in blocks(batch.column("text")):
                found = sentences(block, powers)
                docs = block.last - block.first
                use = known[found.bucket]
                bucket = found.bucket[use]
                per = np.bincount(found.sentence[use], minlength=len(found.doc))
                by_doc = np.searchsorted(found.doc, np.arange(docs + 1))
                ends = np.concatenate(([0], np.cumsum(per)))
                cut = list(zip(by_doc[:-1].tolist(), by_doc[1:].tolist()))
                words = [bucket[ends[a] : ends[b]] for a, b in cut]
                piece = batch.slice(block.first, docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("order"),
                        piece.column("toxic").cast(pa.int32()),
                        pa.array([len(x) + b - a for x, (a, b) in zip(words, cut)], pa.int64()),
                        pa.array([x.astype(np.int32).tobytes() for x in words], pa.binary()),
                        pa.array([per[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                    ],
                    names=["order", "toxic", "n", "words", "sizes"],
                )

    return rows


def train(
    docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS
) -> Model:
    """Fit to labelled documents; ``labels`` has doc_id and toxic."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("order", spread(F.col("doc_id")))
        .orderBy("order", "doc_id")
        .limit(train_docs)
    )
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most train_docs rows of three numbers
    counted = (
        labelled.select("toxic", "text")
        .mapInArrow(_occurrences, "bucket long, seen long, hits long")
        .groupBy("bucket")
        .agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits"))
        .where((F.col("bucket") < 0) | (F.col("hits") > 0) & (F.col("seen") >= LEAST_DOCS))
        .toArrow()  # at most a row per bucket
    )
    bucket, seen, hits = (counted.column(x).to_numpy() for x in ("bucket", "seen", "hits"))
    everything = bucket < 0
    guess = np.zeros(BUCKETS)
    if everything.any():
        guess[bucket[~everything]] = first_guess(
            seen[~everything], hits[~everything], int(seen[everything][0]), int(hits[everything][0])
        )
    sent = docs.sparkSession.sparkContext.broadcast(guess)
    bags = (
        labelled.select("order", "toxic", "text")
        .mapInArrow(_bags(sent), "order long, toxic int, n long, words binary, sizes binary")
        .orderBy("order", "n")
        .limit(2 * train_docs)
    )
    rows = fitting_rows(bags, ["order", "n"], "n", train_words, F.col("toxic") > 0).select(["toxic", "words", "sizes"])
    return fit(
        [
            (np.frombuffer(w, np.int32), np.frombuffer(s, np.int32), int(t > 0))
            for t, w, s in zip(*(rows.column(i).to_pylist() for i in range(3)))
        ],
        guess,
    )


def _scores(sent, passed: list[str], locate: bool):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, powers = Model(*sent.value), Powers()
        for batch in batches(source):
            for block in blocks(batch.column("text")):
                docs = block.last - block.first
                found = sentences(block, powers)
                p = sentence_scores(found, model)
                clean = np.bincount(found.doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=docs)
                piece = batch.slice(block.first, docs)
                columns = [pa.array(-np.expm1(clean))]
                names = ["score"]
                if locate:
                    columns.append(_offending(block, found, p))
                    names.append("offending")
                columns += [piece.column(x) for x in passed]
                yield pa.RecordBatch.from_arrays(columns, [*names, *passed])

    return rows


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _offending(block: Block, found: Sentences, p: np.ndarray) -> pa.Array:
    """Per text: code point spans of the sentences that are likelier toxic than not."""
    out: list[list[dict]] = [[] for _ in range(block.last - block.first)]
    chars = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    for k in np.flatnonzero(p >= 0.5).tolist():
        doc = int(found.doc[k])
        origin = int(chars[block.offsets[doc]])
        span = {"start": int(chars[found.start[k]]) - origin, "end": int(chars[found.end[k]]) - origin}
        out[doc].append(span | {"score": float(p[k])})
    return pa.array(out, _SPANS)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), locate: bool = False) -> DataFrame:
    """Add ``score`` (and with ``locate`` the ``offending`` sentences) to the kept columns."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kinds = dict(docs.dtypes)
    names = [f"_k{i}" for i in range(len(keep))]
    schema = ["score double"]
    if locate:
        schema.append("offending array<struct<start:int,end:int,score:double>>")
    schema += [f"{n} {kinds[c]}" for c, n in zip(keep, names)]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text").alias("text"))
    scored = source.mapInArrow(_scores(sent, names, locate), ", ".join(schema))
    extra = [F.col("offending")] if locate else []
    return scored.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "score", *extra)
