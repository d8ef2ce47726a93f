"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of whole documents.  Its words become symbols, every document
ends in a separator of its own, and the index over them is

* the Burrows-Wheeler transform of that sequence as a wavelet matrix with rank
  counts, and the number of smaller symbols ahead of each symbol,
* the text position of every ``SAMPLE``-th word, found by walking back from a row.

All phrases of the benchmark are searched backwards at once, one rank step per
word; the rows that remain are located and their words marked.  Marked words that
touch make one removal span.

A word is a run of digits, letters a-z after lower-casing A-Z, and characters
beyond ASCII.  A phrase is ``window`` consecutive words of an item, or the whole
item if it has fewer (but some).  A document is contaminated when at least
1/``share`` of its words are marked.

The benchmark is the query set: it is read in blocks of at most ``block_words``
words (an item is never split), each block is broadcast by itself and met with
all documents.  Documents are never shuffled.

Nulls: a null text has no words, a null item is skipped, a null ``doc_id`` is kept
as it is.  Repeated rows are judged each by itself.  Empty tables give an empty
result or no hits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import batches
from agora.llm.words import ALNUM, Block, Powers, blocks, scan

WINDOW = 13
SHARE = 20
SAMPLE = 16
BLOCK_WORDS = 2_000_000
SHARD_BYTES = 3 << 19

HITS = "doc_id long, n_words long, n_hit long, spans array<struct<start:int,end:int>>, items array<bigint>"


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Rank of every suffix; symbols are 0.. without gaps, the last one is unique."""
    n = len(symbols)
    base = int(symbols.max()) + 2
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(2, np.int64)])
    keys = (padded[:-2] * base + padded[1:-1]) * base + padded[2:] if base < 1 << 21 else padded[:-2]
    reach = 3 if base < 1 << 21 else 1
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n + 1, np.int64)
    rank[order] = first
    rank[n] = -1
    alone = new & np.append(new[1:], True)
    open_ = order[~alone]
    while len(open_):
        keys = (rank[open_] << 32) | (rank[np.minimum(open_ + reach, n)] + 1)
        by = np.argsort(keys)
        open_, keys = open_[by], keys[by]
        group = keys >> 32
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        starts = np.concatenate(([True], group[1:] != group[:-1]))
        group_start = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        run_start = np.flatnonzero(new)[np.cumsum(new) - 1]
        rank[open_] = group + (run_start - group_start)
        alone = new & np.append(new[1:], True)
        open_, reach = open_[~alone], reach * 2
    return rank[:n]


class Index:
    """FM-index of a sequence of symbols 0..; the last symbol occurs once."""

    def __init__(self, symbols: np.ndarray):
        n = self.length = len(symbols)
        rank = suffix_ranks(symbols)
        suffixes = np.empty(n, np.int64)
        suffixes[rank] = np.arange(n)
        last = symbols[suffixes - 1]  # row 0's neighbour is the last symbol, as the text is read in a circle
        size = np.bincount(symbols)
        self.smaller = np.concatenate(([0], np.cumsum(size)))
        self.bits = max(1, int(len(size) - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        level = last
        for k in range(self.bits - 1, -1, -1):
            bit = (level >> k) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            set_ = bit.astype(bool)
            level = np.concatenate([level[~set_], level[set_]])
        sampled = suffixes % SAMPLE == 0
        self.sampled = sampled
        self.samples = suffixes[sampled]
        self.sample_at = np.cumsum(sampled) - 1

    def _down(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Places of ``rows`` at the lowest level, on each symbol's way."""
        for k, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            counted = ones[rows]
            rows = np.where((symbols >> k) & 1, zeros + counted, rows - counted)
        return rows

    def rank(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform ahead of a row."""
        return self._down(symbols, rows) - self._down(symbols, np.zeros_like(rows))

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of phrases, given by row and padded; -1 is in no text."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.length, np.int64)
        for step in range(phrases.shape[1]):
            at = sizes - 1 - step
            use = np.flatnonzero((at >= 0) & (high > low))
            if not len(use):
                break
            symbol = phrases[use, at[use]]
            high[use[symbol < 0]] = low[use[symbol < 0]]
            use, symbol = use[symbol >= 0], symbol[symbol >= 0]
            start = self._down(symbol, np.zeros(len(use), np.int64))
            low[use] = self.smaller[symbol] + self._down(symbol, low[use]) - start
            high[use] = self.smaller[symbol] + self._down(symbol, high[use]) - start
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to the next sampled position, counting steps."""
        out = np.zeros(len(rows), np.int64)
        open_, walked = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            done = self.sampled[rows[open_]]
            at = open_[done]
            out[at] = self.samples[self.sample_at[rows[at]]] + walked
            open_ = open_[~done]
            here = rows[open_]
            symbol, place = np.zeros(len(open_), np.int64), here
            for ones, zeros in zip(self.ones, self.zeros):
                counted = ones[place]
                bit = ones[place + 1] - counted
                symbol = symbol * 2 + bit
                place = np.where(bit, zeros + counted, place - counted)
            start = self._down(symbol, np.zeros(len(open_), np.int64))
            rows[open_] = self.smaller[symbol] + place - start
            walked += 1
        return out


class Phrases(NamedTuple):
    """A block of the benchmark: distinct phrases as numbers of words, and the items that hold each."""

    vocabulary: np.ndarray  # word hashes, ascending
    words: np.ndarray  # (phrases, window) numbers into the vocabulary, padded with -1
    sizes: np.ndarray
    item_from: np.ndarray  # phrase i is in items item_ids[item_from[i] : item_from[i + 1]]
    item_ids: np.ndarray


def phrases_of(rows: list[tuple[int, str]], window: int) -> Phrases:
    """All distinct phrases of the items (id, text)."""
    powers, seen = Powers(), {}
    for item, text in rows:
        column = pa.array([text], pa.large_string())
        for block in blocks(column):
            hashes = scan(block, ALNUM, powers).hash.tolist()
            width = min(window, len(hashes))
            for at in range(len(hashes) - width + 1 if width else 0):
                seen.setdefault(tuple(hashes[at : at + width]), set()).add(item)
    keys = list(seen)
    sizes = np.array([len(x) for x in keys], np.int64)
    flat = np.array([h for x in keys for h in x], np.uint64)
    vocabulary = np.sort(np.array(list(set(flat.tolist())), np.uint64))
    words = np.full((len(keys), int(sizes.max()) if len(keys) else 1), -1, np.int64)
    if len(keys):
        row = np.repeat(np.arange(len(keys)), sizes)
        words[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.searchsorted(vocabulary, flat)
    items = [sorted(seen[x]) for x in keys]
    item_from = np.concatenate(([0], np.cumsum([len(x) for x in items], dtype=np.int64))).astype(np.int64)
    return Phrases(vocabulary, words, sizes, item_from, np.array([i for x in items for i in x], np.int64))


def _marked(block: Block, phrases: Phrases, powers: Powers):
    """Words of a shard, which of them are marked, and the (text, phrase) pairs that occur."""
    words = scan(block, ALNUM, powers)
    docs = block.last - block.first
    mark = np.zeros(len(words.hash), dtype=bool)
    none = np.empty(0, np.int64)
    if not len(words.hash) or not len(phrases.sizes):
        return words, mark, none, none
    order = np.argsort(words.hash)
    ordered = words.hash[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1 + docs
    known = ordered[new]
    # words stand behind the separators of earlier texts; separators are the numbers below docs
    place = np.arange(len(number)) + words.doc
    symbols = np.empty(len(number) + docs, np.int64)
    symbols[place] = number
    gaps = np.ones(len(symbols), dtype=bool)
    gaps[place] = False
    symbols[gaps] = np.arange(docs)
    at = np.minimum(np.searchsorted(known, phrases.vocabulary), len(known) - 1)
    translate = np.append(np.where(known[at] == phrases.vocabulary, at + docs, -1), -1)
    wanted = translate[phrases.words]
    alive = np.flatnonzero((wanted >= 0).sum(axis=1) == phrases.sizes)
    if not len(alive):
        return words, mark, none, none
    index = Index(symbols)
    low, high = index.search(wanted[alive], phrases.sizes[alive])
    found = np.maximum(high - low, 0)
    which = np.repeat(alive, found)
    ends = np.cumsum(found)
    rows = np.arange(len(which)) + np.repeat(low - (ends - found), found)
    text_at = index.locate(rows)
    doc_of = np.searchsorted(np.flatnonzero(gaps), text_at, "left")
    first = text_at - doc_of
    step = np.zeros(len(mark) + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + phrases.sizes[which], -1)
    return words, np.cumsum(step)[:-1] > 0, doc_of, which


def _search(phrases_sent, passed: list[str]):
    """Rows of ``HITS`` for texts, and the columns ``passed`` as they came.

    Where the batches have the marks of earlier blocks, these are added.
    """

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(*phrases_sent.value)
        powers = Powers()
        for batch in batches(source):
            for block in blocks(batch.column("text"), SHARD_BYTES):
                yield _shard_result(batch, block, phrases, powers, passed)

    return rows


def _shard_result(
    batch: pa.RecordBatch, block: Block, phrases: Phrases, powers: Powers, passed: list[str]
) -> pa.RecordBatch:
    docs = block.last - block.first
    words, mark, doc_of, which = _marked(block, phrases, powers)
    items: list[list[int]] = [[] for _ in range(docs)]
    spans: list[list[dict]] = [[] for _ in range(docs)]
    keys = np.array(sorted(set((doc_of * len(phrases.sizes) + which).tolist())), np.int64) if len(which) else which
    for key in keys.tolist():
        doc, phrase = divmod(key, len(phrases.sizes))
        items[doc] += phrases.item_ids[phrases.item_from[phrase] : phrases.item_from[phrase + 1]].tolist()
    piece = batch.slice(block.first, docs)
    if "marks" in batch.schema.names:
        before = piece.column("marks").to_pylist()
        from_word = np.searchsorted(words.doc, np.arange(docs))
        for doc, runs in enumerate(before):
            for a, b in runs:
                mark[from_word[doc] + a : from_word[doc] + b] = True
            items[doc] += piece.column("items")[doc].as_py()
    items = [sorted(set(x)) for x in items]
    hit = np.flatnonzero(mark)
    marks: list[list[list[int]]] = [[] for _ in range(docs)]
    if len(hit):
        chars = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
        doc = words.doc[hit]
        head = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (doc[1:] != doc[:-1])))
        first, last = hit[head], hit[np.append(np.flatnonzero(head)[1:] - 1, len(hit) - 1)]
        from_word = np.searchsorted(words.doc, np.arange(docs))
        for a, b in zip(first.tolist(), last.tolist()):
            d = int(words.doc[a])
            origin = int(chars[block.offsets[d]])
            spans[d].append({"start": int(chars[words.start[a]]) - origin, "end": int(chars[words.end[b]]) - origin})
            marks[d].append([a - int(from_word[d]), b + 1 - int(from_word[d])])
    n_words = np.bincount(words.doc, minlength=docs)
    n_hit = np.bincount(words.doc[hit], minlength=docs)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns = [
        piece.column("doc_id").cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array(spans, span), pa.array(items, pa.list_(pa.int64())),
    ]
    names = ["doc_id", "n_words", "n_hit", "spans", "items"]
    for name in passed:
        columns.append(pa.array(marks, pa.list_(pa.list_(pa.int32()))) if name == "marks" else piece.column(name))
    return pa.RecordBatch.from_arrays(columns, [*names, *passed])


def _benchmark_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Phrases]:
    held: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text")
    for row in rows.toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1]) // 2 + 1
        if size >= block_words:
            yield phrases_of(held, window)
            held, size = [], 0
    if held:
        yield phrases_of(held, window)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = SHARE,
    block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: words, marked words, removal spans (code points), items, verdict.

    ``keep`` names columns of ``docs`` to bring along.
    """
    spark = docs.sparkSession
    kept = [f"_k{i}" for i in range(len(keep))]
    kinds = dict(docs.dtypes)
    found = docs.select("doc_id", "text", *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    queue = _benchmark_blocks(benchmark, window, block_words)
    phrases = next(queue, None) or phrases_of([], window)
    while phrases is not None:
        later = next(queue, None)
        sent = spark.sparkContext.broadcast(tuple(phrases))
        passed = [*kept, *(["text", "marks"] if later is not None else [])]
        schema = ", ".join([HITS, *(f"{k} {kinds[c]}" for c, k in zip(keep, kept))])
        if later is not None:
            schema += ", text string, marks array<array<int>>"
        found = found.mapInArrow(_search(sent, passed), schema)
        phrases = later
    dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    own = ["doc_id", "n_words", "n_hit", "spans", "items", dirty.alias("contaminated")]
    return found.select(*own, *[F.col(k).alias(f"kept_{c}") for c, k in zip(keep, kept)])


def without_spans(text, spans):
    """The text less its removal spans (code points)."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda done, span: F.struct(
            F.concat(done["kept"], F.substring(text, done["at"] + 1, span["start"] - done["at"])).alias("kept"),
            span["end"].alias("at"),
        ),
    )
    return F.concat(cut["kept"], F.substring(text, cut["at"] + 1, F.length(text)))


SQL = r"""
with read as (
  select doc_id, regexp_extract_all(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
items as (
  select item_id, regexp_extract_all(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
phrases as (
  select distinct item_id, k,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase
  from (select item_id, w, least(13, len(w)) as k from items where len(w) > 0) cut
),
places as (
  select doc_id, k, unnest(range(1, len(w) - k + 2)) as i,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase
  from read, (select distinct k from phrases) lengths
),
found as (select doc_id, item_id, i, k from places join phrases using (k, phrase)),
hit as (
  select doc_id, count(distinct place) as n from (select doc_id, unnest(range(i, i + k)) as place from found) each_word
  group by doc_id
),
named as (
  select doc_id, list_sort(list_distinct(list(cast(item_id as varchar)))) as ids from found group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_hit,
  cast(coalesce(len(ids), 0) as bigint) as n_items,
  sha256(array_to_string(coalesce(ids, []), ',')) as items_sha256,
  coalesce(n, 0) > 0 and 20 * coalesce(n, 0) >= len(w) as contaminated
from read left join hit using (doc_id) left join named using (doc_id)
"""
