"""Token files compressed by Re-Pair grammars, with random access.

Documents are dealt by ranges of ``doc_id`` and cut into shards of about
``shard_tokens`` ids, never inside a document.  In each shard the frequent pairs
of neighbouring ids are replaced by nonterminals, again and again, until no pair
occurs ``min_count`` times: three, as a rule takes the room of two symbols.  As in
Re-Pair, where two pairs overlap the more frequent one goes first; all pairs of a
round are replaced at once, and later rounds look at the pairs beside new symbols.  When
these yield no more, all pairs are looked at once again.

A shard is one row of a Parquet file:

====================  ========================================================
``part``, ``shard``   place of the shard: files are read in this order
``first_rule``        the first nonterminal; smaller symbols are token ids
``rules``             two symbols per nonterminal (little-endian uint32)
``lengths``           ids each nonterminal stands for (uint32)
``symbols``           the compressed sequence (uint32)
``doc_ids``           as array<bigint>, so that an id may be null
``doc_ends``          ids of the shard up to the end of each document (int64)
``tokens``            ids of the shard
====================  ========================================================

``decode_range`` expands any range of ids.  It finds the symbols that cover it by their
expansion lengths and takes apart only these, rule by rule, letting go of what lies
outside the range at each step; no other rule is expanded.  Reading whole shards lays all
rules out once instead.

Nulls: a null text is an empty one and has the end id alone; a null ``doc_id``
sorts first and is kept.  Repeated rows are kept, ties are ordered by the text's
hash.  An empty table gives no shard.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.llm.common import batches, shuffle_parts
from agora.llm.encoding import worker_encoder

END_ID = 2
SHARD_TOKENS = 1 << 20
MIN_COUNT = 3

SHARDS = (
    "part int, shard int, first_rule long, rules binary, lengths binary, symbols binary, "
    "doc_ids array<bigint>, doc_ends binary, tokens long"
)
DOCUMENTS = "part int, shard int, row int, doc_id long, offset long, n_tokens long, ids_crc32 long"


def _pick(at: np.ndarray, keys: np.ndarray, bits: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs ``keys``, of ``bits`` bits, at positions ``at`` (ascending): where to replace, and the rank of each one's pair."""
    room = len(keys).bit_length()
    if bits + room <= 64:
        # key and place in one number: sorting it is twice as fast as sorting indirectly
        ordered = np.sort(keys << np.uint64(room) | np.arange(len(keys), dtype=np.uint64))
        order = (ordered & np.uint64((1 << room) - 1)).view(np.int64)
        ordered >>= np.uint64(room)
    else:
        order = np.argsort(keys)
        ordered = keys[order]
    differs = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=differs[1:])
    head = np.flatnonzero(differs)
    count = np.diff(np.append(head, len(ordered)))
    often = np.flatnonzero(count >= min_count)
    # the rank of a pair: by its count, then by its ids; 0 if it is too rare
    rank = np.zeros(len(head), np.int32)
    rank[often[np.argsort(count[often], kind="stable")]] = np.arange(1, len(often) + 1)
    ranks = np.repeat(rank, count)
    of = np.zeros(len(keys), np.int32)
    if len(often) * 2 < len(head):  # most pairs are rare: the places of the others alone
        use = np.flatnonzero(ranks)
        order, ranks = order[use], ranks[use]
    of[order] = ranks
    use = np.flatnonzero(of)
    if len(use) < len(of):
        at, of = at[use], of[use]
    next_to = at[1:] - at[:-1] == 1
    less, same = of[1:] < of[:-1], of[1:] == of[:-1]
    chosen = np.ones(len(of), dtype=bool)
    chosen[1:] &= ~(next_to & less)  # the one before is more frequent
    chosen[:-1] &= ~next_to | less | same  # the one behind is
    # of equal pairs in a row every other one
    row = np.flatnonzero(next_to & same) + 1
    first = np.ones(len(row), dtype=bool)
    first[1:] = row[1:] - row[:-1] != 1
    starts = np.flatnonzero(first)
    place = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    chosen[row[place % 2 == 0]] = False
    return at[chosen], of[chosen]


def compress(
    ids: np.ndarray, first_rule: int, min_count: int = MIN_COUNT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (n, 2) and expansion lengths of a sequence of ids below ``first_rule``."""
    seq = ids.astype(np.uint32)
    live, whole = np.arange(max(len(seq) - 1, 0)), True  # where a pair may have become frequent
    rules = [np.empty((0, 2), np.uint32)]
    known = np.empty(0, np.int64)
    while len(live) or not whole:
        if not len(live):  # pairs that lost to their neighbours may still be frequent elsewhere
            live, whole = np.arange(max(len(seq) - 1, 0)), True
            continue
        bits = (first_rule + len(known)).bit_length()
        left, right = (seq[:-1], seq[1:]) if whole else (seq[live], seq[live + 1])
        at, which = _pick(live, left.astype(np.uint64) << np.uint64(bits) | right, 2 * bits, min_count)
        worth = np.bincount(which, minlength=1) >= 3  # a rule is two symbols long
        keep = worth[which]
        at, which = at[keep], which[keep]
        if not len(at):
            live = live[:0]
            continue
        number = np.cumsum(worth) - 1
        pairs = np.zeros((int(worth.sum()), 2), np.uint32)
        pairs[number[which], 0], pairs[number[which], 1] = seq[at], seq[at + 1]
        size = np.concatenate(([1], known))
        inner = np.maximum(pairs.astype(np.int64) - (first_rule - 1), 0)
        seq[at] = (first_rule + len(known) + number[which]).astype(np.uint32)
        known = np.concatenate([known, size[inner].sum(axis=1)])
        rules.append(pairs)
        left = np.ones(len(seq), dtype=bool)
        left[at + 1] = False
        seq = seq[left]
        fresh = at - np.arange(len(at))  # where the new symbols are now
        live, whole = _beside(fresh, len(seq) - 1), False
    return seq, np.concatenate(rules), known.astype(np.uint32)


def _beside(fresh: np.ndarray, below: int) -> np.ndarray:
    """The ascending positions ``fresh`` and those before them, ascending, without repeats, in 0..below - 1."""
    both = np.empty(2 * len(fresh), np.int64)
    both[::2], both[1::2] = fresh - 1, fresh
    keep = (both >= 0) & (both < below)
    keep[1:] &= both[1:] != both[:-1]
    return both[keep]


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces flat[start : start + size], one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - size), size) + np.arange(total)]


class Grammar:
    """Rules of a shard, ready to expand symbols."""

    def __init__(self, first_rule: int, rules: np.ndarray, lengths: np.ndarray):
        self.first = first_rule
        self.rules = rules.reshape(-1, 2).astype(np.int64)
        self.size = lengths.astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat: np.ndarray | None = None

    def _lay_out(self) -> None:
        """The ids of every rule, one after the other."""
        self.flat = np.empty(int(self.size.sum()), np.uint32)
        # rules only use earlier ones: up to the first that uses one not laid out, they are laid out at once
        latest = (self.rules - self.first).max(axis=1, initial=-1)
        ends = self.start + self.size
        done = 0
        while done < len(ends):
            late = latest[done:] >= done
            upto = done + int(late.argmax()) if late.any() else len(ends)
            self.flat[self.start[done] : ends[upto - 1]] = self.expand(self.rules[done:upto].ravel())
            done = upto

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        """Ids each symbol stands for."""
        out = np.ones(len(symbols), np.int64)
        inner = np.flatnonzero(symbols >= self.first)
        out[inner] = self.size[symbols[inner].astype(np.int64) - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of the symbols, one after the other."""
        if self.flat is None:
            self._lay_out()
        symbols = symbols.astype(np.int64)
        size = self.lengths(symbols)
        # a token id is its own expansion: its place is found, and its value put in, last
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        inner = symbols >= self.first
        start = np.zeros(len(symbols), np.int64)
        start[inner] = self.start[symbols[inner] - self.first]
        place = np.repeat((start - (ends - size)).astype(kind), size)
        place += np.arange(total, dtype=kind)
        single = (ends - size)[~inner]
        if not len(self.flat):
            return symbols.astype(np.uint32)
        out = self.flat[place]
        out[single] = symbols[~inner]
        return out


def decode_range(grammar: Grammar, symbols: np.ndarray, start: int, end: int) -> np.ndarray:
    """Ids start..end of a shard, taking apart only the symbols that cover them."""
    now, begin = symbols.astype(np.int64), 0  # begin: the place of the first id of ``now``
    while True:
        ends = begin + np.cumsum(grammar.lengths(now))
        first = int(np.searchsorted(ends, start, "right"))
        last = min(int(np.searchsorted(ends, end, "left")) + 1, len(now))
        if start >= end or first >= last:
            return np.empty(0, np.uint32)
        begin = int(ends[first - 1]) if first else begin
        now = now[first:last]
        inner = now >= grammar.first
        if not inner.any():
            return now[start - begin : end - begin].astype(np.uint32)
        times = np.where(inner, 2, 1)
        place = np.cumsum(times) - times
        halves = np.repeat(now, times)
        halves[place[inner]], halves[place[inner] + 1] = grammar.rules[now[inner] - grammar.first].T
        now = halves


def _shard_rows(path: str, end_id: int, shard_tokens: int, min_count: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        first_rule = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        schema = pa.schema(
            [
                ("part", pa.int32()), ("shard", pa.int32()), ("first_rule", pa.int64()), ("rules", pa.binary()),
                ("lengths", pa.binary()), ("symbols", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                ("doc_ends", pa.binary()), ("tokens", pa.int64()),
            ]
        )
        part, shard = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32).tobytes()
        keys: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def packed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), np.uint32)
            symbols, rules, lengths = compress(ids, first_rule, min_count)
            ends = np.cumsum([len(x) // 4 for x in held], dtype=np.int64)
            row = {
                "part": part, "shard": shard, "first_rule": first_rule, "rules": rules.tobytes(),
                "lengths": lengths.tobytes(), "symbols": symbols.tobytes(), "doc_ids": list(keys),
                "doc_ends": ends.tobytes(), "tokens": len(ids),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches(source):
            texts = (x.as_py() for x in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), encoder.stream(texts)):
                keys.append(key)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= shard_tokens:
                    yield packed()
                    keys, held, size, shard = [], [], 0, shard + 1
        if held:
            yield packed()

    return rows


def write_shards(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    min_count: int = MIN_COUNT,
) -> None:
    """Encode all documents and write their shards to ``folder``, in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    text = F.col("text")
    (
        docs.select("doc_id", "text")
        .repartitionByRange(shuffle_parts(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64(text))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64(text))
        .mapInArrow(_shard_rows(tokenizer_path, end_id, shard_tokens, min_count), SHARDS)
        .write.option("compression", "zstd")
        .parquet(folder)
    )


def _document_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source):
        for row in batch.to_pylist():
            symbols = np.frombuffer(row["symbols"], np.uint32)
            grammar = Grammar(
                row["first_rule"], np.frombuffer(row["rules"], np.uint32), np.frombuffer(row["lengths"], np.uint32)
            )
            ids = grammar.expand(symbols)
            ends = np.frombuffer(row["doc_ends"], np.int64)
            starts = np.concatenate(([0], ends[:-1]))
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), row["part"], np.int32)),
                    pa.array(np.full(len(ends), row["shard"], np.int32)),
                    pa.array(np.arange(len(ends), dtype=np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts),
                    pa.array(ends - starts),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                ],
                names=["part", "shard", "row", "doc_id", "offset", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, decoded from the files: id, place, number of ids and their crc32.

    Global starts are sums over the files' ``tokens``: within each part, and over
    the parts, of which there are as many as the writing job had tasks.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    sizes = shards.select("part", "shard", "tokens")
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(*earlier)
    along = Window.orderBy("part").rowsBetween(*earlier)
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    bases = parts.select("part", F.coalesce(F.sum("tokens").over(along), F.lit(0)).alias("base"))
    starts = (
        sizes.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .join(bases, "part")
        .select("part", "shard", (F.col("base") + F.col("inside")).alias("shard_start"))
    )
    docs = shards.mapInArrow(_document_rows, DOCUMENTS)
    return docs.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "shard", "row"
    )
