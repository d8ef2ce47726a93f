"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds to them.

Base spans come from three patterns (``PATTERNS``), the leftmost matches of each
that do not overlap.  The field tags tokens, runs of letters, digits, ``+/_-`` and
characters beyond ASCII, as the beginning of a secret, its inside or outside.  A
sequence is a line, cut after ``.``, ``!`` or ``?`` before white space.  Features of a
token: its shape (length, kinds of characters, changes between letters and
digits), its first four bytes, the words before and after and what separates
them, and the file's share of digits, length and assignments.  Sequences are
decoded by Viterbi, all of a block side by side.

The field is trained on what the base patterns mark in a bounded sample of
``train_docs`` documents (the smallest hashes of ``doc_id``): every sequence with a
secret and one in ``KEEP_ONE`` of the others, up to ``train_tokens`` tokens, pieces
of at most ``PIECE`` tokens.  Every document is scanned whole.  An added span that
touches a base span is dropped, base spans always stay.

Nulls: a null text is an empty one and has no span, a null ``doc_id`` is kept.
Repeated rows have equal results.  Without a secret in the sample the field adds
nothing.  An empty table gives an empty result.  Other columns are ignored.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import batches, spread
from agora.llm.words import Block, Powers, blocks, mix, scan

TRAIN_DOCS = 20_000
TRAIN_TOKENS = 400_000
KEEP_ONE = 40
PIECE = 120
ROUNDS = 45
KINDS = ("assign", "access", "hex", "crf")

# The base patterns, the group that must be long enough, and its length.
PATTERNS = (
    (
        "assign",
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # runs that are long enough, found at once


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(x) for x in chars]] = True
    return out


_DIGIT, _LOW = _class("0123456789"), _class("abcdefghijklmnopqrstuvwxyz")
_UP, _SIGN, _HEX = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("+/_-"), _class("0123456789abcdef")
_BEYOND = np.arange(256) >= 128
_TOKEN = _DIGIT | _LOW | _UP | _SIGN | _BEYOND
_SPACE, _STOP = _class(" \t\r\n\x0b\x0c"), _class(".!?")

# (name, values) of each feature; a feature's values follow those of the earlier ones
_SIZES = (8 * 64, 40, 4096, 2048, 32, 32, 4096, 4096, 48)
_FROM = np.concatenate(([0], np.cumsum(_SIZES)))
FEATURES = int(_FROM[-1])
OUTSIDE, BEGIN, INSIDE = 0, 1, 2


class Tokens(NamedTuple):
    """Tokens of a block: bytes start..end, text, feature values (n, 9), and where sequences begin."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    codes: np.ndarray
    heads: np.ndarray


def tokens(block: Block, powers: Powers) -> Tokens:
    data, docs = block.data, block.last - block.first
    words = scan(block, _TOKEN, powers)
    n = len(words.hash)
    if not n:
        none = np.empty(0, np.int64)
        return Tokens(none, none, none, np.empty((0, len(_SIZES)), np.int32), none)
    sums = lambda member: np.concatenate(([0], np.cumsum(member[data], dtype=np.int32)))
    within = lambda total: total[words.end] - total[words.start]
    digit, low, up = sums(_DIGIT), sums(_LOW), sums(_UP)
    sign, beyond, hexed = sums(_SIGN), sums(_BEYOND), sums(_HEX)
    size = words.end - words.start
    length = np.searchsorted([4, 7, 12, 16, 20, 24, 40], size, "right")
    kinds = (
        (within(low) > 0) * 1 + (within(up) > 0) * 2 + (within(digit) > 0) * 4 + (within(sign) > 0) * 8
        + (within(beyond) > 0) * 16 + (within(hexed) == size) * 32
    )
    change = np.zeros(len(data) + 1, np.int32)
    change[2:] = np.cumsum(_DIGIT[data[1:]] != _DIGIT[data[:-1]])
    turns = np.searchsorted([1, 2, 4, 8], change[words.end] - change[words.start + 1], "right")
    # what stands between a token and the one before; a text's ends count as a line's
    sep = np.zeros(n + 1, np.int64)
    first = np.ones(n + 1, dtype=bool)
    first[1:n] = words.doc[1:] != words.doc[:-1]
    gap_from = np.where(first[:n], block.offsets[words.doc], np.append(0, words.end[:-1]))
    flags = ((_class("=:"), 1), (_class("\"'"), 2), (_class("\n"), 4), (_class(".!?,;"), 8))
    for member, bit in flags:
        total = sums(member)
        sep[:n] += bit * (total[words.start] > total[gap_from])
    sep[:n][first[:n]] |= 4
    sep[:n] += 16 * (words.start - gap_from == 1)
    stops = np.zeros(len(data) + 1, dtype=np.int32)
    stops[2:] = np.cumsum(_STOP[data[:-1]] & _SPACE[data[1:]])
    new = first[:n] | ((sep[:n] & 4) > 0) | (stops[words.start] > stops[gap_from])
    after = np.append(sep[1:n], 4)
    after[first[1:]] = 4
    word = (words.hash % np.uint64(4096)).astype(np.int64)
    before = np.where(new, 0, np.append(0, word[:-1]))
    new_next = np.append(new[1:], True)
    behind = np.where(new_next, 0, np.append(word[1:], 0)) % 2048
    head4 = (words.part(words.start, words.start + np.minimum(size, 4)) % np.uint64(4096)).astype(np.int64)
    both = (mix((before * 32 + sep[:n]).astype(np.uint64)) % np.uint64(4096)).astype(np.int64)
    chars = np.diff(block.offsets)
    share = np.diff(digit[block.offsets]) / np.maximum(chars, 1)
    assigns = np.diff(sums(_class("="))[block.offsets]) > 0
    file = (
        np.searchsorted([0.002, 0.01, 0.03, 0.1, 0.3], share, "right") * 8
        + np.searchsorted([300, 2000, 10_000], chars, "right") * 2 + assigns
    )
    columns = (length * 64 + kinds, turns * 8 + length, before, behind, sep[:n], after, both, head4, file[words.doc])
    codes = np.stack([c + f for c, f in zip(columns, _FROM)], axis=1).astype(np.int32)
    assert docs >= 1
    return Tokens(words.start, words.end, words.doc, codes, np.flatnonzero(new))


def base_spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """Base matches (kind, start, end, start and end of the secret itself), by start and then kind."""
    out = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        if kind == "assign" and "=" not in text and ":" not in text:
            continue
        if kind == "hex":
            pattern = _LONG_HEX
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), rank, kind, m.end(), m.start(group), m.end(group)))
    return [(kind, start, end, a, b) for start, _, kind, end, a, b in sorted(out)]


def _suspects(block: Block) -> np.ndarray:
    """Texts in which a base pattern can match at all."""
    data = block.data
    docs = block.last - block.first
    out = np.zeros(docs, dtype=bool)
    at = np.flatnonzero(_class("=:A")[data])
    out[np.searchsorted(block.offsets, at, "right") - 1] = True
    member = np.concatenate(([False], _HEX[data], [False]))
    edge = np.flatnonzero(member[1:] != member[:-1])
    start, end = edge[::2], edge[1::2]
    # runs go on over the end of a text here, which only adds suspects
    long = np.flatnonzero(end - start >= 24)
    for k in long.tolist():
        first, last = np.searchsorted(block.offsets, [start[k], end[k] - 1], "right") - 1
        out[first : last + 1] = True
    return out


def _text(block: Block, doc: int) -> str:
    return block.data[block.offsets[doc] : block.offsets[doc + 1]].tobytes().decode("utf-8", "replace")


class Model(NamedTuple):
    """Weights of feature values (FEATURES, 3), of tags after tags (3, 3) and of first tags (3)."""

    weights: np.ndarray
    follow: np.ndarray
    first: np.ndarray


def emissions(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = weights[codes[:, 0]].copy()
    for k in range(1, codes.shape[1]):
        out += weights[codes[:, k]]
    return out


def viterbi(scores: np.ndarray, heads: np.ndarray, model: Model) -> np.ndarray:
    """The best tag sequence of each run of tokens that starts at ``heads``."""
    n = len(scores)
    tags = np.zeros(n, np.int8)
    if not n:
        return tags
    size = np.diff(np.append(heads, n))
    by = np.argsort(-size, kind="stable")
    heads, size = heads[by], size[by]
    best = scores[heads] + model.first
    back: list[np.ndarray] = []
    running = [len(heads)]
    done = np.empty(len(heads), np.int8)
    for step in range(1, int(size[0])):
        live = int(np.searchsorted(-size, -step, "left"))
        done[live : running[-1]] = best[live:].argmax(axis=1)
        options = best[:live, :, None] + model.follow
        origin = options.argmax(axis=1)
        best = np.take_along_axis(options, origin[:, None, :], axis=1)[:, 0, :] + scores[heads[:live] + step]
        back.append(origin.astype(np.int8))
        running.append(live)
    done[: running[-1]] = best.argmax(axis=1)
    now = done
    for step in range(int(size[0]) - 1, -1, -1):
        live = running[step]
        tags[heads[:live] + step] = now[:live]
        if step:
            now[:live] = back[step - 1][np.arange(live), now[:live]]
    return tags


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = ROUNDS) -> Model | None:
    """Maximum likelihood by Adagrad over (codes, tags) of sequences; None without any secret."""
    sequences = [x for x in sequences if len(x[1])]
    if not any((tags > 0).any() for _, tags in sequences):
        return None
    sequences = sorted(sequences, key=lambda x: -len(x[1]))
    size = np.array([len(t) for _, t in sequences])
    codes, tags = np.concatenate([c for c, _ in sequences]), np.concatenate([t for _, t in sequences]).astype(np.int64)
    heads = np.cumsum(size) - size
    live = [int(np.searchsorted(-size, -s, "left")) for s in range(int(size[0]))]
    weights, follow, first = np.zeros((FEATURES, 3)), np.zeros((3, 3)), np.zeros(3)
    follow[OUTSIDE, INSIDE], first[INSIDE] = -4.0, -4.0
    learned = [np.full_like(x, 1e-6) for x in (weights, follow, first)]
    inner = np.ones(len(tags), dtype=bool)
    inner[heads] = False
    pairs = np.flatnonzero(inner)
    seen_follow = np.zeros((3, 3))
    np.add.at(seen_follow, (tags[pairs - 1], tags[pairs]), 1)
    seen_first = np.bincount(tags[heads], minlength=3)
    one = np.eye(3)[tags]
    lse = lambda x, axis: x.max(axis=axis) + np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis))
    for _ in range(rounds):
        score = emissions(codes, weights)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[heads] = score[heads] + first
        for s in range(1, len(live)):
            at = heads[: live[s]] + s
            forward[at] = lse(forward[at - 1][:, :, None] + follow, 1) + score[at]
        for s in range(len(live) - 2, -1, -1):
            at = heads[: live[s + 1]] + s
            backward[at] = lse(follow + (score[at + 1] + backward[at + 1])[:, None, :], 2)
        total = np.repeat(lse(forward[heads + size - 1], 1), size)
        chance = np.exp(forward + backward - total[:, None])
        joint = np.exp(
            forward[pairs - 1][:, :, None] + follow + (score[pairs] + backward[pairs])[:, None, :] - total[pairs][:, None, None]
        )
        rest = one - chance
        slope = np.zeros_like(weights)
        for k in range(codes.shape[1]):
            for tag in range(3):
                slope[:, tag] += np.bincount(codes[:, k], weights=rest[:, tag], minlength=FEATURES)
        steps = (slope - 0.05 * weights, seen_follow - joint.sum(axis=0) - 0.05 * follow, seen_first - chance[heads].sum(axis=0))
        for value, step, square in zip((weights, follow, first), steps, learned):
            square += step * step
            value += 0.5 * step / np.sqrt(square)
    return Model(weights.astype(np.float32), follow, first)


def _tagged(block: Block, found: Tokens) -> tuple[np.ndarray, dict[int, list]]:
    """Tags by the base patterns, and base spans by text."""
    tags = np.zeros(len(found.start), np.int8)
    spans: dict[int, list] = {}
    for doc in np.flatnonzero(_suspects(block)).tolist():
        text = _text(block, doc)
        own = base_spans(text)
        if not own:
            continue
        spans[doc] = own
        origin = int(block.offsets[doc])
        for _, _, _, a, b in own:
            low = origin + len(text[:a].encode())
            high = low + len(text[a:b].encode())
            first, last = np.searchsorted(found.end, low, "right"), np.searchsorted(found.start, high, "left")
            if first < last and not tags[first:last].any():
                tags[first:last] = INSIDE
                tags[first] = BEGIN
    return tags, spans


def _training(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches(source):
        for block in blocks(batch.column("text")):
            found = tokens(block, powers)
            if not len(found.start):
                continue
            tags, _ = _tagged(block, found)
            ends = np.append(found.heads[1:], len(tags))
            hit = np.add.reduceat(tags > 0, found.heads) > 0
            drawn = mix(found.codes[found.heads].sum(axis=1).astype(np.uint64) + (ends - found.heads).astype(np.uint64))
            keep = np.flatnonzero(hit | (drawn % np.uint64(KEEP_ONE) == 0))
            order = batch.slice(block.first, block.last - block.first).column("order").to_numpy()
            rows = []
            for a, b, secret in zip(found.heads[keep].tolist(), ends[keep].tolist(), hit[keep].tolist()):
                for at in range(a, b, PIECE):
                    upto = min(b, at + PIECE)
                    rows.append((int(order[found.doc[a]]), at, int(secret), upto - at, found.codes[at:upto].tobytes(), tags[at:upto].tobytes()))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["order", "at", "secret", "n", "codes", "tags"]
            )


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_tokens: int = TRAIN_TOKENS) -> Model | None:
    """Fit to what the base patterns mark in a bounded sample."""
    picked = (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", spread(F.col("doc_id")).alias("order"))
        .distinct()
        .orderBy("order", "doc_id")
        .limit(train_docs)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")  # at most train_docs rows of two numbers
        .select("order", "text")
        .mapInArrow(_training, "order long, at long, secret int, n long, codes binary, tags binary")
    )
    first = [F.col("secret").desc(), "order", "at", "n"]
    limited = (
        rows.orderBy(*first)
        .limit(train_tokens)
        .withColumn("upto", F.sum("n").over(Window.orderBy(*first).rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("upto") <= train_tokens)
        .select("codes", "tags")
        .toArrow()
    )
    return fit(
        [
            (np.frombuffer(c, np.int32).reshape(-1, len(_SIZES)), np.frombuffer(t, np.int8))
            for c, t in zip(limited.column("codes").to_pylist(), limited.column("tags").to_pylist())
        ]
    )


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _found(sent):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value) if sent.value is not None else None
        powers = Powers()
        for batch in batches(source):
            for block in blocks(batch.column("text")):
                docs = block.last - block.first
                found = tokens(block, powers)
                _, base = _tagged(block, found)
                out = [[{"kind": k, "start": a, "end": b} for k, a, b, _, _ in base.get(d, ())] for d in range(docs)]
                if model is not None and len(found.start):
                    tags = viterbi(emissions(found.codes, model.weights), found.heads, model)
                    _add(block, found, tags, base, out)
                ids = batch.slice(block.first, docs).column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return rows


def _add(block: Block, found: Tokens, tags: np.ndarray, base: dict[int, list], out: list[list[dict]]) -> None:
    """Put the tagged runs that touch no base span among a text's spans, by start and then kind."""
    inside = np.flatnonzero(tags > 0)
    if not len(inside):
        return
    starts_line = np.zeros(len(tags), dtype=bool)
    starts_line[found.heads] = True
    new = (tags[inside] == BEGIN) | starts_line[inside] | np.concatenate(([True], inside[1:] != inside[:-1] + 1))
    firsts = inside[new]
    lasts = inside[np.append(np.flatnonzero(new)[1:] - 1, len(inside) - 1)]
    chars = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
    changed = set()
    for a, b in zip(firsts.tolist(), lasts.tolist()):
        doc = int(found.doc[a])
        origin = int(chars[block.offsets[doc]])
        start, end = int(chars[found.start[a]]) - origin, int(chars[found.end[b]]) - origin
        if all(end <= x[1] or start >= x[2] for x in base.get(doc, ())):
            out[doc].append({"kind": "crf", "start": start, "end": end})
            changed.add(doc)
    for doc in changed:
        out[doc].sort(key=lambda x: (x["start"], KINDS.index(x["kind"])))


def find_secrets(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id and spans (kind, start, end) by start, then kind."""
    sent = docs.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))
    return docs.select("doc_id", "text").mapInArrow(
        _found(sent), "doc_id long, spans array<struct<kind:string,start:int,end:int>>"
    )
