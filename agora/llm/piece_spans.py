"""SentencePiece ids of whole texts, each piece with the bytes of the text it came from.

A text becomes pieces in three steps:

1. Normalising.  At each place the longest key of the model's compiled character map
   that the text goes on with is replaced by its value; a character without a key
   stays.  The map is a double array; all places of a text walk it at once, byte by
   byte, and the longest match of each place is kept.  Then come the model's rules for
   spaces (extra ones, the one in front, the visible mark).  Every byte of the result
   remembers the source byte its character began at.
2. Merging.  The normalised text goes through the sentencepiece library with the model's
   own pieces and scores but with normalising switched off.  If no piece of the
   model has a space mark behind another character, merges never reach over the start of
   a run of spaces; a text is cut there and a chunk's pieces do not depend on
   its neighbours.  Chunks repeat a lot: each is merged once and remembered in a table of
   bounded size.  Other models have their texts merged whole.
3. Projecting.  A piece covers a range of normalised bytes.  Its source span goes from the
   source byte of the first one to that of the first byte behind it.  The spans of
   a text follow each other without gap.  A mark the model adds in front has an empty
   span.  Of the byte pieces of one character the last one has the span, the others
   have empty ones at its start.

``decoded`` is what the library decodes the ids to.

Nulls: a null text is an empty one, a null id is kept.  Empty texts have no pieces.
Long texts are handled whole; a long run without a space is one chunk and is not remembered.
Repeated rows are encoded each.  Empty tables give no rows.  Names of further columns do
not matter; those in ``keep`` come out as ``kept_<name>``.
"""

from __future__ import annotations

import gc
import re
import sys
import types
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import batches

#: Fixed values of the model file's format: numbers of fields and kinds of pieces.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NAME, _CHARSMAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 1, 2, 3, 4, 5
_SUFFIX_SPACES = 24
_UNKNOWN, _USER_DEFINED, _BYTE = 2, 4, 6

MARK = "▁"
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)
_SPACE_BYTES = np.frombuffer(b" ", np.uint8)
LONGEST_REMEMBERED = 64
REMEMBERED = 300_000
_OUT_PIECES = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, raw bytes) of each field of a protocol message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        begin = at
        key = number()
        kind = key & 7
        value: int | bytes
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield key >> 3, value, data[begin:at]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def with_normalizer(model: bytes, spec: bytes) -> bytes:
    """The model with another normaliser message."""
    rest = b"".join(raw for field, _, raw in _fields(model) if field != _NORMALIZER)
    return rest + _varint(_NORMALIZER << 3 | 2) + _varint(len(spec)) + spec


class CharacterMap:
    """A compiled character map: a double array of keys, then the values, each ended by a zero."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4")
        self.values = compiled[4 + size :]

    def longest(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and value of the longest key at each place; length 0 where there is none."""
        length = np.zeros(len(places), np.int64)
        value = np.zeros(len(places), np.int64)
        if not len(self.units):
            return length, value
        units = self.units

        def offset(unit: np.ndarray) -> np.ndarray:
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)

        alive = np.arange(len(places))
        node = np.full(len(places), int(offset(units[:1])[0]), np.int64)
        step = 0
        while len(alive):
            inside = places[alive] + step < len(data)
            alive, node = alive[inside], node[inside]
            byte = data[places[alive] + step].astype(np.int64)
            node = node ^ byte
            unit = units[node]
            same = (unit & 0x800000FF) == byte
            alive, node, unit = alive[same], node[same], unit[same]
            node = node ^ offset(unit).astype(np.int64)
            ends = (unit >> 8) & 1 == 1
            length[alive[ends]] = step + 1
            value[alive[ends]] = units[node[ends]] & 0x7FFFFFFF
            step += 1
        return length, value

    def value(self, at: int) -> bytes:
        return self.values[at : self.values.index(0, at)]


class Normalised(NamedTuple):
    """Normalised bytes and, for each one and for the end, the source byte it stems from."""

    data: np.ndarray
    source: np.ndarray


class Model:
    """A sentencepiece model file taken apart into normaliser and merges."""

    def __init__(self, proto: bytes, remembered: int = REMEMBERED):
        import sentencepiece

        own: dict[int, int | bytes] = {}
        trainer: dict[int, int | bytes] = {}
        pieces: list[dict[int, int | bytes]] = []
        for field, value, _ in _fields(proto):
            if field == _NORMALIZER:
                own = {k: v for k, v, _ in _fields(value)}
            elif field == _TRAINER:
                trainer = {k: v for k, v, _ in _fields(value)}
            elif field == _PIECE:
                pieces.append({k: v for k, v, _ in _fields(value)})
        self.charsmap = CharacterMap(own.get(_CHARSMAP, b"") or b"\0\0\0\0")
        self.dummy = bool(own.get(_DUMMY_PREFIX, 1))
        self.squeeze = bool(own.get(_EXTRA_SPACES, 1))
        self.escape = bool(own.get(_ESCAPE, 1))
        self.suffix = bool(trainer.get(_SUFFIX_SPACES, 0))
        kinds = [piece.get(3, 1) for piece in pieces]
        if _USER_DEFINED in kinds:
            raise ValueError("models with user-defined symbols are not supported")
        texts = [piece[1].decode() for piece in pieces]
        self.unknown = kinds.index(_UNKNOWN)
        self.lengths = np.array([len(x.encode()) for x in texts], np.int64)
        for place, text in enumerate(texts):
            if kinds[place] == _BYTE:
                self.lengths[place] = 1
        marks = np.array([x.count(MARK) for x in texts], np.int64)
        self.source_lengths = self.lengths - (len(_MARK_BYTES) - 1) * marks
        # a byte of ASCII is a character; other bytes are parts of one
        self.odd = np.array([k == _UNKNOWN or (k == _BYTE and int(x[1:-1], 16) > 127) for k, x in zip(kinds, texts)])
        self.cuts = self.escape and not any(re.search(f"[^{MARK}]{MARK}", x) for x in texts)
        own_map = len(self.charsmap.units)
        self.plain = self.cuts and self.dummy and not (self.squeeze or self.suffix or own_map)
        bare = b"".join(
            _varint(field << 3) + _varint(0) for field in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE)
        )
        name = b"identity"
        spec = _varint(_NAME << 3 | 2) + _varint(len(name)) + name + bare
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=with_normalizer(proto, spec))
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def normalise(self, text: str) -> Normalised:
        """The text as the model's pieces spell it, with the source of every byte."""
        data = np.frombuffer(text.encode(), np.uint8)
        n = len(data)
        if not n:
            return Normalised(data, np.zeros(1, np.int64))
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        length, value = self.charsmap.longest(data, starts)
        source = np.repeat(starts, np.diff(np.append(starts, n)))
        if length.any():
            data, source = self._replaced(data, starts, length, value)
        space = data == 0x20
        end = n
        if self.squeeze:
            keep = ~space
            keep[1:] |= space[1:] & ~space[:-1]  # the first space of a run, but not one in front
            if space.all():
                return Normalised(np.empty(0, np.uint8), np.zeros(1, np.int64))
            data, source, space = data[keep], source[keep], space[keep]
        begin = int(source[0])
        mark = _MARK_BYTES if self.escape else _SPACE_BYTES
        if self.escape and space.any():
            times = np.where(space, len(mark), 1)
            source = np.repeat(source, times)
            at = np.cumsum(times) - times
            data = np.repeat(data, times)
            for k, byte in enumerate(mark):
                data[at[space] + k] = byte
        if self.dummy and not self.suffix:
            data = np.concatenate([mark, data])
            source = np.concatenate([np.full(len(mark), begin), source])
        if self.squeeze:
            while data[-len(mark) :].tobytes() == mark.tobytes():
                end = int(source[-len(mark)])
                data, source = data[: -len(mark)], source[: -len(mark)]
        if self.dummy and self.suffix:
            data = np.concatenate([data, mark])
            source = np.concatenate([source, np.full(len(mark), end)])
        return Normalised(data, np.append(source, end))

    def _replaced(self, data, starts, length, value) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches from left to right; what lies inside an earlier match has none of its own."""
        out: list[bytes] = []
        source: list[np.ndarray] = []
        raw, n, upto = data.tobytes(), len(data), 0
        own = np.repeat(starts, np.diff(np.append(starts, n)))
        for k in np.flatnonzero(length).tolist():
            at = int(starts[k])
            if at < upto:
                continue
            new = self.charsmap.value(int(value[k]))
            out += (raw[upto:at], new)
            source += (own[upto:at], np.full(len(new), at))
            upto = at + int(length[k])
        out.append(raw[upto:])
        source.append(own[upto:])
        return np.frombuffer(b"".join(out), np.uint8), np.concatenate(source)

    def _merged(self, chunks: Sequence[str]) -> list[bytes]:
        return [array("i", x).tobytes() for x in self.merges.encode(list(chunks), num_threads=1)]

    def _words(self, spelled: str) -> list[str] | None:
        """What stands behind the marks of a normalised text, if each is a chunk of its own with its mark."""
        if not self.cuts or spelled[:1] != MARK or MARK + MARK in spelled:
            return None
        return spelled[1:].split(MARK)

    def _merge_words(self, lists: Sequence[list[str]]) -> list[np.ndarray]:
        """Ids of texts that are a mark and a word again and again."""
        wanted = set().union(*lists)
        fresh = wanted.difference(self.known)
        if len(self.known) + len(fresh) > self.remembered:
            self.known, fresh = {}, wanted
        new = list(fresh)
        self.known.update(zip(new, self._merged([MARK + x for x in new])))
        ids = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(ids, own)), np.int32) for own in lists]
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del self.known[word]
        return out

    def _merge_whole(self, spelled: str) -> np.ndarray:
        """Ids of any normalised text, cut at runs of marks where that is allowed."""
        chunks = re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", spelled) if self.cuts else [spelled]
        return np.frombuffer(b"".join(self._merged(chunks)), np.int32)

    def merge(self, spelled: Sequence[str]) -> list[np.ndarray]:
        """Ids of normalised texts."""
        lists = [self._words(x) for x in spelled]
        found = iter(self._merge_words([x for x in lists if x is not None]))
        return [self._merge_whole(x) if words is None else next(found) for x, words in zip(spelled, lists)]

    def piece_lengths(self, ids: np.ndarray, spelled: str) -> np.ndarray:
        """Normalised bytes of each piece."""
        lengths = self.lengths[ids]
        if (ids == self.unknown).any():  # an unknown piece has no length of its own
            found = self.merges.encode(spelled, return_type="proto").pieces
            lengths = np.array([len(x.surface.encode()) for x in found], np.int64)
        return lengths

    def _project(self, ids: np.ndarray, normal: Normalised, spelled: str) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(self.piece_lengths(ids, spelled))
        if (int(ends[-1]) if len(ends) else 0) != len(normal.data):
            raise AssertionError("pieces do not spell the normalised text")
        behind = normal.source[ends]
        first = np.empty_like(behind)
        if len(first):
            first[0], first[1:] = normal.source[0], behind[:-1]
        return first, behind

    def encode(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first source byte, source byte behind) of each text's pieces.

        Where the map is empty, spaces stay and the mark is in front, all a normaliser does
        is to write marks for spaces: a piece's source bytes are its own, one for each mark.
        Texts with marks of their own and texts with pieces that are bytes go the long way.
        """
        texts = [x or "" for x in texts]
        lists = [x.split(" ") if self.plain and self._is_plain(x) else None for x in texts]
        quick = iter(self._merge_words([x for x in lists if x is not None]))
        out: list = []
        rest: list[int] = []
        for place, (text, words) in enumerate(zip(texts, lists)):
            out.append(None)
            if words is not None:
                ids = next(quick)
                behind = np.cumsum(self.source_lengths[ids]) - 1
                if not self.odd[ids].any():
                    if behind[-1] != len(text.encode()):
                        raise AssertionError("pieces do not spell the text")
                    out[place] = ids, np.concatenate([[0], behind[:-1]]), behind
                    continue
            rest.append(place)
        normal = [self.normalise(texts[x]) for x in rest]
        spelled = [x.data.tobytes().decode() for x in normal]
        for place, ids, own, text in zip(rest, self.merge(spelled), normal, spelled):
            out[place] = (ids, *self._project(ids, own, text))
        return out

    @staticmethod
    def _is_plain(text: str) -> bool:
        return bool(text) and text[0] != " " and "  " not in text and MARK not in text

    def decode(self, ids: Sequence[np.ndarray]) -> list[str]:
        return self.whole.decode([x.tolist() for x in ids]) if len(ids) else []


def worker_model(path: str) -> Model:
    """The model of this Python process; workers are reused from task to task."""
    home = sys.modules.setdefault("agora_llm_worker", types.ModuleType("agora_llm_worker"))
    models = home.__dict__.setdefault("piece_models", {})
    if path not in models:
        with open(path, "rb") as file:
            models[path] = Model(file.read())
    return models[path]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(len(x) for x in parts)])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def _encoded(path: str, names: list[str]):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        collects = gc.isenabled()
        gc.disable()  # the table of chunks holds no cycles
        try:
            for batch in batches(source):
                texts = batch.column(0)
                done = size = 0
                held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for at in range(0, batch.num_rows, 128):
                    found = model.encode(texts.slice(at, 128).to_pylist())
                    held += found
                    size += sum(len(x[0]) for x in found)
                    if size >= _OUT_PIECES or at + 128 >= batch.num_rows:
                        ids, first, behind = zip(*held)
                        columns = [batch.column(k + 1).slice(done, len(held)) for k in range(len(names))]
                        made = [_lists(list(x)) for x in (ids, first, behind)]
                        decoded = pa.array(model.decode(ids), pa.string())
                        yield pa.RecordBatch.from_arrays(
                            [*columns, *made, decoded], names=[*names, "ids", "starts", "ends", "decoded"]
                        )
                        done, size, held = done + len(held), 0, []
        finally:
            if collects:
                gc.enable()

    return rows


def encode_spans(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: key, ids, starts and ends of their source spans in bytes, decoded, kept_<name> of ``keep``."""
    own = [F.col(key).alias("k0"), *[F.col(c).alias(f"k{i + 1}") for i, c in enumerate(keep)]]
    read = docs.select(F.col(text).cast("string").alias("text"), *own)
    names = [f.name for f in read.schema.fields[1:]]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[1:])
    found = read.mapInArrow(
        _encoded(path, names), f"{kinds}, ids array<int>, starts array<int>, ends array<int>, decoded string"
    )
    renamed = [F.col("k0").alias(key), *[F.col(f"k{i + 1}").alias(f"kept_{c}") for i, c in enumerate(keep)]]
    return found.select(*renamed, "ids", "starts", "ends", "decoded")
