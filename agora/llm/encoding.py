"""Byte-level BPE ids of whole texts, with pieces encoded once.

The vocabulary file is a parameter; ids are those that the tokenizers library
gives.  Byte-level BPE cuts a text into pieces (runs of letters, of numbers and of other
signs, each with the space before it, and line feeds) whose ids do not depend on their
neighbours.  Many texts are cut at once with numpy, by tables of what the library takes a
character for; Arrow numbers the distinct pieces, only these are looked up in a table of
bounded size, and only new ones go to the library's BPE.  As an apostrophe may start a contraction,
what stands between white space around one is a single piece that the library cuts.  A text with
special tokens, with white space in a row or with other than spaces and line feeds is encoded whole.
"""

from __future__ import annotations

import gc
import os
import sys
import types
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

_BATCH = 256
#: Characters of texts that are cut together.
_ROOM = 8 << 20
#: Kinds of characters; those below ``_SPACE`` make runs.
_LETTER, _NUMBER, _SIGN, _QUOTE, _SPACE, _FEED, _ODD, _NEW = range(8)


def _byte_letters() -> dict[int, str]:
    """The character that stands for a byte in a byte-level vocabulary, where it is not the byte's own."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [x for x in range(256) if x not in shown]
    return {x: chr(256 + i) for i, x in enumerate(hidden)}


class Encoder:
    """Encodes texts with the vocabulary file ``path``.

    ``literal_specials`` treats the strings of special tokens as ordinary text.
    ``cached`` bounds the number of remembered pieces; those not met for longest are forgotten.
    """

    def __init__(self, path: str, literal_specials: bool = False, cached: int = 1_200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal_specials
        cutter = self.tokenizer.pre_tokenizer
        #: Whether the vocabulary cuts texts in the way that is followed here.
        self.cuts = (
            self.tokenizer.normalizer is None
            and isinstance(cutter, pre_tokenizers.ByteLevel)
            and cutter.use_regex
            and not cutter.add_prefix_space
        )
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [] if literal_specials else added
        self.cached = cached
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.feed = self._whole(["\n"])[0]
        # the same BPE without a search for pieces: they come in the letters of bytes, set apart by spaces
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.hidden = _byte_letters()
        self.kinds = np.full(0x110000, _NEW, np.uint8)
        self.kinds[[ord("'"), ord(" "), ord("\n")]] = _QUOTE, _SPACE, _FEED

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def _kind(self, char: str) -> int:
        """What the library takes a character for: what it makes one piece with."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for kind, like in ((_LETTER, "a"), (_NUMBER, "1"), (_SIGN, "!")):
            if len(cut(like + char + like)) == 1:
                return kind
        return _ODD

    def _merged(self, pieces: list[bytes], plain: bool) -> dict[bytes, bytes]:
        """Ids of pieces without line feeds; many go through the library in one text.

        ``plain`` ones are whole pieces, others are still to be cut.
        """
        out: dict[bytes, bytes] = {}
        lists = [pieces[i : i + _BATCH] for i in range(0, len(pieces), _BATCH)]
        if plain:
            shown = [x.decode("latin-1").translate(self.hidden) for x in map(b"\n".join, lists)]
            texts = [x.replace("Ċ", " Ċ ") for x in shown]
            found = self.merger.encode_batch_fast(texts, add_special_tokens=False)
            joined = [np.array(x.ids, np.uint32).tobytes() for x in found]
        else:
            joined = self._whole([b"\n".join(x).decode() for x in lists])
        feed = np.frombuffer(self.feed, np.uint32)[0]
        for own, ids in zip(lists, joined):
            cuts = (np.flatnonzero(np.frombuffer(ids, np.uint32) == feed) * 4).tolist()
            starts, ends = [0, *(x + 4 for x in cuts)], [*cuts, len(ids)]
            out.update(zip(own, [ids[a:b] for a, b in zip(starts, ends)], strict=True))
        return out

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null has none."""
        return list(self.stream(texts))

    def stream(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The same, a group of texts at a time."""
        group: list[str] = []
        room = _ROOM
        for text in texts:
            group.append(text or "")
            room -= len(group[-1])
            if room <= 0:
                yield from self._group(group)
                group, room = [], _ROOM
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()  # the table holds no cycles; walking it again and again takes a third of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        whole = [not self.cuts or any(x in text for x in self.specials) for text in texts]
        out: list[bytes] = [b""] * len(texts)
        while True:
            even = [i for i, odd in enumerate(whole) if not odd]
            text = "".join([texts[i] for i in even])
            ends = np.cumsum([len(texts[i]) for i in even], dtype=np.int64)
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            kinds = self.kinds[points]
            new = np.unique(points[kinds == _NEW])
            if len(new):
                self.kinds[new] = [self._kind(chr(x)) for x in new.tolist()]
                kinds = self.kinds[points]
            blank = kinds >= _SPACE
            bad = kinds == _ODD
            bad[1:] |= blank[1:] & blank[:-1]
            first = (ends - [len(texts[i]) for i in even])[: len(even)]
            first = first[first < len(points)]
            bad[first] = kinds[first] == _ODD  # the white space before is another text's
            bad = np.flatnonzero(bad)
            if not len(bad):
                break
            for k in np.unique(np.searchsorted(ends, bad, "right")).tolist():
                whole[even[k]] = True
        odd = [i for i, x in enumerate(whole) if x]
        for k in range(0, len(odd), _BATCH):
            for i, ids in zip(odd[k : k + _BATCH], self._whole([texts[i] for i in odd[k : k + _BATCH]])):
                out[i] = ids
        del points
        if len(kinds):
            ids, cuts = self._cut(text, kinds, first, ends)
            for i, a, b in zip(even, [0, *cuts[:-1]], cuts):
                out[i] = ids[a:b]
        return out

    def _cut(self, text: str, kinds: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[bytes, list[int]]:
        """Ids of texts that follow each other in ``text``, and where each one's end."""
        starts = np.empty(len(kinds), dtype=bool)
        before, now = kinds[:-1], kinds[1:]
        np.not_equal(now, before, out=starts[1:])
        starts[1:] &= before != _SPACE
        quotes = np.flatnonzero(kinds == _QUOTE)
        if len(quotes):  # from the white space before to that behind
            blank = np.flatnonzero(kinds >= _SPACE)
            edges = np.unique(np.concatenate([blank, blank[kinds[blank] == _FEED] + 1, first, [len(kinds)]]))
            held = np.unique(np.searchsorted(edges, quotes, "right") - 1)
            held = held[held >= 0]
            step = np.zeros(len(kinds) + 1, np.int8)
            step[edges[held]] += 1
            step[edges[held + 1]] -= 1
            starts &= np.cumsum(step[:-1], dtype=np.int8) == 0
            starts[edges[edges < len(kinds)]] = True
        starts[first] = True
        at = np.flatnonzero(starts)
        raw = text.encode()
        if len(raw) == len(text):
            offsets = np.append(at, len(raw))
        else:
            heads = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
            offsets = np.append(heads[at], len(raw))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]
        ).dictionary_encode()
        places = np.frombuffer(pieces.dictionary.buffers()[1], np.int64)[: len(pieces.dictionary) + 1].tolist()
        own = pieces.dictionary.buffers()[2].to_pybytes()
        ids = self._look_up([own[a:b] for a, b in zip(places, places[1:])])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begin = np.cumsum(size) - size
        which = pieces.indices.to_numpy()
        sizes = size[which]
        upto = np.cumsum(sizes)
        kind = np.int32 if int(upto[-1]) < 1 << 31 else np.int64
        place = np.repeat((begin[which] - (upto - sizes)).astype(kind), sizes)
        place += np.arange(len(place), dtype=kind)
        cuts = np.concatenate(([0], upto))[np.searchsorted(at, ends)]
        return flat[place].tobytes(), (cuts * 4).tolist()

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.known) > self.cached // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        known[b"\n"] = self.feed
        found = list(map(known.get, pieces))
        left = [i for i, x in enumerate(found) if x is None]
        given = [pieces[i] for i in left]
        kept = list(map(older.get, given))
        fresh = [x for x, ids in zip(given, kept) if ids is None]
        learned = self._merged([x for x in fresh if b"'" not in x], True)
        learned |= self._merged([x for x in fresh if b"'" in x], False)
        for i, piece, ids in zip(left, given, kept):
            found[i] = learned[piece] if ids is None else ids
        known.update([(pieces[i], found[i]) for i in left])
        return found


def worker_encoder(path: str, literal_specials: bool = False) -> Encoder:
    """The encoder of this Python process.

    Workers are reused from task to task, but functions arrive anew with each
    one, so the encoder and its table of chunks hang on a module of the process.
    """
    home = sys.modules.setdefault("agora_llm_worker", types.ModuleType("agora_llm_worker"))
    encoders = home.__dict__.setdefault("encoders", {})
    key = (path, literal_specials)
    if key not in encoders:
        encoders[key] = Encoder(path, literal_specials)
    return encoders[key]
