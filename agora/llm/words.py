"""Words of many texts at once: NumPy scans over the bytes of Arrow columns.

A text is never turned into Python strings here.  ``blocks`` cuts a column into
runs of whole texts of about a megabyte, ``scan`` finds all words of a block and
hashes each one with 64 bits.  Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1

#: A-Z become a-z, all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that are no ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters and digits, and every byte beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            self.up = np.cumprod(np.full(size, _BASE, np.uint64))
            self.down = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
        return self.up[:n], self.down[:n]


class Block(NamedTuple):
    """Whole texts: rows first..last of a column, their bytes and where each one starts."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Start and end byte, text and hash of each word, in order; ``part`` hashes inner byte ranges."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    part: Callable[[np.ndarray, np.ndarray], np.ndarray]


def arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at


def blocks(column, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Runs of whole texts of about ``size`` bytes; a longer text is a block of its own."""
    raw, at = arrays(column)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + size, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield Block(first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def scan(block: Block, member: np.ndarray, powers: Powers) -> Words:
    """All maximal runs of ``member`` bytes, hashed after lower-casing A-Z."""
    data, offsets = block.data, block.offsets
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.empty(0, np.uint64), lambda a, b: np.empty(0, np.uint64))
    inside = member[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    cut[0] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    close = inside.copy()
    close[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(close) + 1
    up, down = powers.upto(n + 1)
    up = up[:n]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[LOWER[data]] * up, out=sums[1:])

    def part(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((sums[last] - sums[first]) * down[first])

    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, doc, part(start, end), part)


def hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that ``scan`` gives to these words, which are lower-cased already."""
    out = np.empty(len(words), np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    letters = [int(x) for x in _LETTER]
    for k, word in enumerate(words):
        value, power = 0, _BASE
        for byte in word:
            value = (value + letters[byte] * power) & _MASK
            power = (power * _BASE) & _MASK
        out[k] = (value * inverse) & _MASK
    return mix(out)


def counts_per_doc(words: Words, docs: int) -> np.ndarray:
    """Number of words of each text of a block."""
    return np.bincount(words.doc, minlength=docs).astype(np.int64)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; run i starts at word i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * np.uint64((_BASE * (2 * k + 3)) & _MASK | 1)
        total = mix(total) if k % 4 == 3 else total
    return mix(total)
