"""Words of many texts at once, as numpy arrays over the texts' UTF-8 bytes.

A word of the contract is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z
are lower-cased. Every byte of a multi-byte character is 0x80 or more, so the class
can be read off single bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True

_U = np.uint64
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


class Spans(NamedTuple):
    """Byte spans of words; ``rows`` holds the first word of each text, and the total."""

    start: np.ndarray
    size: np.ndarray
    rows: np.ndarray


def runs(mask: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of marked bytes; a run ends where its text ends."""
    n = len(mask)
    before = np.zeros(n + 1, bool)
    before[1:] = mask
    inner = offsets[offsets < n]
    after = np.zeros(n + 1, bool)
    after[:n] = mask
    open_ = before[:n].copy()
    open_[inner] = False
    start = np.flatnonzero(mask & ~open_)
    close = after[1:].copy()
    close[inner[inner > 0] - 1] = False
    end = np.flatnonzero(mask & ~close) + 1
    return Spans(start, end - start, np.searchsorted(start, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (all bits of the result depend on all bits of the input)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def padded(data: np.ndarray) -> np.ndarray:
    """The bytes with eight zeros behind them, as ``hash_spans`` needs."""
    out = np.zeros(len(data) + 8, np.uint8)
    out[:-8] = data
    return out


def hash_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; ``buf`` is padded."""
    at = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
    h = (size.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)
    some = np.arange(len(start))
    pos, left = start, size
    while len(some):
        v = at[pos] & _KEEP[np.minimum(left, 8)]
        x = (h[some] ^ v) * _U(0xD6E8FEB86659FD93)
        h[some] = x ^ (x >> _U(32))
        more = left > 8
        some, pos, left = some[more], pos[more] + 8, left[more] - 8
    return mix(h)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[Spans, np.ndarray]:
    """The contract's words of each text and their hashes."""
    low = padded(LOWER[data])
    spans = runs(WORD_BYTE[low[:-8]], offsets)
    return spans, hash_spans(low, spans.start, spans.size)


def grams(h: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position in text, offsets by text) of all runs of k consecutive words."""
    n = np.maximum(np.diff(rows) - k + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    pos = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
    first = pos + np.repeat(rows[:-1], n)
    out = np.zeros(len(first), np.uint64)
    for j in range(k):
        out = out * _U(0x9FB21C651E98DF25) + (h[first + j] ^ _U(j + 1))
        out ^= out >> _U(29)
    return mix(out + _U(k)), pos, offsets


class SpanTable:
    """Hash table from 64-bit hashes to small numbers, looked up for whole arrays at once."""

    def __init__(self, bits: int = 20):
        self.clear(bits)

    def clear(self, bits: int) -> None:
        self.bits, self.count = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int64)

    @property
    def room(self) -> int:
        return int(0.6 * (1 << self.bits)) - self.count

    def find(self, h: np.ndarray) -> np.ndarray:
        """The value of each hash, or -1."""
        h = np.maximum(h, _U(1))
        mask, out = (1 << self.bits) - 1, np.full(len(h), -1, np.int64)
        todo, slot = np.arange(len(h)), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(todo):
            key = self.keys[slot]
            same = key == h[todo]
            out[todo[same]] = self.values[slot[same]]
            go = ~same & (key != 0)
            todo, slot = todo[go], (slot[go] + 1) & mask
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Put in distinct hashes that the table doesn't have; the caller minds ``room``."""
        h = np.maximum(h, _U(1))
        mask = (1 << self.bits) - 1
        todo, slot = np.arange(len(h)), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = np.flatnonzero(self.keys[slot] == 0)
            self.keys[slot[free]] = h[todo[free]]  # the last of those that want one slot gets it
            won = np.zeros(len(todo), bool)
            won[free] = self.keys[slot[free]] == h[todo[free]]
            self.values[slot[won]] = values[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & mask
        self.count += len(h)
