"""Token ids of whole texts by a public BPE tokenizer with word ends.

The vocabulary splits at white space and between letters and punctuation, so the ids of
a text are those of its words in turn. Each worker keeps the ids of the words it has met
(bounded; emptied when full) and gives only new words to the tokenizers library.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from martwright.llm.words import LOWER, SpanTable, hash_spans, padded, runs

END_ID = 1
# Bytes at which texts may be cut: the vocabulary drops white space.
_GAP = np.ones(256, bool)
_GAP[[0x20, 0x0A]] = False
# Punctuation that never belongs to the letters or digits before it, nor to a special token.
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in ".,;:!?*$%&#()"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = True
TAIL_LONGEST = 4
POOL_MOST = 24 << 20


def cut_tails(buf: np.ndarray, start: np.ndarray, size: np.ndarray, tail: np.ndarray = _TAIL):
    """Cut words into a part that ends in an ASCII letter or digit and the punctuation behind it.

    Returns (start, size, parts up to each word); words for which that is not plain stay whole.
    """
    end = start + size
    core = end.copy()
    for _ in range(TAIL_LONGEST):
        more = np.flatnonzero(tail[buf[core - 1]] & (core - 1 > start))
        if not len(more):
            break
        core[more] -= 1
    core = np.where(_ALNUM[buf[core - 1]], core, end)
    two = core < end
    parts = np.concatenate([[0], np.cumsum(1 + two)])
    first = parts[:-1]
    s = np.empty(parts[-1], np.int64)
    z = np.empty(parts[-1], np.int64)
    s[first], z[first] = start, core - start
    s[first[two] + 1], z[first[two] + 1] = core[two], end[two] - core[two]
    return s, z, parts


class TokenIds:
    """``encode(bytes, offsets)`` gives the ids of each text with the end id behind them."""

    def __init__(self, path: str, bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.full = Tokenizer.from_file(path)
        # The same vocabulary for words of letters only, normalized beforehand.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.full.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.small = max(vocab.values()) < 1 << 16
        self.table = SpanTable(bits)
        self._empty()

    def _empty(self) -> None:
        self.table.clear(self.table.bits)
        self.pool = np.zeros(1 << 16, np.uint16 if self.small else np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # of the ids of word i in the pool, from 1
        self.n = 0

    def _new(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(order of the words, their ids one after another, ids of each), by the library."""
        plain = [i for i, t in enumerate(texts) if t.isalpha() and "Σ" not in t and "İ" not in t]
        flat, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if plain:
            joined = " ".join([unicodedata.normalize("NFC", texts[i]).lower() for i in plain])
            flat = np.array(self.plain.encode(joined, add_special_tokens=False).ids, np.uint32)
            counts = np.diff(np.flatnonzero(self.word_end[flat]), prepend=-1)
            if len(counts) != len(plain):
                plain, flat, counts = [], flat[:0], counts[:0]
        known = set(plain)
        rest = [i for i in range(len(texts)) if i not in known]
        ids = [e.ids for e in self.full.encode_batch_fast([texts[i] for i in rest],
                                                          add_special_tokens=False)]
        more = np.array([i for x in ids for i in x], np.uint32)
        return (plain + rest, np.concatenate([flat, more]),
                np.concatenate([counts, np.array([len(x) for x in ids], np.int64)]))

    def _learn(self, h, buf, start, size) -> None:
        raw = buf.tobytes()
        order, flat, counts = self._new([
            raw[s:s + z].decode("utf-8", "replace")
            for s, z in zip(start.tolist(), size.tolist(), strict=True)])
        have = int(self.ends[self.n])
        while have + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.n + len(h) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[have:have + len(flat)] = flat
        self.ends[self.n + 1:self.n + 1 + len(h)] = have + np.cumsum(counts)
        self.table.add(h[order], np.arange(self.n, self.n + len(h)))
        self.n += len(h)

    def _find(self, h, buf, start, size) -> np.ndarray:
        at = self.table.find(h)
        miss = np.flatnonzero(at < 0)
        if not len(miss):
            return at
        new, first = np.unique(h[miss], return_index=True)
        if len(new) > self.table.room or self.ends[self.n] > POOL_MOST:
            if self.n:  # full: start again with the words of this slice
                self._empty()
                return self._find(h, buf, start, size)
            while len(new) > self.table.room:
                self.table.clear(self.table.bits + 1)
        first = miss[first]
        self._learn(new, buf, start[first], size[first])
        return self.table.find(h)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        buf = padded(data)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            # Plain ASCII is lower-cased here, so that "The" and "the" are one word.
            text = buf[a:b]
            if b > a and text.max() < 0x80 and b"<|" not in text.tobytes():
                buf[a:b] = LOWER[text]
        spans = runs(_GAP[buf[:-8]], offsets)
        start, size, parts = cut_tails(buf, spans.start, spans.size)
        rows = parts[spans.rows]
        at = self._find(hash_spans(buf, start, size), buf, start, size)
        counts = self.ends[at + 1] - self.ends[at]
        total = np.concatenate([[0], np.cumsum(counts)])
        # each text's ids, then its end id
        shift = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        out = np.full(total[-1] + len(rows) - 1, END_ID, np.uint32)
        take = np.arange(total[-1]) - np.repeat(total[:-1] - self.ends[at], counts)
        out[np.arange(total[-1]) + np.repeat(shift, counts)] = self.pool[take]
        return out, total[rows] + np.arange(len(rows))


_KEPT: dict[str, TokenIds] = {}


def tokenizer(path: str) -> TokenIds:
    """The worker's tokenizer of this file, with the words it has met."""
    if path not in _KEPT:
        _KEPT[path] = TokenIds(path)
    return _KEPT[path]
