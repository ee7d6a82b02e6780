"""Token counts by rank-synchronous array merging (operator 10).

Texts are cut into pre-tokens: a word with the spaces before it. The cuts are such that no
piece of the vocabulary spans them, so that merges can't either. Distinct new pre-tokens of
a batch are held as one ragged numpy array of symbols; in each step every pre-token applies
its own lowest-rank pair, all of them at once, until none has a pair left (a pre-token of
``LONG`` characters and more has its pairs in a heap instead, as its steps would each walk all of
it). The symbols that survive are counted, and a worker keeps the counts of the words it has met (bounded).

The vocabulary is that of a sentencepiece BPE model without normalization, with the space as
U+2581, a space put before the text, and bytes for unknown characters.

Nulls and edge cases: a null or empty text has 0 bytes and 0 tokens; white space counts like
any other text; a text of one enormous word is one pre-token, in memory for itself, and takes n log n steps; rows with
null or repeated ids are counted each for itself; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, text_slices
from martwright.llm.token_ids import _TAIL, cut_tails
from martwright.llm.words import SpanTable, hash_spans, mix, padded, runs

LIMIT = 4096
SPACE = "▁"
_MARK = SPACE.encode()
NEVER = np.int64(1) << 40
LONG = 512  # characters from which a pre-token is merged by a heap of its pairs


class MergeTable:
    """Symbols, ranked pairs and safe cuts of a vocabulary."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i)
                                                 or model.is_unknown(i) or model.is_unused(i))]
        text = {i: model.id_to_piece(i) for i in normal}
        score = np.array([model.get_score(i) for i in normal])
        order = np.empty(len(normal), np.int64)
        # equal scores have equal ranks: then the leftmost pair goes first
        order[:] = np.unique(-score, return_inverse=True)[1]
        rank = dict(zip(normal, order.tolist(), strict=True))
        number = {p: i for i, p in text.items()}
        chars = sorted(set("".join(number)))
        for c in chars:  # characters of pieces that are no pieces themselves
            if c not in number:
                number[c] = size
                size += 1
        self.char = np.full(max(map(ord, chars), default=0) + 2, -1, np.int64)
        for c in chars:
            self.char[ord(c)] = number[c]
        # an unknown character counts as its bytes, a character without a piece too
        self.weight = np.ones(size, np.int64)
        for p, i in number.items():
            if i not in rank:
                self.weight[i] = len(p.encode())
        pairs = {}
        for p, i in number.items():
            for cut in range(1, len(p)):
                a, b = number.get(p[:cut]), number.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = (rank[i], i)
        self.size = size
        self.keys = np.array(sorted(pairs), np.int64)
        found = [pairs[k] for k in self.keys.tolist()]
        self.ranks = np.array([r for r, _ in found] + [NEVER], np.int64)
        self.merged = np.array([m for _, m in found] + [-1], np.int64)
        # after a merge into m, does a pair with m come that ranks before m itself?
        least = np.full(size, NEVER)
        left, right = self.keys // size, self.keys % size
        np.minimum.at(least, left, self.ranks[:-1])
        np.minimum.at(least, right, self.ranks[:-1])
        own = np.full(size, -1, np.int64)
        own[normal] = order
        self.safe = least >= own
        # punctuation that no piece has behind a letter or digit can be cut off
        self.tail = _TAIL.copy()
        for p in number:
            for a, b in zip(p, p[1:], strict=False):
                if ord(b) < 128 and a.isascii() and a.isalnum():
                    self.tail[ord(b)] = False
        if "\n" in chars or " " in chars:
            raise ValueError(f"{path}: pieces with new lines or spaces are not supported")
        self.at = {k: i for i, k in enumerate(self.keys.tolist())}

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair in the table, or of the entry that never merges."""
        key = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys))

    def count_long(self, text: str) -> int:
        """Symbols left of one long pre-token, in n log n steps: its pairs wait in a heap by rank and place."""
        code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        first = self.char[np.minimum(code, len(self.char) - 1)]
        bytes_ = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        single = np.where(first >= 0, self.weight[first], bytes_).tolist()
        pair = self._pair(first[:-1], first[1:])
        some = np.flatnonzero(pair < len(self.keys))
        symbol, size = first.tolist(), self.size
        heap = list(zip(self.ranks[pair[some]].tolist(), some.tolist(), self.keys[pair[some]].tolist(), strict=True))
        heapq.heapify(heap)
        ranks, merged, at = self.ranks.tolist(), self.merged.tolist(), self.at
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while heap:
            _, i, key = heapq.heappop(heap)
            j = after[i]
            # the pair may be gone: one of its symbols was merged since
            if not alive[i] or j >= n or symbol[i] * size + symbol[j] != key or symbol[i] < 0 or symbol[j] < 0:
                continue
            symbol[i] = merged[at[key]]
            alive[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and symbol[a] >= 0 and symbol[b] >= 0:
                    key = symbol[a] * size + symbol[b]
                    found = at.get(key)
                    if found is not None:
                        heapq.heappush(heap, (ranks[found], a, key))
        weight = self.weight.tolist()
        # a symbol that was never merged weighs what its character does
        return sum((weight[x] if x >= 0 else single[i]) for i, x in enumerate(symbol) if alive[i])

    def count(self, texts: list[str]) -> np.ndarray:
        """Symbols left of each pre-token (spaces as U+2581)."""
        long = [i for i, t in enumerate(texts) if len(t) >= LONG]
        out = self._count(["" if len(t) >= LONG else t for t in texts])
        for i in long:
            out[i] = self.count_long(texts[i])
        return out

    def _count(self, texts: list[str]) -> np.ndarray:
        """All pre-tokens at once, a step for the lowest rank of each."""
        code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        symbol = self.char[np.minimum(code, len(self.char) - 1)]
        bytes_ = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
        weight = np.where(symbol >= 0, self.weight[symbol], bytes_)
        out = np.zeros(len(texts), np.int64)
        pair = self._pairs_of(symbol, owner)
        while len(symbol):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbol)))
            each = np.repeat(low, size)
            done = each == NEVER
            if done.any():
                out += np.bincount(owner[done], weight[done], len(texts)).astype(np.int64)
                symbol, owner, weight, pair = (x[~done] for x in (symbol, owner, weight, pair))
                continue
            here = np.flatnonzero(rank == each)
            # of touching pairs the left one merges first
            new = np.diff(here, prepend=-2) > 1
            run = np.maximum.accumulate(np.where(new, here, 0))
            take = (here - run) % 2 == 0
            # where a merge could bring an earlier rank, only the leftmost one goes
            to = self.merged[pair[here]]
            leftmost = np.diff(owner[here], prepend=-1) != 0
            all_safe = np.ones(len(texts), bool)
            all_safe[owner[here[~self.safe[to]]]] = False
            take &= all_safe[owner[here]] | leftmost
            at = here[take]
            symbol[at] = to[take]
            weight[at] = self.weight[symbol[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            # pairs at and before a merged symbol are new
            place = np.cumsum(keep) - 1
            at = place[at]
            symbol, owner, weight, pair = (x[keep] for x in (symbol, owner, weight, pair))
            fresh = np.unique(np.concatenate([at, at[at > 0] - 1]))
            pair[fresh] = self._pairs_at(symbol, owner, fresh)
        return out

    def _pairs_of(self, symbol, owner) -> np.ndarray:
        return self._pairs_at(symbol, owner, np.arange(len(symbol)))

    def _pairs_at(self, symbol, owner, at) -> np.ndarray:
        nxt = np.minimum(at + 1, len(symbol) - 1)
        good = (at + 1 < len(symbol)) & (owner[nxt] == owner[at])
        return np.where(good, self._pair(symbol[at], symbol[nxt]), len(self.keys))


class TokenCounts:
    """``count(bytes, offsets)`` gives the tokens of each text."""

    def __init__(self, path: str, bits: int = 21):
        self.merges = MergeTable(path)
        self.table = SpanTable(bits)
        self.solid = np.ones(256, bool)
        self.solid[[0x20, 0x0A]] = False

    def _spaces(self, n: np.ndarray) -> np.ndarray:
        """Tokens of so many spaces alone."""
        size, at = np.unique(n, return_inverse=True)
        return self.merges.count([SPACE * k for k in size.tolist()])[at]

    def _learn(self, h, buf, start, size, spaces) -> None:
        raw = buf.tobytes()
        self.table.add(h, self.merges.count([
            SPACE * k + raw[s:s + z].decode("utf-8", "replace") for s, z, k in
            zip(start.tolist(), size.tolist(), spaces.tolist(), strict=True)]))

    def _find(self, h, buf, start, size, spaces) -> np.ndarray:
        got = self.table.find(h)
        miss = np.flatnonzero(got < 0)
        if not len(miss):
            return got
        new, first = np.unique(h[miss], return_index=True)
        if len(new) > self.table.room:
            if self.table.count:  # full: start again with the words of this slice
                self.table.clear(self.table.bits)
                return self._find(h, buf, start, size, spaces)
            while len(new) > self.table.room:
                self.table.clear(self.table.bits + 1)
        first = miss[first]
        self._learn(new, buf, start[first], size[first], spaces[first])
        return self.table.find(h)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if (data == _MARK[0]).any() and _MARK in (raw := data.tobytes()):
            # the character that stands for a space counts as one
            texts = [raw[a:b].replace(_MARK, b" ") for a, b in
                     zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        buf = padded(data)
        spans = runs(self.solid[buf[:-8]], offsets)
        n_docs = len(offsets) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(spans.rows))
        # spaces right before a word; the text's first character has one more before it
        space = buf[:-8] == 0x20
        edge = np.flatnonzero(~space)
        back = np.concatenate([[-1], edge])  # last byte that is no space before a place
        before = spans.start - 1 - back[np.searchsorted(edge, spans.start)]
        head = spans.start - offsets[doc]
        front = before >= head
        before = np.where(front, head + 1, before)
        start, size, parts = cut_tails(buf, spans.start, spans.size, self.merges.tail)
        spaces = np.zeros(len(start), np.int64)
        spaces[parts[:-1]] = before
        h = hash_spans(buf, start, size)
        odd = spaces != 1
        h[odd] = mix(h[odd] ^ (spaces[odd].astype(np.uint64) + np.uint64(1))
                     * np.uint64(0x9E3779B97F4A7C15))
        got = self._find(h, buf, start, size, spaces)
        out = np.add.reduceat(np.append(got, 0), np.minimum(parts[spans.rows[:-1]], len(got)))
        out[np.diff(spans.rows) == 0] = 0
        # new lines are a byte each; runs of spaces with no word behind them stand alone
        line = buf[:-8] == 0x0A
        cum = np.concatenate([[0], np.cumsum(line)])
        out = out + cum[offsets[1:]] - cum[offsets[:-1]]
        blank = runs(space, offsets)
        end = blank.start + blank.size
        owner = np.repeat(np.arange(n_docs), np.diff(blank.rows))
        final = end == offsets[owner + 1]
        alone = final | (buf[end] == 0x0A)
        tokens = self._spaces((blank.size + (blank.start == offsets[owner]))[alone])
        out = out + np.bincount(owner[alone], tokens, n_docs).astype(np.int64)
        # a text that begins with a new line has the space before it as a pre-token
        size = np.diff(offsets)
        begins = np.zeros(n_docs, bool)
        begins[size > 0] = buf[offsets[:-1][size > 0]] == 0x0A
        return out + np.where(begins, self._spaces(np.ones(1, np.int64))[0], 0)


_KEPT: dict[str, TokenCounts] = {}


def counter(path: str) -> TokenCounts:
    if path not in _KEPT:
        _KEPT[path] = TokenCounts(path)
    return _KEPT[path]


def run(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    def task(batches):
        counts = counter(model_path)
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                n = counts.count(data, offsets)
                yield pa.record_batch([
                    batch.column("doc_id").slice(row, end - row), pa.array(np.diff(offsets)),
                    pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                     "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
