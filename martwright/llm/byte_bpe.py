"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 13).

A byte string has one encoding, and so has each of its prefixes: the last token of a prefix is the
only token t for which the prefix before t ends in a token u that stays apart from t. ``Prefixes``
stores that last token for each prefix; walking back from the end gives the ids. Appended bytes
leave all stored entries as they are. After an edit in the middle entries are computed anew from the
edit on, until as many of them as the longest token has bytes equal the old ones: what follows
depends on nothing else. ``Document`` does the same for whole texts: it splits anew from a safe
place before the edit until a piece begins where an old one began.

Two tokens stay apart if no merge joins them on the way: going back in the order of merges, the
later of the two symbols at the border is undone, and each pair of border symbols that was adjacent
must not be a token that would have been merged earlier than the symbols around it.

Each match of the pattern is encoded by itself. A worker keeps the ids of the pieces it has met
(bounded; emptied when full). Decimal and decoded digests are gathered from the ids by table.

Nulls and edge cases: a null or empty text has no ids, and the digests of nothing; repeated rows and
null or repeated ids are rows of their own; ties can't occur, as the encoding is unique; a very long
text is split in stretches at single spaces between words, and one enormous word takes time in
proportion to its length; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow

NEVER = 1 << 40
PAIRS_KEPT = 1 << 21
PIECES_KEPT = 1 << 20
PIECE_LONGEST = 256  # longer pieces are not kept
STRETCH = 1 << 18  # characters of a text split at once


class Vocabulary:
    """Tokens by rank, their last merges, and which tokens stay apart."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.rank = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.token: list[bytes | None] = [None] * self.size
        for raw, r in ranks.items():
            self.token[r] = raw
        self.longest = max(map(len, ranks), default=1)
        # single bytes are there from the start, whatever their rank
        self.born = [-1 if raw is None or len(raw) == 1 else r for r, raw in enumerate(self.token)]
        self.pair: dict[tuple[int, int], int] = {}
        self.left, self.right = [-1] * self.size, [-1] * self.size
        self.known: dict[tuple[int, int], bool] = {}
        self.ending = ahocorasick.Automaton()
        for r, raw in enumerate(self.token):
            if raw is None:
                continue
            halves = [(a, b) for a, b in ((ranks.get(raw[:i]), ranks.get(raw[i:])) for i in range(1, len(raw)))
                      if a is not None and b is not None]
            if len(raw) > 1:
                # the encoding of the token's bytes by earlier merges alone must be two tokens
                for a, b in halves:
                    if self.born[a] < r and self.born[b] < r and self.made(a) and self.made(b) and self._apart(a, b, r):
                        self.left[r], self.right[r] = a, b
                        break
                else:
                    continue  # no text is ever encoded with it
            self.ending.add_word(raw.decode("latin-1"), (len(raw), r))
        for r, raw in enumerate(self.token):
            if raw is not None and self.made(r):
                for i in range(1, len(raw)):
                    a, b = ranks.get(raw[:i]), ranks.get(raw[i:])
                    if a is not None and b is not None:
                        self.pair[a, b] = r
        self.ending.make_automaton()

    def made(self, r: int) -> bool:
        return self.born[r] < 0 or self.left[r] >= 0

    def _merge(self, a: int, b: int) -> int:
        return self.rank.get(self.token[a] + self.token[b], NEVER)

    def _apart(self, u: int, t: int, below: int = NEVER) -> bool:
        """Do u and t stay apart under the merges of a rank less than ``below``?"""
        born, until_u, until_t = self.born, below, below
        while True:
            m = self._merge(u, t)
            # of equal ranks the left pair goes first
            if m < until_u and (m <= until_t if until_t < below else m < below):
                return False
            if born[t] >= born[u]:
                if born[t] < 0:
                    return True
                until_t, t = born[t], self.left[t]
            else:
                until_u, u = born[u], self.right[u]

    def apart(self, u: int, t: int) -> bool:
        at = (u, t)
        got = self.known.get(at)
        if got is None:
            if len(self.known) >= PAIRS_KEPT:
                self.known.clear()
            got = self.known[at] = self._apart(u, t)
        return got


class Prefixes:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, text: str, base: int, last: list[int], start: int) -> None:
        """Entries from ``start`` on; ``text`` is the data from ``base`` on, each byte a character."""
        known, vocabulary = self.vocabulary.known, self.vocabulary
        for end, (size, t) in vocabulary.ending.iter(text):
            at = base + end + 1
            if at < start or last[at] >= 0:
                continue
            before = at - size
            if before == 0:
                last[at] = t
            else:
                u = last[before]
                apart = known.get((u, t))
                if apart or (apart is None and vocabulary.apart(u, t)):
                    last[at] = t

    def append(self, more: bytes) -> None:
        start = len(self.data) + 1
        self.data += more
        self.last += [-1] * len(more)
        base = max(0, start - self.vocabulary.longest)
        self._fill(self.data[base:].decode("latin-1"), base, self.last, start)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in the place of data[start:end]; returns how many entries were computed."""
        old, tail = self.last, len(self.data) - end
        self.data = self.data[:start] + new + self.data[end:]
        longest, stop = self.vocabulary.longest, start + len(new)
        last = old[:start + 1] + [-1] * (len(new) + tail)
        done, shift = start + 1, end - stop
        base = max(0, start + 1 - longest)
        while done <= len(self.data):
            upto = min(len(self.data), max(stop, done) + 4 * longest)
            self._fill(self.data[base:upto].decode("latin-1"), base, last, done)
            done, base = upto + 1, max(0, upto + 1 - longest)
            same = upto - stop >= longest and all(
                last[i] == old[i + shift] for i in range(upto - longest + 1, upto + 1))
            if same:
                last[upto + 1:] = old[upto + 1 + shift:]
                break
        self.last = last
        return min(done, len(self.data) + 1) - start - 1

    def ids(self) -> list[int]:
        out, at, last = [], len(self.data), self.last
        token = self.vocabulary.token
        while at:
            t = last[at]
            if t < 0:
                raise ValueError(f"the vocabulary has no token for byte {self.data[at - 1]}")
            out.append(t)
            at -= len(token[t])
        return out[::-1]


class Splitter:
    """The pattern's matches in a text, by stretches of bounded length."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        # before a single space between two words no match goes on
        self.safe = regex.compile(r"(?<=\S)(?= \S)")

    def stretches(self, text: str):
        start = 0
        while len(text) - start > STRETCH:
            cut = self.safe.search(text, start + STRETCH)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:] if start else text


class Document:
    """A text with its pieces' encodings, kept exact under edits."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.pattern, self.text = vocabulary, regex.compile(pattern), text
        self.start: list[int] = []
        self.piece: list[Prefixes] = []
        for m in self.pattern.finditer(text):
            self.start.append(m.start())
            self.piece.append(Prefixes(vocabulary, m.group().encode()))

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in the place of text[start:end]; returns how many pieces were encoded anew.

        A match depends on at most two characters behind it, so earlier pieces stay.
        """
        old_start, old_piece = self.start, self.piece
        ends = old_start[1:] + [len(self.text)]
        keep = int(np.searchsorted(ends, start - 2, "right")) if old_start else 0
        self.text = self.text[:start] + new + self.text[end:]
        shift, stop = len(new) - (end - start), start + len(new)
        at = {s + shift: i for i, s in enumerate(old_start) if s >= end}
        starts, pieces, fresh = old_start[:keep], old_piece[:keep], 0
        begin = old_start[keep] if keep < len(old_start) else (ends[-1] if old_start else 0)
        for m in self.pattern.finditer(self.text, min(begin, len(self.text))):
            if m.start() >= stop and m.start() in at:
                i = at[m.start()]
                starts += [s + shift for s in old_start[i:]]
                pieces += old_piece[i:]
                break
            starts.append(m.start())
            pieces.append(self._encoded(m.group().encode(), old_piece, keep))
            fresh += 1
        self.start, self.piece = starts, pieces
        return fresh

    def _encoded(self, raw: bytes, old: list[Prefixes], at: int) -> Prefixes:
        """A piece that goes on from the first changed one takes over its entries."""
        if at < len(old) and old[at].data and raw.startswith(old[at].data):
            grown = Prefixes(self.vocabulary)
            grown.data, grown.last = old[at].data, list(old[at].last)
            grown.append(raw[len(grown.data):])
            return grown
        return Prefixes(self.vocabulary, raw)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return [t for p in self.piece for t in p.ids()]


def gather(table: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries of a ragged table one after another, where each begins)."""
    first = ends[ids]
    size = ends[ids + 1] - first
    at = np.concatenate([[0], np.cumsum(size)])
    return table[np.arange(at[-1]) + np.repeat(first - at[:-1], size)], at


def _ragged(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(entries), np.uint8),
            np.concatenate([[0], np.cumsum([len(x) for x in entries])]).astype(np.int64))


class Encoder:
    """Ids of whole texts, and what they decode to."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(path)
        self.splitter = Splitter(pattern)
        token = self.vocabulary.token
        self.bytes = _ragged([x or b"" for x in token])
        self.decimal = _ragged([b"%d " % i for i in range(len(token))])
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.pool = np.zeros(1 << 16, np.int64)
        self.ends = np.zeros(1 << 16, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Encode pieces and put their ids in the pool."""
        n = len(self.number)
        ids = [Prefixes(self.vocabulary, p.encode()).ids() for p in new]
        flat = np.array([i for x in ids for i in x], np.int64)
        have = int(self.ends[n])
        while have + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(new) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[have:have + len(flat)] = flat
        self.ends[n + 1:n + 1 + len(new)] = have + np.cumsum([len(x) for x in ids])
        self.number.update(zip(new, range(n, n + len(new)), strict=True))

    def _ids(self, text: str) -> np.ndarray:
        pieces = self.splitter.pattern.findall(text)
        number = self.number
        try:
            at = np.array([number[p] for p in pieces], np.int64)
        except KeyError:
            new = sorted(set(pieces).difference(number))
            long = [p for p in new if len(p) > PIECE_LONGEST]
            if long:
                own = {p: np.array(Prefixes(self.vocabulary, p.encode()).ids(), np.int64) for p in set(long)}
                out, run = [], []
                for p in pieces:
                    if p in own:
                        out += [self._short(run), own[p]]
                        run = []
                    else:
                        run.append(p)
                return np.concatenate([*out, self._short(run)])
            return self._short(pieces)
        return gather(self.pool, self.ends, at)[0]

    def _short(self, pieces: list[str]) -> np.ndarray:
        if len(self.number) > PIECES_KEPT:
            self._empty()
        self._learn(sorted(set(pieces).difference(self.number)))
        return gather(self.pool, self.ends, np.array([self.number[p] for p in pieces], np.int64))[0]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        parts = [self._ids(s) for s in self.splitter.stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(*self.bytes, ids)[0].tobytes()

    def digests(self, ids: np.ndarray) -> tuple[str, str]:
        """SHA-256 of the decimal ids, and of the decoded bytes."""
        one, two = hashlib.sha256(), hashlib.sha256()
        for a in range(0, len(ids), STRETCH):
            part = ids[a:a + STRETCH]
            text = gather(*self.decimal, part)[0]
            one.update(text if a + STRETCH < len(ids) else text[:-1])
            two.update(gather(*self.bytes, part)[0])
        return one.hexdigest(), two.hexdigest()


_KEPT: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of this file, with the pieces it has met."""
    if (path, pattern) not in _KEPT:
        _KEPT[path, pattern] = Encoder(path, pattern)
    return _KEPT[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every text."""

    def task(batches):
        kept = encoder(path, pattern)
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = kept.encode(text.as_py())
                yield pa.record_batch([pa.array([i], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))],
                                      names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                     "doc_id bigint, ids array<int>")


def run(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    def task(batches):
        kept = encoder(path, pattern)
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for text in batch.column("text"):
                ids = kept.encode(text.as_py())
                a, b = kept.digests(ids)
                n.append(len(ids))
                ids_sha.append(a)
                decoded_sha.append(b)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                                   pa.array(decoded_sha, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                     "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
