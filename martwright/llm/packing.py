"""Best-fit packing of documents into sequences of a fixed number of tokens (operator 1).

Documents become pieces of at most ``capacity`` tokens; a piece of exactly that length is
a sequence of its own. The other pieces are dealt at random over shards of bounded size.
In each shard they are first placed by best fit in order of falling length; then a local
search works on all underfull bins: it moves a piece, or exchanges one for one or two for
one, as long as that raises the sum of squared fills, which drains the emptiest bins until
some hold nothing. Full bins are closed; the others send their pieces on to a next round over
fewer shards, so that what is left over in many shards meets again. The rounds end when one
shard holds the rest, or when a round leaves more than half of its pieces in underfull bins
(a new deal of them would do no better); so the pieces at least halve from round to round.
Of equal lengths the smaller doc_id, piece and row goes first.

Nulls and edge cases: a null or empty text is a document of the end id alone; repeated
rows and ids are packed each for itself (``row`` tells them apart); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, ship, stored, text_slices
from martwright.llm.token_ids import tokenizer

CAPACITY = 4096
SHARD_PIECES = 8192
ROUND_IDS = 64  # sequence ids of a round; as pieces halve, rounds are fewer than the bits of their number
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents, with the checksum of their ids."""

    def task(batches):
        encoder = tokenizer(tokenizer_path)
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                ids, cuts = encoder.encode(data, offsets)
                n = np.diff(cuts)
                per = -(-n // capacity)
                first = np.concatenate([[0], np.cumsum(per)])
                doc = np.repeat(np.arange(end - row), per)
                piece = np.arange(first[-1]) - np.repeat(first[:-1], per)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                at = cuts[doc] + start
                yield pa.record_batch([
                    batch.column("doc_id").slice(row, end - row).take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in
                              zip(at.tolist(), (at + length).tolist(), strict=True)], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit by falling length; returns bins of item numbers."""
    room: list[int] = []  # distinct rooms, ascending
    by_room: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        k = bisect.bisect_left(room, n)
        if k == len(room):
            bins.append([i])
            b, left = len(bins) - 1, capacity - n
        else:
            r = room[k]
            b = by_room[r].pop()
            if not by_room[r]:
                del by_room[r]
                room.pop(k)
            bins[b].append(i)
            left = r - n
        if left:
            if left not in by_room:
                by_room[left] = []
                bisect.insort(room, left)
            by_room[left].append(b)
    return bins


class _Offers:
    """What each open bin could give back: nothing, a piece, or two, one way for each sum.

    Flat arrays over all bins; a bin that changes has its old entries voided and new ones added.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.void = bins, lengths, 2 * capacity
        self.of = [self._ways(b) for b in bins]
        self._lay()

    def _ways(self, members: list[int]) -> tuple[np.ndarray, ...]:
        if not members:
            return (np.zeros(0, np.int64),) * 3
        items = np.array(members)
        n = np.array([self.lengths[i] for i in members])
        a, b = np.triu_indices(len(items), 1)
        sums = np.concatenate([[0], n, n[a] + n[b]])
        one = np.concatenate([[-1], items, items[a]])
        two = np.concatenate([[-1], np.full(len(items), -1), items[b]])
        sums, first = np.unique(sums, return_index=True)
        return sums, one[first], two[first]

    def _lay(self) -> None:
        sizes = np.array([len(w[0]) for w in self.of])
        room = 2 * int(sizes.sum()) + 1024
        self.sums, self.bin, self.one, self.two = (np.zeros(room, np.int64) for _ in range(4))
        ends = np.cumsum(sizes)
        self.first, self.used = (ends - sizes).tolist(), int(ends[-1])
        for out, k in ((self.sums, 0), (self.one, 1), (self.two, 2)):
            out[:self.used] = np.concatenate([w[k] for w in self.of])
        self.bin[:self.used] = np.repeat(np.arange(len(sizes)), sizes)

    def renew(self, b: int) -> None:
        at, n = self.first[b], len(self.of[b][0])
        self.sums[at:at + n] = self.void
        self.of[b] = self._ways(self.bins[b])
        at, n = self.used, len(self.of[b][0])
        if at + n > len(self.sums):
            self._lay()
            return
        for out, values in zip((self.sums, self.one, self.two), self.of[b], strict=True):
            out[at:at + n] = values
        self.bin[at:at + n] = b
        self.first[b], self.used = at, at + n

    def best(self, giver: int, fill: np.ndarray, capacity: int):
        """The exchange that most raises the squared fills, or None: (out, taker, back).

        Moving d tokens to a bin that is fuller by ``lead`` raises them by 2 d (lead + d), as
        long as the taker can hold them.
        """
        sums, bin_ = self.sums[:self.used], self.bin[:self.used]
        held = fill[bin_]
        gap, lead = capacity - held, held - fill[giver]
        gap[bin_ == giver] = 0
        best, found = 0, None
        for n, i in {self.lengths[i]: i for i in self.bins[giver]}.items():
            d = n - sums
            gain = np.where((d > 0) & (d <= gap), d * (lead + d), 0)
            k = int(gain.argmax())
            if gain[k] > best:
                best = gain[k]
                found = i, int(bin_[k]), [int(x) for x in (self.one[k], self.two[k]) if x >= 0]
        return found


def local_search(bins: list[list[int]], lengths: list[int], capacity: int,
                 passes: int | None = None) -> list[list[int]]:
    """Drain the emptiest underfull bins into the others by moves and exchanges, until none
    is left that raises the squared fills (or for so many ``passes``)."""
    bins = [list(b) for b in bins]
    if len(bins) < 2:
        return [b for b in bins if b]
    fill = np.array([sum(lengths[i] for i in b) for b in bins])
    offers = _Offers(bins, lengths, capacity)
    changed = True
    while changed and passes != 0:
        changed = False
        passes = None if passes is None else passes - 1
        for giver in np.argsort(fill, kind="stable").tolist():
            while 0 < fill[giver] < capacity:
                move = offers.best(giver, fill, capacity)
                if move is None:
                    break
                out, taker, back = move
                bins[giver].remove(out)
                for i in back:
                    bins[taker].remove(i)
                bins[giver].extend(back)
                bins[taker].append(out)
                d = lengths[out] - sum(lengths[i] for i in back)
                fill[giver] -= d
                fill[taker] += d
                offers.renew(giver)
                offers.renew(taker)
                changed = True
    return [b for b in bins if b]


def pack_shard(lengths: list[int], capacity: int = CAPACITY,
               passes: int | None = None) -> list[list[int]]:
    """Best fit, then the local search over all underfull bins."""
    bins = best_fit(lengths, capacity)
    fills = [sum(lengths[i] for i in b) for b in bins]
    some = sorted((b for b in range(len(bins)) if fills[b] < capacity), key=lambda b: fills[b])
    full = [bins[b] for b in range(len(bins)) if fills[b] == capacity]
    return full + local_search([bins[b] for b in some], lengths, capacity, passes)


def _pack_round(items: DataFrame, shards: int, round_: int, capacity: int) -> DataFrame:
    """Adds sequence (in its shard), offset and fill, over shards of a random deal."""
    shard = F.pmod(F.xxhash64("doc_id", "piece", "row", F.lit(round_)), F.lit(shards))

    def task(key, group):
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending"), ("row", "ascending")])
        lengths = group.column("length").to_pylist()
        bin_, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for b, members in enumerate(pack_shard(lengths, capacity)):
            at = 0
            for i in members:
                bin_[i], offset[i] = b, at
                at += lengths[i]
            fill[members] = at
        for name, value in (("bin", bin_), ("offset", offset), ("fill", fill)):
            group = group.append_column(name, pa.array(value))
        return group

    return (items.withColumn("shard", shard).groupBy("shard")
            .applyInArrow(task, f"{PIECES}, row bigint, shard bigint, bin bigint, offset bigint, fill bigint"))


def pack(items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """A sequence and an offset for each piece."""
    ship(items.sparkSession)
    items = stored(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    out = items.where(F.col("length") == capacity).withColumns({
        "sequence_id": F.col("row") * ROUND_IDS, "offset": F.lit(0).cast("long")})
    left, round_ = items.where(F.col("length") < capacity), 0
    n = left.count()
    while n:
        round_ += 1
        packed = stored(_pack_round(left, -(-n // shard_pieces), round_, capacity), f"packed-{round_}")
        left = packed.where(F.col("fill") < capacity).select(*items.columns)
        rest = left.count() if n > shard_pieces else 0
        if 2 * rest > n:
            rest = 0
        closed = F.col("fill") == capacity if rest else F.lit(True)
        sequence = (F.col("shard") * (1 << 32) + F.col("bin")) * ROUND_IDS + round_
        out = out.unionByName(packed.where(closed).select(*items.columns, sequence.alias("sequence_id"), "offset"))
        n = rest
    return out


def run(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
        capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer_path, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
