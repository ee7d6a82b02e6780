"""Repair of conversations' turn structure by a persistent audit DP (operator 11).

A conversation's rows may be kept, given the role user or assistant, or deleted, and empty turns
may be inserted, such that its roles' initials read ``(s?(ua)+)?``. The cheapest list of edits
(its audit, one letter an edit) is found by a DP over the rows with four states: nothing yet, s, a
user's turn last, an assistant's turn last. The best audit up to each row and state is a node linked
to its prefix, so that audits share their prefixes; a node has the rolling hash of its audit and its
2^k-th ancestors. Of equally cheap audits the ASCII-least is taken: the longest common prefix is
searched by comparing ancestors' hashes, from large steps to small ones, and equal hashes of
different nodes are compared letter by letter. Neither of two equally cheap audits at the same row
and state is a prefix of the other (it would have more inserts), so their order is that of all that
may follow. Inserts stand right before a kept row, as "DI" precedes "ID".

No step needs a whole conversation. Rows are sorted by ranges, and each run of a conversation within
``2 ** SEGMENT_BITS`` sorted rows is a piece of its own. A piece at the edge of its segment gives its cheapest
audit for every state before and after it, with the audits' rank within the piece; the pieces of a
conversation are then chosen by the same DP, with ranks as letters. The digest of the repaired text
is one stream by definition: its rows pass one task in order, none is held.

Nulls and edge cases: null roles and texts, and null ids and turns in the damage's hash, are one
space; a null conv_id is a conversation; null turns come first; rows of the same turn are ordered by
role, then by a digest of conversation and text; repeated rows are rows of their own (adjacent, so
all but the first are duplicates); an empty role has no initial, so it can't be kept; a long text
is never cut; gaps beyond a long are its largest value; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, stored

SEGMENT_BITS = 13  # sorted rows of a segment: 2 ** 13
BLANKS = " \t\n\x0b\f\r"
STOPS = "[.!?]"
# --- fixed values: prices of the edits ---
REROLE = INSERT = TRUNCATED = 3
DELETE = 4
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# what must follow the last row: nothing, or inserted turns
ENDING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
OK, BLANK, DUPLICATE, CUT = range(4)
LARGEST = (1 << 63) - 1
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


# ----------------------------------------------------------------- audits


class Node:
    """An audit: its last letter and, by 2^k letters back, its prefixes."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter, parent: Node | None = None):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 7, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * _BASE + hash(letter) + 1) % _PRIME
        up, at = [], parent
        while True:
            up.append(at)
            if len(at.up) < len(up):
                break
            at = at.up[len(up) - 1]
        self.up = up

    def back(self, steps: int) -> Node:
        at = self
        while steps:
            k = steps.bit_length() - 1
            at, steps = at.up[k], steps - (1 << k)
        return at

    def letters(self) -> list:
        out, at = [], self
        while at.depth:
            out.append(at.letter)
            at = at.up[0]
        return out[::-1]


def _same(a: Node, b: Node) -> bool:
    """Are two audits of one length equal? Equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash:
        return False
    while a is not b and a.depth:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Is audit ``a`` less than ``b``? The search finds their longest common prefix."""
    size = min(a.depth, b.depth)
    x, y = a.back(a.depth - size), b.back(b.depth - size)
    if _same(x, y):
        return a.depth < b.depth
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and not _same(x.up[k], y.up[k]):
            x, y = x.up[k], y.up[k]
    return x.letter < y.letter


class _Best:
    """The cheapest audit so far of each state; the ASCII-least of equally cheap ones."""

    def __init__(self):
        self.cost: list[int | None] = [None] * 4
        self.node: list[Node | None] = [None] * 4

    def offer(self, state: int, cost: int, node: Node) -> None:
        had = self.cost[state]
        if had is None or cost < had or (cost == had and before(node, self.node[state])):
            self.cost[state], self.node[state] = cost, node


def _row(best: _Best, initial: str, fault: int, copies: int) -> _Best:
    """One more row; its further copies are duplicates, or blank, and deleted."""
    new = _Best()
    again = copies - 1
    if fault in (BLANK, DUPLICATE):
        again += 1
    more = TRUNCATED if fault == CUT else 0
    inserted: dict[int, Node] = {}

    def letter(x: int, edit: str, insert: bool) -> Node:
        at = best.node[x]
        if insert:
            if x not in inserted:
                inserted[x] = Node("I", at)
            at = inserted[x]
        return Node(edit, at)

    for x in range(4):
        cost = best.cost[x]
        if cost is None:
            continue
        if fault in (BLANK, DUPLICATE):
            new.offer(x, cost, best.node[x])
            continue
        new.offer(x, cost + DELETE, Node("D", best.node[x]))
        cost += more
        if initial == "s" and x == NOTHING:
            new.offer(SYSTEM, cost, letter(x, "K", False))
        # a user's turn follows all but a user's, an assistant's turn a user's alone
        for state, name, insert in ((USER, "u", x == USER), (ASSISTANT, "a", x != USER)):
            extra = INSERT if insert else 0
            if initial == name:
                new.offer(state, cost + extra, letter(x, "K", insert))
            new.offer(state, cost + extra + REROLE, letter(x, "R", insert))
    if again:
        for x in range(4):
            if new.cost[x] is not None:
                new.cost[x] += DELETE * again
                new.node[x] = Node(_Deleted(again), new.node[x])
    return new


class _Deleted(str):
    """So many deletions of one row's copies, as one letter."""

    times: int

    def __new__(cls, times: int):
        made = super().__new__(cls, "D")
        made.times = times
        return made


def _text(letters: Iterable[str]) -> str:
    return "".join("D" * x.times if isinstance(x, _Deleted) else x for x in letters)


def audits(rows: list[tuple[str, int, int]], start: int = NOTHING) -> dict[int, tuple[int, str]]:
    """state after the rows (initial, fault, copies) -> (cost, audit), from a state before them."""
    best = _Best()
    best.cost[start], best.node[start] = 0, Node("")
    for initial, fault, copies in rows:
        best = _row(best, initial, fault, copies)
    return {x: (best.cost[x], _text(best.node[x].letters())) for x in range(4) if best.cost[x] is not None}


def choose(pieces: list[dict[tuple[int, int], tuple[int, int]]]) -> tuple[int, list[tuple[int, int]]]:
    """(cost, (state before, state after) of each piece) of the cheapest, least audit.

    A piece gives (cost, rank of its audit) by the states before and after it.
    """
    best = _Best()
    best.cost[NOTHING], best.node[NOTHING] = 0, Node(0)
    for piece in pieces:
        new = _Best()
        for (s, t), (cost, rank) in sorted(piece.items()):
            if best.cost[s] is not None:
                new.offer(t, best.cost[s] + cost, Node(_Way(rank, s, t), best.node[s]))
        best = new
    last = _Best()
    for x, ending in ENDING.items():
        if best.cost[x] is not None:
            last.offer(0, best.cost[x] + INSERT * len(ending), best.node[x])
    return last.cost[0], [(w.s, w.t) for w in last.node[0].letters()]


class _Way(int):
    """The rank of a piece's audit, with the states before and after."""

    def __new__(cls, rank: int, s: int, t: int):
        made = super().__new__(cls, rank)
        made.s, made.t = s, t
        return made


# ----------------------------------------------------------------- rows


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the rows after the contract's damage."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.col("kind")
    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", STOPS, ""))
            .otherwise(F.col("text")))
    times = F.when(kind == 3, 2).otherwise(1)
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), times.cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies, in the conversations' order by ``pos``, stored."""
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    key = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                          F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    place = ["conv_id", "turn", "role", "key"]
    lines = same.withColumn("key", key).repartitionByRange(*place).sortWithinPartitions(*place)
    # partition and row number: ascending over the sorted ranges
    return stored(lines.withColumn("pos", F.monotonically_increasing_id()), "turns")


def faults(lines: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, initial, fault, copies): the first fault of each row's first copy."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    plain = (F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT))
    rows = lines.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"),
                        plain.alias("plain"), "copies", "key")
    first = rows.groupBy("key").agg(F.min("pos").alias("first"))
    fault = (F.when(F.col("plain") == BLANK, BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
             .otherwise(F.col("plain")))
    return rows.join(first, "key").select("conv_id", "pos", "turn", "initial", fault.alias("fault"), "copies")


# --------------------------------------------------------------- segments

_STATS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = ("conv_id bigint, segment bigint, closed boolean, before int, after int, cost bigint, rank int, "
          "audit string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
          "first string, last string, least bigint, most bigint")


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _statistics(rows: list[tuple]) -> dict:
    """Counts of a piece, and what its neighbours need."""
    out = dict.fromkeys(_STATS, 0)
    turns = [r[1] for r in rows if r[1] is not None]
    out["turns"] = len(set(turns))
    was = None
    for _, _, initial, fault, copies in rows:
        again = copies - 1
        if fault == BLANK:
            out["blank"] += copies
        elif fault == DUPLICATE:
            out["duplicate"] += copies
        else:
            out["duplicate"] += again
            out["truncated"] += fault == CUT
        out["illegal"] += again + (was is not None and not _legal(was, initial))
        was = initial
    return out | {"first": rows[0][2], "last": was, "least": min(turns, default=None), "most": max(turns, default=None)}


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 2000, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) >= most or size >= letters:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
          "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _schema(spec: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in spec.split(", "))])


def pieces(rows: DataFrame) -> DataFrame:
    """The pieces of all conversations: one closed row, or one by states before and after."""

    def made(batches) -> Iterator[dict]:
        # rows: conv_id, turn, initial, fault, copies, segment
        for segment, members in groupby(_rows_of(batches), key=lambda r: r[5]):
            runs = groupby(members, key=lambda r: r[0])
            run = next(runs, None)
            edge = True
            while run is not None:
                conv, held = run[0], [r[:5] for r in run[1]]
                run = next(runs, None)
                base = {"conv_id": conv, "segment": segment} | _statistics(held)
                plain = [r[2:5] for r in held]
                closed = not edge and run is not None
                found = {(s, t): x for s in ((NOTHING,) if closed else range(4))
                         for t, x in audits(plain, s).items()}
                rank = {a: i for i, a in enumerate(sorted({a for _, a in found.values()}))}
                ways = {at: (cost, rank[a]) for at, (cost, a) in found.items()}
                if closed:
                    cost, (at,) = choose([ways])
                    yield base | {"closed": True, "before": at[0], "after": at[1], "cost": cost, "rank": 0,
                                  "audit": found[at][1] + ENDING[at[1]]}
                else:
                    for at, (cost, nth) in ways.items():
                        yield base | {"closed": False, "before": at[0], "after": at[1], "cost": cost,
                                      "rank": nth, "audit": found[at][1]}
                edge = False

    def task(batches):
        yield from _batches(made(batches), _schema(_PIECE))

    segment = F.shiftright("pos", SEGMENT_BITS)
    dealt = (rows.withColumn("segment", segment).repartition("segment").sortWithinPartitions("pos")
             .select("conv_id", "turn", "initial", "fault", "copies", "segment"))
    return map_arrow(dealt, task, _PIECE)


_TOTAL = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, segments array<bigint>, befores array<int>, afters array<int>")


def _gaps(least, most, turns: int) -> int:
    return 0 if least is None else min(most - least + 1 - turns, LARGEST)


def joined(open_pieces: DataFrame) -> DataFrame:
    """Totals of each conversation in open pieces, and the states between its pieces."""

    def totals(batches) -> Iterator[dict]:
        rows = (dict(zip(columns, r, strict=True)) for r in _rows_of(batches))
        for conv, members in groupby(rows, key=lambda r: r["conv_id"]):
            ways, stats, at = [], dict.fromkeys(_STATS, 0), []
            least = most = was = None
            for segment, group in groupby(members, key=lambda r: r["segment"]):
                group = list(group)
                ways.append({(r["before"], r["after"]): (r["cost"], r["rank"]) for r in group})
                at.append(segment)
                r = group[0]
                for c in _STATS:
                    stats[c] += r[c]
                if was is not None:
                    stats["illegal"] += not _legal(was, r["first"])
                was = r["last"]
                if r["least"] is not None:
                    stats["turns"] -= most == r["least"]
                    least, most = (r["least"] if least is None else least), r["most"]
            cost, states = choose(ways)
            yield {"conv_id": conv, "gaps": _gaps(least, most, stats.pop("turns")), "cost": cost, "segments": at,
                   "befores": [s for s, _ in states], "afters": [t for _, t in states]} | stats

    schema = _schema(_TOTAL)
    columns = [c for c in open_pieces.columns if c not in ("audit", "closed")]

    def task(batches):
        yield from _batches(totals(batches), schema)

    return map_arrow(open_pieces.select(*columns).repartition("conv_id")
                     .sortWithinPartitions("conv_id", "segment"), task, _TOTAL)


def audited(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals by conversation, audit of each of its pieces) from the pieces."""
    closed, opened = found.where("closed"), found.where("not closed")
    sums = stored(joined(opened), "turn-totals")
    ways = sums.select("conv_id", F.inline(F.arrays_zip("segments", "befores", "afters"))).select(
        F.col("conv_id").alias("c"), F.col("segments").alias("g"), F.col("befores").alias("s"),
        F.col("afters").alias("t"), (F.col("segments") == F.max("segments").over(
            Window.partitionBy("conv_id"))).alias("final"))
    ending = F.coalesce(F.element_at(F.create_map(*[
        F.lit(x) for state in ENDING.items() for x in state]), F.col("after")), F.lit(""))
    chosen = opened.join(ways, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("g"))
                         & (F.col("before") == F.col("s")) & (F.col("after") == F.col("t")))
    parts = chosen.select("conv_id", "segment", "before", F.concat("audit", F.when(F.col("final"), ending)
                                                                  .otherwise(F.lit(""))).alias("audit"))
    # F.least skips nulls: without a turn there is no gap
    gaps = F.when(F.col("least").isNull(), 0).otherwise(
        F.least(F.col("most").cast("decimal(38,0)") - F.col("least") + 1 - F.col("turns"),
                F.lit(LARGEST).cast("decimal(38,0)")).cast("long"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole = closed.select("conv_id", gaps.alias("gaps"), *counts)
    return (whole.unionByName(sums.select("conv_id", "gaps", *counts)),
            closed.select("conv_id", "segment", "before", "audit").unionByName(parts))


def repaired(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """(conv_id, pos, sub, role, text): the rows after the edits, ordered by pos and sub."""
    spec = "conv_id bigint, pos bigint, sub int, role string, text string"
    none = F.lit(None)
    segment = F.shiftright("pos", SEGMENT_BITS).alias("segment")
    both = parts.select("segment", F.lit(-1).cast("long").alias("pos"), "conv_id", "before", "audit",
                        none.cast("string").alias("role"), none.cast("string").alias("text"),
                        none.cast("long").alias("copies")).unionByName(
        lines.select(segment, "pos", "conv_id", none.cast("int").alias("before"),
                     none.cast("string").alias("audit"), "role", "text", "copies"))

    def made(batches) -> Iterator[dict]:
        for _, members in groupby(_rows_of(batches), key=lambda r: r[0]):
            plans: dict = {}

            def following(run, plans=plans):
                conv, rows = run
                audit, state = plans.pop(conv)
                at, pos = 0, -1

                def turn(pos, sub, role, text):
                    return {"conv_id": conv, "pos": pos, "sub": sub, "role": role, "text": text}

                def inserted(pos, sub):
                    nonlocal at, state
                    while at < len(audit) and audit[at] == "I":
                        state = ASSISTANT if state == USER else USER
                        yield turn(pos, sub, "user" if state == USER else "assistant", "")
                        at, sub = at + 1, sub + 1

                for r in rows:
                    pos = r[1]
                    yield from inserted(pos, -2)
                    edit, role = audit[at], r[5]
                    at += r[7]  # the row's edit, and the deletions of its copies
                    if edit == "D":
                        continue
                    state = (SYSTEM if edit == "K" and state == NOTHING and role[:1] == "s"
                             else ASSISTANT if state == USER else USER)
                    if edit == "R":
                        role = "user" if state == USER else "assistant"
                    yield turn(pos, 0, role, r[6])
                yield from inserted(pos, 1)

            kept = []
            members = iter(members)
            for r in members:
                if r[1] >= 0:
                    kept = [r]
                    break
                plans[r[2]] = (r[4], r[3])
            for run in groupby(chain(kept, members), key=lambda r: r[2]):
                yield from following(run)

    def task(batches):
        yield from _batches(made(batches), _schema(spec))

    dealt = (both.repartition("segment").sortWithinPartitions("segment", "pos")
             .select("segment", "pos", "conv_id", "before", "audit", "role", "text", "copies"))
    return map_arrow(dealt, task, spec)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 over the lines of each conversation, row by row."""
    spec = "conv_id bigint, repaired_sha256 string"

    def made(batches) -> Iterator[dict]:
        for conv, members in groupby(_rows_of(batches), key=lambda r: r[0]):
            h, join = hashlib.sha256(), b""
            for _, role, text in members:
                h.update(join + role.encode() + b":" + text.encode())
                join = b"\n"
            yield {"conv_id": conv, "repaired_sha256": h.hexdigest()}

    def task(batches):
        yield from _batches(made(batches), _schema(spec))

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "sub")
    return map_arrow(dealt.select("conv_id", "role", "text"), task, spec)


def run(conversations: DataFrame) -> DataFrame:
    lines = ordered(damaged(conversations))
    found = stored(pieces(faults(lines)), "turn-pieces")
    totals, parts = audited(found)
    parts = stored(parts, "turn-audits")
    hashes = digests(repaired(lines, parts))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("segment", "audit"))).alias("x"))
    whole = whole.select("conv_id", F.concat_ws("", F.col("x.audit")).alias("audit"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for i, side in enumerate((totals, whole, hashes)):
        key = f"__c{i}"
        out = out.join(side.withColumnRenamed("conv_id", key), F.col("conv_id").eqNullSafe(F.col(key)), "left").drop(key)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
