"""Hard-negative mining by cover trees over norm-augmented candidates (operator 12).

A candidate x gets one more coordinate, sqrt(M^2 - |x|^2) with the largest norm M, an anchor q a
zero: then all candidates have the same norm, and a ball with centre c and covering radius r bounds
the inner products of all it covers by q.c - |q| r and q.c + |q| r. Candidates are dealt over shards
of bounded size by their nearest pivot, large cells by a hash too. A task builds its shard's cover
tree level by level (each level's radius is a fixed part of the one above; a child's centre is the
point farthest from the others' centres), and the anchors are streamed past it in batches. Descent
goes best first by the upper bound and skips a node if its bounds lie outside of all windows of the
anchor, or below what a window has found already; leaves are verified with exact integer products.

Two passes: first each anchor's positives (a window without bounds over its own label), then for each
positive the window of negative scores. Before the second one the pivots' cells, a level above the
shards, are held against the windows, and anchors go to the cells that may hold some of them alone.
All candidates of all shards count; there is no cap on the search.

Nulls and edge cases: rows with a null label, a null vector, or a null or non-finite component take
no part, and neither do rows with a component of over ``LARGEST`` in size, whose products a long could
not hold; a null id is no anchor and comes last among equal scores; repeated rows are rows (and
anchors) of their own; equal scores are ordered by vec_id; vectors are compared with those of the
same length only; empty vectors score 0; an anchor without positives gives no rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, stored

SCALE = 256
LARGEST = 1 << 16  # of a component
ANCHOR_EVERY, MOVED_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
SHARD = 4096  # candidates of a cover tree
PIVOTS = 256  # cells at most; larger ones are split by hash
LEAF = 256
SHRINK = 1.3  # each level's covering radius, as a part of the one above
BATCH = 256  # anchors that are bounded at once
LOWEST, HIGHEST = -(1 << 62), 1 << 62


# ------------------------------------------------------------- cover tree


class CoverTree:
    """Nodes in arrays: centre, covering radius, children; a leaf has a range of ``at``, the points' order."""

    def __init__(self, points: np.ndarray, norm: float):
        """``points`` are integer vectors as doubles; no one is longer than ``norm``."""
        self.points, self.norm = points, norm
        square = np.einsum("ij,ij->i", points, points)
        self.last = np.sqrt(np.maximum(norm * norm - square, 0.0))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.below: list[list[int] | slice] = []
        self.at = np.zeros(0, np.int64)
        self.leaf: list[bool] = []
        if len(points):
            self._build()
        self.centres = points[self.centre]
        self.radii = np.array(self.radius)

    def _far(self, c: int, at: np.ndarray) -> np.ndarray:
        d = self.points[at] - self.points[c]
        z = self.last[at] - self.last[c]
        return np.sqrt(np.einsum("ij,ij->i", d, d) + z * z)

    def _node(self, c: int, radius: float) -> int:
        self.centre.append(c)
        self.radius.append(radius)
        self.below.append([])
        self.leaf.append(False)
        return len(self.centre) - 1

    def _build(self) -> None:
        every, held, n = np.arange(len(self.points)), [], 0
        far = self._far(0, every)
        level = [(self._node(0, float(far.max())), every, far)]
        while level:
            deeper = []
            for node, at, far in level:
                if len(at) <= LEAF or self.radius[node] == 0.0:
                    self.below[node], self.leaf[node] = slice(n, n + len(at)), True
                    held.append(at)
                    n += len(at)
                    continue
                # centres of the next level cover the node's points within the smaller radius
                within = self.radius[node] / SHRINK
                near, of, centres = far.copy(), np.zeros(len(at), np.int64), [self.centre[node]]
                while near.max() > within:
                    c = int(at[near.argmax()])
                    d = self._far(c, at)
                    closer = d < near
                    near[closer], of[closer] = d[closer], len(centres)
                    centres.append(c)
                for k, c in enumerate(centres):
                    mine = of == k
                    if mine.any():
                        child = self._node(c, float(near[mine].max()))
                        self.below[node].append(child)
                        deeper.append((child, at[mine], near[mine]))
            level = deeper
        self.at = np.concatenate(held)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the products of each query with each node's points."""
        size = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        middle = queries @ self.centres.T
        # the slack is far above the rounding of distances, which come from a difference of squares
        reach = size * (self.radii[None, :] + 1e-6 * (1.0 + self.norm))
        return middle - reach, middle + reach


class Found:
    """The first ``k`` (score, place in the order of ids) of a window of scores."""

    __slots__ = ("low", "high", "k", "best", "least")

    def __init__(self, low: int, high: int, k: int):
        # scores under ``least`` don't count any more
        self.low, self.high, self.k, self.best, self.least = low, high, k, [], low

    def offer(self, down: np.ndarray, order: np.ndarray, rows: np.ndarray) -> None:
        """Negated scores, ascending; of equal ones the smaller order first."""
        a = int(down.searchsorted(-self.high))
        b = min(a + self.k, int(down.searchsorted(-self.least, "right")))
        if a < b:
            self.best += zip(down[a:b].tolist(), order[a:b].tolist(), rows[a:b].tolist(), strict=True)
            self.best.sort()
            del self.best[self.k:]
            if len(self.best) == self.k:
                self.least = max(self.low, -int(self.best[-1][0]))


def search(tree: CoverTree, exact: np.ndarray, query: np.ndarray, lower: np.ndarray, upper: np.ndarray,
           usable: np.ndarray, order: np.ndarray, windows: list[Found]) -> None:
    """Best-first descent for one anchor and all its windows.

    ``exact`` has the points for exact products, ``usable`` marks those that may be found,
    ``order`` ranks ids for ties; all of them are in the order of ``tree.at``.
    """
    if not len(tree.radii) or not windows:
        return
    lower, upper = lower.tolist(), upper.tolist()
    heap = [(-upper[0], 0)]
    high, least = max(w.high for w in windows), min(w.least for w in windows)
    while heap:
        top, node = heapq.heappop(heap)
        if -top < least:
            return
        if lower[node] > high or not any(w.least <= -top and lower[node] <= w.high for w in windows):
            continue
        if not tree.leaf[node]:
            for child in tree.below[node]:
                heapq.heappush(heap, (-upper[child], child))
            continue
        some = tree.below[node]
        scores = exact[some] @ query
        good = (scores >= least) & usable[some]
        good = np.flatnonzero(good & (scores <= high)) if good.any() else ()
        if len(good):
            rows, down = good + some.start, -scores[good]
            by = np.lexsort((order[rows], down))
            rows, down = rows[by], down[by]
            for w in windows:
                w.offer(down, order[rows], rows)
            least = min(w.least for w in windows)


# ------------------------------------------------------------- candidates

_CANDIDATE = "row bigint, vec_id bigint, label bigint, dim int, vector binary"


def candidates(embeddings: DataFrame) -> DataFrame:
    """Rows that take part, with labels moved and integer vectors (stored)."""
    spec = "vec_id bigint, label bigint, dim int, vector binary, square double"

    def task(batches):
        for batch in batches:
            v = batch.column("embedding")
            flat = np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.float64)
            size = np.diff(v.offsets.to_numpy())
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(flat * SCALE)
                fine = np.isfinite(flat) & (np.abs(flat) <= LARGEST)
            cut = np.concatenate([[0], np.cumsum(size)])
            good = np.array([bool(fine[a:b].all()) for a, b in zip(cut[:-1], cut[1:], strict=True)], bool)
            whole = np.where(fine, whole, 0).astype("<i4")
            vectors = [whole[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            square = [float(np.dot(w, w)) for w in (whole[a:b].astype(np.float64) for a, b in
                                                    zip(cut[:-1], cut[1:], strict=True))]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(size.astype(np.int32)),
                                   pa.array(vectors, pa.binary()), pa.array(square, pa.float64())],
                                  names=["vec_id", "label", "dim", "vector", "square"]).filter(pa.array(good))

    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label)
    rows = embeddings.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(~F.exists("embedding", lambda x: x.isNull()))
    return stored(map_arrow(rows, task, spec).withColumn("row", F.monotonically_increasing_id()), "vectors")


class Cells:
    """Pivots of each vector length, a bounded sample chosen by a hash."""

    def __init__(self, rows: DataFrame):
        n, square = rows.agg(F.count("*"), F.max("square")).first()
        self.norm = float(np.sqrt(square or 0.0))
        self.k = min(PIVOTS, max(1, -(-(n or 0) // SHARD)))
        self.pivots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        per_dim = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
        sample = (rows.select("dim", "row", "vector").withColumn("nth", F.row_number().over(per_dim))
                  .where(F.col("nth") <= self.k).orderBy("dim", "nth").limit(PIVOTS * 4).collect())
        for dim, members in groupby(sample, key=lambda r: r["dim"]):
            raw = [r["vector"] for r in members]
            p = np.frombuffer(b"".join(raw), "<i4").astype(np.float64).reshape(len(raw), dim)
            self.pivots[dim] = p, np.sqrt(np.maximum(self.norm ** 2 - np.einsum("ij,ij->i", p, p), 0.0))
        self.radius: dict[tuple[int, int], float] = {}
        self.parts: dict[tuple[int, int], int] = {}

    def nearest(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot) of vectors of one length; cell -1 without a pivot."""
        if dim not in self.pivots:
            return np.full(len(x), -1), np.zeros(len(x))
        p, z = self.pivots[dim]
        last = np.sqrt(np.maximum(self.norm ** 2 - np.einsum("ij,ij->i", x, x), 0.0))
        far = np.stack([np.einsum("ij,ij->i", x - c, x - c) + (last - w) ** 2 for c, w in zip(p, z, strict=True)], 1)
        at = far.argmin(1)
        return at, np.sqrt(far[np.arange(len(x)), at])

    def count(self, placed: DataFrame) -> None:
        """Radius and number of shards of each cell (at most ``PIVOTS`` a vector length)."""
        for r in placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
            self.radius[r["dim"], r["cell"]] = float(r["far"])
            self.parts[r["dim"], r["cell"]] = -(-r["n"] // SHARD)

    def wanted(self, dim: int, q: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(cell, which of the anchors have a window that its bounds meet)."""
        size = np.sqrt(np.einsum("ij,ij->i", q, q))
        out = []
        for (d, cell), radius in sorted(self.radius.items()):
            if d != dim:
                continue
            if cell < 0:
                out.append((cell, np.ones(len(q), bool)))
                continue
            middle = q @ self.pivots[dim][0][cell]
            reach = size * (radius + 1e-6 * (1.0 + self.norm))
            hit = ((middle + reach)[:, None] >= lows) & ((middle - reach)[:, None] <= highs)
            out.append((cell, hit.any(1)))
        return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.float64).reshape(len(column), dim)


def _padded(rows: list[list[int]], fill: float) -> np.ndarray:
    most = max(map(len, rows), default=0)
    return np.array([r + [fill] * (most - len(r)) for r in rows], np.float64).reshape(len(rows), most)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


def placed(rows: DataFrame, cells: Cells) -> DataFrame:
    """Candidates with the cell of their nearest pivot (stored), counted in ``cells``."""

    def task(batches):
        for batch in batches:
            for dim, part in _by_dim(batch):
                cell, far = cells.nearest(dim, _matrix(part.column("vector"), dim))
                yield pa.record_batch([*part.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                      names=[*part.schema.names, "cell", "far"])

    out = map_arrow(rows.select("row", "vec_id", "label", "dim", "vector"), task, _CANDIDATE + ", cell int, far double")
    out = stored(out, "vector-cells")
    cells.count(out)
    return out


# ----------------------------------------------------------------- passes

_HIT = "row bigint, nth int, vec_id bigint, score bigint, found bigint"


def _searched(shards: DataFrame, anchors: DataFrame, cells: Cells, same_label: bool, k: int) -> DataFrame:
    """The first ``k`` of each window of each anchor in every shard: (row, nth, vec_id, score, found).

    ``anchors`` has (row, label, dim, vector, lows, highs); nth numbers its windows.
    """
    parts, norm = cells.parts, cells.norm
    spread = ("dim int, cell int, part int, kind int, row bigint, vec_id bigint, label bigint, vector binary, "
              "lows array<bigint>, highs array<bigint>")

    def dealt(batches):
        for batch in batches:
            for dim, part in _by_dim(batch):
                lows, highs = (_padded(part.column(c).to_pylist(), x) for c, x in (("lows", np.inf), ("highs", -np.inf)))
                for cell, hit in cells.wanted(dim, _matrix(part.column("vector"), dim), lows, highs):
                    mine = part.filter(pa.array(hit))
                    for p in range(parts[dim, cell] if len(mine) else 0):
                        m = len(mine)
                        yield pa.record_batch(
                            [mine.column("dim"), pa.array(np.full(m, cell, np.int32)),
                             pa.array(np.full(m, p, np.int32)), pa.array(np.ones(m, np.int32)), mine.column("row"),
                             pa.nulls(m, pa.int64()), mine.column("label"), mine.column("vector"),
                             mine.column("lows"), mine.column("highs")],
                            names=[x.split()[0] for x in spread.split(", ")])

    part_of = F.pmod(F.xxhash64("row"), F.element_at(F.create_map(*[
        F.lit(x) for (d, c), n in parts.items() for x in (f"{d}:{c}", n)]) if parts else
        F.create_map(F.lit(""), F.lit(1)), F.concat("dim", F.lit(":"), "cell"))).cast("int")
    none = F.lit(None).cast("array<bigint>")
    both = shards.select("dim", "cell", part_of.alias("part"), F.lit(0).alias("kind"), "row", "vec_id", "label",
                         "vector", none.alias("lows"), none.alias("highs")).unionByName(
        map_arrow(anchors.select("row", "label", "dim", "vector", "lows", "highs"), dealt, spread))
    shard = ["dim", "cell", "part"]

    def answered(tree, exact, rows, labels, order, asked) -> list[tuple]:
        out = []
        queries = np.array([a[1] for a in asked])
        lower, upper = tree.bounds(queries)
        for j, (row, query, label, lows, highs) in enumerate(asked):
            windows = [Found(a, b, k) for a, b in zip(lows, highs, strict=True)]

            usable = (labels == label) & (rows != row) if same_label else labels != label
            q = query if exact.dtype == np.float64 else query.astype(np.int64)
            search(tree, exact, q, lower[j], upper[j], usable, order, windows)
            out += [(row, i, at, -score) for i, w in enumerate(windows) for score, _, at in w.best]
        return out

    def task(batches):
        tree = at_shard = None
        for key, kind, batch in _runs(batches, shard):
            dim = key[0]
            x = _matrix(batch.column("vector"), dim)
            if kind == 0:
                if key != at_shard:
                    at_shard, tree, held = key, None, []
                held.append((x, batch))
                continue
            if key != at_shard:
                continue  # anchors of a shard without candidates
            if tree is None:
                points = np.concatenate([h[0] for h in held])
                whole = pa.Table.from_batches([h[1] for h in held])
                rows, labels = whole.column("row").to_numpy(), whole.column("label").to_numpy()
                ids = whole.column("vec_id")
                null = np.array(ids.is_null())
                values = ids.fill_null(0).to_numpy()
                tree, held = CoverTree(points, norm), []
                rows, labels, null, values = (x[tree.at] for x in (rows, labels, null, values))
                order = np.empty(len(rows), np.int64)
                order[np.lexsort((rows, values, null))] = np.arange(len(rows))
                # doubles hold products exactly up to 2 ** 53
                exact = points[tree.at] if norm * norm < 2.0 ** 52 else points[tree.at].astype(np.int64)
            for a in range(0, len(batch), BATCH):
                some = batch.slice(a, BATCH)
                asked = list(zip(some.column("row").to_pylist(), x[a:a + BATCH], some.column("label").to_pylist(),
                                 some.column("lows").to_pylist(), some.column("highs").to_pylist(), strict=True))
                got = answered(tree, exact, rows, labels, order, asked)
                at = [g[2] for g in got]
                yield pa.record_batch([
                    pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()),
                    pa.array([None if null[i] else int(values[i]) for i in at], pa.int64()),
                    pa.array([g[3] for g in got], pa.int64()), pa.array([int(rows[i]) for i in at], pa.int64())],
                    names=["row", "nth", "vec_id", "score", "found"])

    hits = map_arrow(both.repartition(*shard).sortWithinPartitions(*shard, "kind"), task, _HIT)
    first = Window.partitionBy("row", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _runs(batches, shard) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Slices of sorted batches that belong to one shard and kind."""
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in [*shard, "kind"]], 1)
        cut = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1).tolist(), len(keys)]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b > a:
                key = keys[a].tolist()
                yield tuple(key[:-1]), key[-1], batch.slice(a, b - a)


def run(embeddings: DataFrame) -> DataFrame:
    rows = candidates(embeddings)
    cells = Cells(rows)
    shards = placed(rows, cells)
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).select("row", "vec_id", "label", "dim", "vector")
    everything = [F.array(F.lit(x).cast("long")).alias(n) for n, x in (("lows", LOWEST), ("highs", HIGHEST))]
    positives = stored(_searched(shards, anchors.select("*", *everything), cells, True, POSITIVES).select(
        "row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # 50 p <= 100 n <= 95 p in whole numbers
    p = F.col("x.positive_score")
    ways = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("x"))
    windows = ways.select(
        "row", F.transform(p, lambda s: F.ceil(s.cast("decimal(20,0)") / 2).cast("long")).alias("lows"),
        F.transform(p, lambda s: F.floor(s.cast("decimal(20,0)") * 95 / 100).cast("long")).alias("highs"))
    asked = anchors.join(windows, "row")
    negatives = _searched(shards, asked, cells, False, NEGATIVES)
    found = negatives.select("row", (F.col("nth") + 1).alias("place"), F.col("rank").cast("int").alias("rank"),
                             F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (found.join(positives, ["row", "place"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (((label + 1) % {LABELS}) + {LABELS}) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), false)),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, c.label = a.label AS same,
             CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
      FROM v a JOIN v c ON len(a.x) = len(c.x) AND a.r <> c.r WHERE a.vec_id % {ANCHOR_EVERY} = 0),
p AS (SELECT a, anchor_id, vec_id AS positive_id, c, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, c) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY score DESC, vec_id NULLS LAST, s.c) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.a, p.c ORDER BY score DESC, vec_id NULLS LAST, s.c) <= {NEGATIVES}
"""
