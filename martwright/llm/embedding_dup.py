"""Near-duplicate embeddings by spherical k-means cells (operator 4).

Vectors of one label are alike when their cosine, in double precision, is 0.98 or more.
Identical vectors are one point from the start, with a count. Points go to the cell of their
nearest centroid; a point that lies within half the largest distance of a link from the
border to another cell is a guest there as well. Of two linked points in different cells
one is such a guest at least, so comparing each cell's own points with all its points finds
every link. A cell of more than ``CELL_LARGE`` points (guests included) is split by centroids of its
own in the same way, level after level, so that cells stay small however many vectors there
are; a pair counts in the one cell that each level names. A cell stays whole where splitting
would not halve its products: a cluster that is tighter than a link must be compared in full.
Cells are cut into blocks of ``BLOCK_BYTES``, and products are taken block by block; each pair
of blocks gives counts of links and, for each point, one link into its local component.

Centroids are fitted in numpy on a bounded sample (``FIT_VECTORS`` a cell, chosen by a hash of
the vector), those of the first level on the driver, all others in tasks; every vector is
indexed.

Nulls and edge cases: vectors that are null, empty, zero, or hold null or non-finite parts,
and vectors with a null label, link with nothing: component_id is their own id and they are
kept. Vectors of different length are never alike. Repeated ids are vectors each for itself,
an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, ship, stored
from martwright.llm.components import components

COSINE = 0.98
FIT_VECTORS = 8192
CELL_POINTS = 2048
CELL_LARGE = 4 * CELL_POINTS
CELLS_MOST = 256        # of one level
COPIES_MOST = 4         # times a level's points that its cells may hold
BLOCK_BYTES = 2 << 20
CHUNK = 1 << 21         # products held at once
STEPS = 12


def kmeans(x: np.ndarray, k: int, steps: int = STEPS, seed: int = 11) -> np.ndarray:
    """Unit centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(steps):
        at = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def unit(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cells_of(x: np.ndarray, centroids: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, (points, cells) whether the point is a guest of the cell)."""
    near = x @ centroids.T
    home = near.argmax(axis=1)
    best = near[np.arange(len(x)), home]
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))[home]
    # distance to the plane between two centroids, against half a link's length
    reach = np.sqrt(2 - 2 * cosine) / 2 + 1e-9
    guest = (best[:, None] - near) <= reach * apart
    guest[np.arange(len(x)), home] = False
    return home, guest


def local_links(x, y, ok: np.ndarray, cosine: float):
    """(i, j) of the linked rows of x and y, of those that may be compared."""
    return np.nonzero((x @ y.T >= cosine) & ok)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each point to the smallest of its component under the links (a, b)."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    f = np.arange(len(ids))
    while True:
        g = f.copy()
        np.minimum.at(g, f[u], f[v])
        np.minimum.at(g, f[v], f[u])
        np.minimum.at(g, u, f[v])
        np.minimum.at(g, v, f[u])
        g = g[g]
        if (g == f).all():
            return ids, ids[f]
        f = g


def split_by(x: np.ndarray, k: int, cosine: float = COSINE) -> np.ndarray | None:
    """Centroids of at most k cells, or None where they would not halve the products."""
    k = min(k, CELLS_MOST, len(x))
    if k < 2:
        return None
    c = kmeans(x, k)
    home, guest = cells_of(x, c, cosine)
    size = (np.bincount(home, minlength=k) + guest.sum(axis=0)) / len(x)
    return c if 2 * (size ** 2).sum() <= 1 and size.sum() <= COPIES_MOST else None


def fit(points: DataFrame, n: int, largest: int, cosine: float = COSINE) -> dict[int, np.ndarray]:
    """Centroids of the first level for each vector length."""
    most = 1 << 30
    chosen = (points.where(F.pmod(F.col("k1"), F.lit(most)) < min(most, most * FIT_VECTORS // max(n, 1)))
              .select("k1", "embedding").toArrow().sort_by("k1"))
    rows: dict[int, list] = {}
    for v in chosen.column("embedding").to_pylist():
        rows.setdefault(len(v), []).append(v)
    found = {d: split_by(unit(np.array(v)), -(-largest // CELL_POINTS), cosine) for d, v in rows.items()}
    return {d: c for d, c in found.items() if c is not None}


def _matrix(rows) -> np.ndarray:
    """Unit vectors of rows of one length."""
    lists = rows.column("embedding")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return unit(np.asarray(lists.flatten()).reshape(len(lists), -1))


def _place(rows, centroids: np.ndarray | None, cosine: float):
    """The rows, one for each cell that a point is in, with cell, home and guests."""
    x = _matrix(rows)
    home, guest = cells_of(x, np.eye(1, x.shape[1]) if centroids is None else centroids, cosine)
    g, c = np.nonzero(guest)
    guests = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(g, np.arange(len(x) + 1)).astype(np.int32)), pa.array(c.astype(np.int32)))
    inside = guest.copy()
    inside[np.arange(len(x)), home] = True
    at, cell = np.nonzero(inside)
    take = pa.array(at)
    out = rows.take(take)
    for name, value in (("cell", pa.array(cell.astype(np.int32))), ("home", pa.array(home[at].astype(np.int32))),
                        ("guests", guests.take(take))):
        out = out.append_column(name, value)
    return out


_PLACED = "cell int, home int, guests array<int>"
_ROWS = ("id bigint, label string, n bigint, embedding array<double>, dim int, path array<int>, "
         "levels array<struct<home: int, guests: array<int>>>")
_CELL = ["label", "dim", "path"]


def _first_level(points: DataFrame, centroids: dict[int, np.ndarray], cosine: float) -> DataFrame:
    def task(batches):
        for batch in batches:
            size = batch.column("dim").to_numpy()
            for d in np.unique(size):
                part = batch.take(pa.array(np.flatnonzero(size == d)))
                yield _place(part, centroids.get(int(d)), cosine)

    rows = points.select("id", "label", "n", "embedding", F.size("embedding").alias("dim"),
                         F.expr("cast(array() as array<int>)").alias("path"),
                         F.expr("cast(array() as array<struct<home: int, guests: array<int>>>)").alias("levels"))
    return map_arrow(rows, task, f"{_ROWS}, {_PLACED}")


def _next_level(rows: DataFrame, cosine: float) -> DataFrame:
    """Rows of large cells (with their number of points, m), placed in cells of the cell; those
    of cells that stay whole have a null cell. A cell's points are placed in parts of
    ``CELL_POINTS``; the centroids go to each part."""
    most = 1 << 30
    share = F.lit(float(most * FIT_VECTORS)) / F.col("m")
    points, large = CELL_POINTS, CELLS_MOST
    parts = F.ceil(F.col("m") / points).cast("int")

    def learn(key, group):
        group = group.sort_by("id")
        m = group.column("m")[0].as_py()
        c = split_by(_matrix(group), min(-(-m // points), large), cosine)
        own = group.slice(0, 0 if c is None else 1).select(["label", "dim", "path", "m"])
        return own.append_column("centroids", pa.array([] if c is None else [c.tolist()],
                                                       pa.list_(pa.list_(pa.float64()))))

    def place(key, group, centroids):
        if len(centroids) and len(group):
            c = np.array(centroids.column("centroids")[0].as_py())
            return _place(group.drop_columns("part"), c, cosine)
        group = group.drop_columns("part")
        for name, kind in (("cell", pa.int32()), ("home", pa.int32()), ("guests", pa.list_(pa.int32()))):
            group = group.append_column(name, pa.nulls(len(group), kind))
        return group

    centroids = (rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(most)) < share).groupBy(*_CELL)
                 .applyInArrow(learn, "label string, dim int, path array<int>, m bigint, "
                                      "centroids array<array<double>>"))
    centroids = centroids.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("m")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), parts).cast("int"))
    return (dealt.drop("m").groupBy(*_CELL, "part").cogroup(centroids.groupBy(*_CELL, "part"))
            .applyInArrow(place, f"{_ROWS}, {_PLACED}"))


def _deeper(placed: DataFrame) -> DataFrame:
    return placed.withColumns({
        "path": F.concat("path", F.array("cell")),
        "levels": F.concat("levels", F.array(F.struct("home", "guests")))}).drop("cell", "home", "guests")


def cells(points: DataFrame, centroids: dict[int, np.ndarray], cosine: float = COSINE) -> DataFrame:
    """Points in their cells, own and guests, with the number m of points of the cell."""
    def sized(rows):
        return rows.join(rows.groupBy(*_CELL).agg(F.count("*").alias("m")), _CELL)

    rows = stored(sized(_deeper(_first_level(points, centroids, cosine))), "cells")
    done, level = rows.where(F.col("m") <= CELL_LARGE), 1
    while True:
        large = rows.where(F.col("m") > CELL_LARGE)
        if large.isEmpty():
            return done
        level += 1
        placed = stored(_next_level(large, cosine), f"placed-{level}")
        done = done.unionByName(sized(placed.where(F.col("cell").isNull()).drop("cell", "home", "guests")))
        rows = stored(sized(_deeper(placed.where(F.col("cell").isNotNull()))), f"cells-{level}")
        done = done.unionByName(rows.where(F.col("m") <= CELL_LARGE))


def _counts_here(cell: int, home_a, home_b, guests_a, guests_b) -> np.ndarray:
    """Which pairs count in this cell: of two cells p < q, a pair counts in p if its point of q
    is a guest there, else in q; a pair of guests counts elsewhere."""
    own_a, own_b = home_a == cell, home_b == cell
    ok = own_a[:, None] & own_b[None, :]
    if own_a.any() and not own_b.all():
        ok[np.ix_(own_a, ~own_b)] = (cell < home_b[~own_b])[None, :] | ~guests_a[own_a][:, home_b[~own_b]]
    if own_b.any() and not own_a.all():
        ok[np.ix_(~own_a, own_b)] = ((cell < home_a[~own_a])[None, :] | ~guests_b[own_b][:, home_a[~own_a]]).T
    return ok


def _compare(group: pa.Table, i: int, j: int, cosine: float) -> pa.Table:
    """Counts and spanning links of one pair of blocks."""
    path = group.column("path")[0].as_py()
    ids, n, sub = (group.column(c).to_numpy() for c in ("id", "n", "sub"))
    x = _matrix(group)
    # each row has one entry a level
    entries = group.column("levels").combine_chunks().flatten()
    homes = entries.field("home").to_numpy().reshape(len(ids), len(path))
    lists = entries.field("guests")
    entry = np.repeat(np.arange(len(entries)), lists.value_lengths().to_numpy())
    member = np.asarray(lists.flatten())
    guests = np.zeros((len(entries), int(max(homes.max(), *path)) + 1), bool)
    fits = member < guests.shape[1]
    guests[entry[fits], member[fits]] = True
    guests = guests.reshape(len(ids), len(path), -1)
    a, b = np.flatnonzero(sub == i), np.flatnonzero(sub == j)
    a, b = a[np.argsort(ids[a])], b[np.argsort(ids[b])]
    count = np.zeros(len(ids))
    star, least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, CHUNK // max(len(b), 1))
    for r in range(0, len(a), step):
        some = a[r:r + step]
        ok = np.ones((len(some), len(b)), bool)
        for level, cell in enumerate(path):
            ok &= _counts_here(cell, homes[some, level], homes[b, level], guests[some, level], guests[b, level])
        if i == j:
            ok &= np.arange(r, r + len(some))[:, None] < np.arange(len(b))[None, :]
        p, q = local_links(x[some], x[b], ok, cosine)
        if len(p):
            p, q = some[p], b[q]
            count += np.bincount(p, n[q], len(ids)) + np.bincount(q, n[p], len(ids))
            for out, new in zip((star, least), _stars(ids[p], ids[q]), strict=True):
                out.append(new)
    star, least = _stars(np.concatenate(star), np.concatenate(least))
    order = np.argsort(ids)
    at = order[np.searchsorted(ids[order], star)]
    return pa.table({"id": star, "links": count[at].astype(np.int64), "to": least})


def links(vectors: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with the id of their point, points' links, rows without a point): points are
    distinct vectors of a label."""
    parts = F.col("embedding").cast("array<double>")
    fine = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"),
                          parts.alias("embedding"))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    rows = rows.withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(7), "embedding")})
    points = stored(rows.where("fine").groupBy("label", "k1", "k2")
                    .agg(F.first("embedding").alias("embedding"), F.count("*").alias("n"))
                    .withColumn("id", F.monotonically_increasing_id()), "points")
    total, largest = (points.groupBy("label").agg(F.count("*").alias("m"))
                      .agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first())
    placed = cells(points, fit(points, total, largest, cosine) if total else {}, cosine)
    subs = F.ceil(F.col("m") * F.col("dim") * 8 / BLOCK_BYTES).cast("int")
    sub = F.pmod(F.xxhash64("id"), F.col("subs")).cast("int")
    paired = (placed.withColumn("subs", subs).withColumn("sub", sub)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
              .withColumns({"i": F.least("sub", "other"), "j": F.greatest("sub", "other")}))
    ship(vectors.sparkSession)

    def task(key, group):
        return _compare(group, key[3].as_py(), key[4].as_py(), cosine)

    found = stored(paired.groupBy(*_CELL, "i", "j")
                   .applyInArrow(task, "id bigint, links bigint, to bigint"), "vector-links")
    ids = points.select("label", "k1", "k2", "id", "n")
    known = rows.where("fine").drop("embedding").join(ids, ["label", "k1", "k2"])
    return known, found, rows.where(~F.col("fine")).select("vec_id")


def run(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    known, found, none = links(vectors, cosine)
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    known = stored(known.join(counts, "id", "left").join(member, "id", "left")
                   .withColumn("component", F.coalesce("component", "id"))
                   .select("vec_id", "n", "links", "component"), "vectors")
    least = known.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = known.join(least, "component").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    alone = none.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL
         AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
         AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) AS fine
  FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND a.fine AND b.fine AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
c AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
      SELECT a, min(b) AS m FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
