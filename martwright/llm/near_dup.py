"""Near-duplicate documents by DartMinHash signatures and banded joining (operator 2).

A document is the weighted set of its shingles of five words (all its words, if fewer); a
shingle's weight is how often it occurs. Documents are alike when the sum of the smaller
weights over the sum of the larger ones is 0.8 or more.

Signature: darts fall on the plane of (weight, rank) of each shingle, at places that only
the shingle's hash decides, ``COORDINATES`` to the unit of area. A document is hit by the
darts below its shingle's weight, and looks only at ranks low enough to get about
ln(COORDINATES) + 3 darts for each coordinate; the earliest dart of each coordinate is the
signature there. Two documents agree on a coordinate with the probability of their
similarity. The work is that of the shingles plus the darts, not their product. Weight is
cut into layers that double, so that large weights take few steps.

Joining: texts with equal words are one content from the start. Contents that agree on a
band of ``ROWS`` coordinates share a bucket. No bucket is expanded into all its pairs: each
member is compared with one pivot, verified on the shingles themselves, and linked members
fall into components. Buckets that still hold several components get a second pivot, the
member with the commonest shingles. What is then still apart can only be linked through shingles that the
pivot does not have: members are joined on the rarest of these, as many as a link needs, and
such pairs are compared. So no candidate link between different components is lost.

Nulls and edge cases: texts without words are unlike everything, each alone in its class;
equal texts are one class; rows with a null or repeated id take part like others (a class is
named by its smallest non-null id, and one text of that id is kept); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import long_list, map_arrow, scratch, stored, text_hash, text_slices
from martwright.llm.components import components
from martwright.llm.words import grams, mix, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
# The least row of a class, by this order, is kept: ids first, then rows without one, then texts.
_ORDER = "struct(doc_id IS NULL AS no_id, doc_id, text_hash)"
_U = np.uint64
_STEP, _LAYER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _times(n: int, by: int) -> np.uint64:
    return _U(n * by & 0xFFFFFFFFFFFFFFFF)


def shingles(h: np.ndarray, rows: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's runs of k words, or the run of all its words if fewer."""
    g, _, cuts = grams(h, rows, k)
    n = np.diff(rows)
    short = np.flatnonzero((n > 0) & (n < k))
    if not len(short):
        return g, cuts
    whole = np.array([grams(h[rows[i]:rows[i + 1]], np.array([0, n[i]]), int(n[i]))[0][0]
                      for i in short], np.uint64)
    return np.insert(g, cuts[short], whole), cuts + np.searchsorted(short, np.arange(len(cuts)))


def weighted(g: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of each text."""
    doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.argsort(g, kind="stable")  # texts stay in order among equal hashes
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (np.diff(g) != 0) | (np.diff(doc) != 0)
    first = np.flatnonzero(new)
    return doc[first], g[first], np.diff(np.append(first, len(g))).astype(float)


def darts(doc, element, weight, n_docs: int, t: int = COORDINATES) -> np.ndarray:
    """(n_docs, t): the hash of the earliest dart of each coordinate; rows without elements are 0."""
    out = np.zeros(n_docs * t, np.uint64)
    total = np.bincount(doc, weight, n_docs)
    reach = (np.log(t) + 3) / np.maximum(total, 1e-300)  # ranks that are looked at
    todo = total > 0
    while todo.any():
        mine = todo[doc]
        d, e, w = doc[mine], element[mine], weight[mine]
        keys, ranks, marks = [], [], []
        low, high, layer = 0.0, 1.0, 0
        while len(d):
            state = mix(e + _times(layer, _LAYER))
            rank = np.zeros(len(d))
            live, dd, ww = np.arange(len(d)), d, w
            speed = t * (high - low)
            step = 0
            while len(live):
                step += 1
                s = mix(state[live] + _times(step, _STEP))
                u = ((s >> _U(11)).astype(float) + 0.5) * 2.0 ** -53
                near = np.flatnonzero(u >= np.exp(-speed * (reach[dd] - rank[live])))
                live, dd, ww, s = live[near], dd[near], ww[near], s[near]
                r = rank[live] - np.log(u[near]) / speed
                rank[live] = r
                v = mix(s ^ _U(_STEP))
                at = low + (high - low) * ((v >> _U(32)).astype(float) * 2.0 ** -32)
                hit = at < ww
                keys.append(dd[hit] * t + ((v[hit] & _U(0xFFFFFFFF)) % _U(t)).astype(np.int64))
                ranks.append(r[hit])
                marks.append(s[hit])
            low, high, layer = high, 2 * high, layer + 1
            more = w > low
            d, e, w = d[more], e[more], w[more]
        key, mark = np.concatenate(keys), np.concatenate(marks)
        order = np.argsort(-np.concatenate(ranks), kind="stable")
        out[key[order]] = mark[order]  # the earliest dart is written last
        full = np.zeros(n_docs * t, bool)
        full[key] = True
        todo = todo & ~full.reshape(n_docs, t).all(axis=1)
        reach[todo] *= 1.5  # a coordinate without a dart: look further
    return out.reshape(n_docs, t)


def bands(signature: np.ndarray, n: int = BANDS) -> np.ndarray:
    """(texts, n): a hash of each band of coordinates."""
    parts = signature.reshape(len(signature), n, -1)
    out = np.repeat(np.arange(1, n + 1, dtype=np.uint64)[None, :] * _U(_LAYER), len(signature), axis=0)
    for j in range(parts.shape[2]):
        out = mix(out * _U(_STEP) + parts[:, :, j])
    return out


def _content_key(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over words and places: equal for equal words."""
    pos = (np.arange(len(h)) - np.repeat(rows[:-1], np.diff(rows))).astype(np.uint64)
    out = []
    for seed in (_U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5)):
        x = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + (pos + _U(1)) * seed))])
        out.append(mix(x[rows[1:]] - x[rows[:-1]] + np.diff(rows).astype(np.uint64)))
    return out[0].view(np.int64), out[1].view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, c1, c2, total, bands) for each row; ``total`` is the sum of weights, 0 without words."""

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                spans, h = words(data, offsets)
                c1, c2 = _content_key(h, spans.rows)
                g, cuts = shingles(h, spans.rows)
                sig = darts(*weighted(g, cuts), end - row)
                b = bands(sig)
                yield pa.record_batch([
                    batch.column("doc_id").slice(row, end - row),
                    batch.column("text_hash").slice(row, end - row), pa.array(c1), pa.array(c2),
                    pa.array(np.diff(cuts)),
                    long_list(b.reshape(-1), np.arange(0, b.size + 1, BANDS))],
                    names=["doc_id", "text_hash", "c1", "c2", "total", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       text_hash(F.col("text")).alias("text_hash"))
    return map_arrow(rows, task,
                     "doc_id bigint, text_hash bigint, c1 bigint, c2 bigint, total bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(c1, c2, s): the shingles of each text, the n-th occurrence of one told from its first.

    As sets of these, intersection and union are the sums of smaller and larger weights.
    """

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                spans, h = words(data, offsets)
                c1, c2 = _content_key(h, spans.rows)
                doc, e, w = weighted(*shingles(h, spans.rows))
                n = w.astype(np.int64)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = np.repeat(doc, n)
                each = mix(np.repeat(e, n) + nth.astype(np.uint64) * _U(_STEP))
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(end - row + 1))
                yield pa.record_batch([pa.array(c1), pa.array(c2), long_list(each[order], cuts)],
                                      names=["c1", "c2", "s"])

    return map_arrow(docs.select("text"), task, "c1 bigint, c2 bigint, s array<bigint>")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds the similarity of the pairs (x, y)."""
    both = (pairs.join(sets.select(F.col("id").alias("x"), F.col("s").alias("sx")), "x")
            .join(sets.select(F.col("id").alias("y"), F.col("s").alias("sy")), "y"))
    same = F.size(F.array_intersect("sx", "sy"))
    return both.select("x", "y", (same / (F.size("sx") + F.size("sy") - same)).alias("sim"))


def _apart(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members (with their component ``f``) of the buckets that hold several components."""
    now = members.join(label, "id", "left").withColumn("f", F.coalesce("component", "id")).drop("component")
    several = (now.groupBy("b").agg(F.min("f").alias("lo"), F.max("f").alias("hi"))
               .where("lo <> hi").select("b"))
    return now.join(several, "b")


def _against_pivot(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, q, inside, outside): elements shared with the pivot q, and those that q does not have."""
    return (apart.select("id", "q").distinct()
            .join(sets, "id").join(sets.select(F.col("id").alias("q"), F.col("s").alias("sq")), "q")
            .select("id", "q", F.size(F.array_intersect("s", "sq")).alias("inside"),
                    F.array_except("s", "sq").alias("outside")))


def _pairs_apart(apart: DataFrame, against: DataFrame, similarity: float) -> DataFrame:
    """Pairs across components that can still be linked, of members that share a pivot q.

    A similarity of s takes |x & y| >= s / (1 + s) * (|x| + |y|). What x and y share inside q is
    at most the smaller of their shares of q; the rest has to be shared outside of q. So either
    both have enough inside, which next to none do without being linked to q and so to one
    another, or they share elements that q does not have, which are rare, and are joined on.
    """
    def side(rows, n, *keys):
        return rows.select(*keys, *[F.col(c).alias(c + n) for c in ("id", "f", "total", "inside")])

    needed = (similarity / (1 + similarity) * (F.col("total1") + F.col("total2"))
              - F.least("inside1", "inside2") - 1e-9)
    apart_and_alike = ((F.col("id1") < F.col("id2")) & (F.col("f1") != F.col("f2"))
                       & (F.least("total1", "total2") >= similarity * F.greatest("total1", "total2")))
    nodes = apart.select("id", "f", "total").distinct().join(against, "id")
    within = side(nodes, "1", "q").where(F.col("inside1") >= similarity * F.col("total1") - 1e-9)
    within = (within.join(side(nodes, "2", "q").where(F.col("inside2") >= similarity * F.col("total2") - 1e-9), "q")
              .where(apart_and_alike & (needed <= 0)).select("id1", "id2"))
    beyond = nodes.withColumn("e", F.explode("outside"))
    often = stored(beyond.groupBy("q", "e").agg(F.count("*").alias("n"), F.min("f").alias("lo"),
                                                F.max("f").alias("hi"))
                   .where("lo <> hi").select("q", "e", "n"), "outside")
    # Elements in order of rarity. The first one that a pair shares has, on either side, as many
    # from it on as the pair needs; joining only such elements keeps that one of every pair.
    # With a partner of at least ``similarity`` times its own size, and no more inside than its
    # own, a member needs at least similarity * total - inside: what has fewer is not joined.
    mine = Window.partitionBy("q", "id")
    left = F.count("*").over(mine) - F.row_number().over(mine.orderBy("n", "e")) + 1
    beyond = stored(beyond.join(often, ["q", "e"]).withColumn("left", left)
                    .where(F.col("left") >= similarity * F.col("total") - F.col("inside") - 1e-9)
                    .select("q", "e", "id", "f", "total", "inside", "left"), "beyond")
    beyond = (side(beyond, "1", "q", "e", F.col("left").alias("left1"))
              .join(side(beyond, "2", "q", "e", F.col("left").alias("left2")), ["q", "e"])
              .where(apart_and_alike & (F.least("left1", "left2") >= needed)).select("id1", "id2"))
    return within.unionByName(beyond).select(F.col("id1").alias("x"), F.col("id2").alias("y")).distinct()


def links(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their content id, contents, links between contents (a, b))."""
    rows = stored(signatures(docs), "signatures")
    contents = stored(
        rows.where("total > 0").groupBy("c1", "c2")
        .agg(F.min(F.expr(_ORDER)).alias("least"), F.first("total").alias("total"),
             F.first("bands").alias("bands"))
        .withColumns({"id": F.monotonically_increasing_id(), "doc_id": F.col("least.doc_id")}), "contents")
    every = contents.select("id", "total", F.explode("bands").alias("b"))
    # the pivot is the member whose hashed id is least, so that buckets tend to share pivots
    pivot = F.min(F.struct(F.xxhash64("id").alias("h"), F.col("id").alias("pivot"),
                           F.col("total").alias("pivot_total")))
    buckets = (every.groupBy("b").agg(F.count("*").alias("n"), pivot.alias("p"))
               .where("n > 1").select("b", "p.pivot", "p.pivot_total"))
    members = stored(every.join(buckets, "b"), "members")

    def sizes_allow(a, b):
        return F.least(a, b) >= similarity * F.greatest(a, b)

    # only contents that share a bucket are read again for their shingles
    shared = stored(members.select("id").distinct(), "shared")
    wanted = contents.join(shared, "id").select("id", "c1", "c2", "doc_id")
    ids = wanted.select(F.coalesce("doc_id", F.lit(-1 << 63)).alias("__wanted")).distinct()
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63))
    texts = docs.select("text", key.alias("__wanted")).join(ids, "__wanted", "left_semi")
    sets = stored(shingle_sets(texts).join(wanted, ["c1", "c2"]).select("id", "s")
                  .dropDuplicates(["id"]), "shingle-sets")

    pairs = (members.where("id <> pivot")
             .select(F.col("id").alias("x"), F.col("pivot").alias("y")).distinct())
    checked = stored(verify(pairs, sets), "checked")
    found = checked.where(F.col("sim") >= similarity).select(F.col("x").alias("a"), F.col("y").alias("b"))
    with scratch(docs.sparkSession) as keep:
        apart = stored(_apart(members, components(found)), "apart")
        keep.append(apart)
    if not apart.isEmpty():
        # a second pivot: the member whose elements are the commonest among what is apart, such
        # as the text that the others were copied from
        with scratch(docs.sparkSession) as keep:
            each = stored(apart.select("id").distinct().join(sets, "id")
                          .select("id", F.explode("s").alias("e")), "elements")
            often = stored(each.groupBy("e").agg(F.count("*").alias("n")).where("n > 1"), "often")
            central = each.join(often, "e").groupBy("id").agg(F.sum("n").alias("sum"))
            ranked = (apart.join(central, "id", "left")
                      .withColumn("central", F.coalesce(F.col("sum") / F.col("total"), F.lit(0.0))))
            second = stored(ranked.groupBy("b").agg(F.max(F.struct(
                "central", F.xxhash64("id").alias("h"), F.col("id").alias("q"), F.col("f").alias("qf"),
                F.col("total").alias("qt"))).alias("p")).select("b", "p.q", "p.qf", "p.qt"), "second")
            keep.append(second)
        pairs = (apart.join(second, "b").where("f <> qf").where(sizes_allow(F.col("total"), F.col("qt")))
                 .select(F.col("id").alias("x"), F.col("q").alias("y")).distinct()
                 .join(checked.select("x", "y"), ["x", "y"], "left_anti"))
        more = stored(verify(pairs, sets).where(F.col("sim") >= similarity), "checked-2")
        found = found.unionByName(more.select(F.col("x").alias("a"), F.col("y").alias("b")))
        with scratch(docs.sparkSession) as keep:
            apart = stored(_apart(apart.drop("f"), components(found)).join(second.select("b", "q"), "b"), "apart-2")
            keep.append(apart)
        with scratch(docs.sparkSession) as keep:
            against = stored(_against_pivot(apart, sets), "against")
            pairs = stored(_pairs_apart(apart, against, similarity), "pairs-3")
            last = stored(verify(pairs, sets).where(F.col("sim") >= similarity), "checked-3")
            keep.append(last)
        found = found.unionByName(last.select(F.col("x").alias("a"), F.col("y").alias("b")))
    return rows, contents, found


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept, text_hash): the class is named by its smallest doc_id.

    Kept is one row of each class: of its smallest doc_id, or without an id if none of its rows
    has one, the text with the least hash, and the first one of rows that are equal in both. A
    text without words is a class of its own.
    """
    with scratch(docs.sparkSession) as keep:
        rows, contents, found = links(docs, similarity)
        grouped = (contents.select("id", "c1", "c2", "least").join(components(found), "id", "left")
                   .withColumn("component", F.coalesce("component", "id")))
        named = grouped.groupBy("component").agg(F.min("least").alias("least"))
        by_content = grouped.drop("least").join(named, "component").select("c1", "c2", "component", "least")
        best = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
        worded = stored(
            rows.where("total > 0").select("doc_id", "text_hash", "c1", "c2").join(by_content, ["c1", "c2"])
            .select("doc_id", F.col("least.doc_id").alias("class_id"), "component", "text_hash", best.alias("best"))
            .withColumn("row", F.monotonically_increasing_id()), "class-rows")
        keep += [rows, worded]
    # the least row number of each class, combined before the shuffle however many rows are equal
    first = worded.where("best").groupBy("component").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("kept"))
    alone = rows.where("total = 0").select("doc_id", F.col("doc_id").alias("class_id"),
                                           F.lit(True).alias("kept"), "text_hash")
    return (worded.join(first, "row", "left")
            .select("doc_id", "class_id", F.coalesce("kept", F.lit(False)).alias("kept"), "text_hash")
            .unionByName(alone))


def run(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id", "kept")
