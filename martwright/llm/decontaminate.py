"""Benchmark decontamination by a prefix-filtered set join (operator 9).

A window is ``WINDOW`` consecutive words of an item, or the whole of a shorter item. It is
the sequence of its shingles of ``SHINGLE`` words. For a window to occur in a document all
its shingles must, so one of them is a sufficient prefix, and the rarest one in the
documents is the cheapest. The join goes as follows.

1. Documents are scanned once for shingles that some window has. A bit map made of the
   windows' shingles is all that each task holds of the benchmark: at least 16 bits for each
   shingle, so that one word in 16 at most is taken for a hit by chance, up to 16 MB for a
   benchmark of 8 million shingles; a larger one lets more words through, which the join then
   drops. Runs of consecutive hits come out, cut into overlapping pieces no longer than ``PIECE``.
2. The shingles of the runs are counted over all documents; each window's rarest one is
   joined with the runs. Offsets give the place where the window would start (length and
   positional bounds), and the run's shingles there are compared with all of the window's.
3. The hit words of a document are the union of the places' intervals.

Benchmark and matches are joined as Spark tables, whatever the benchmark's size.

Nulls and edge cases: a null or empty text has no words; items without words have no
windows; items with a null id count as windows, but not as items; an empty benchmark hits
nothing; a document id that repeats is taken as one row each (``row``); other columns are
ignored. Documents with n_words = 0 are not contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.common import long_list, map_arrow, ship, stored, text_hash, text_slices
from martwright.llm.words import grams, words

WINDOW = 13
SHINGLE = 4
PIECE = 64
MAP_LEAST, MAP_MOST = 23, 27  # logarithms of a map's bits: from one megabyte to sixteen


def _windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, k, shingles): the windows of all items; k is the words of a shingle."""

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                spans, h = words(data, offsets)
                doc, ks, out = [], [], []
                for i in range(end - row):
                    mine = h[spans.rows[i]:spans.rows[i + 1]]
                    if not len(mine):
                        continue
                    k = min(shingle, len(mine))
                    g = grams(mine, np.array([0, len(mine)]), k)[0].view(np.int64)
                    n = min(window, len(mine)) - k + 1
                    for a in range(len(g) - n + 1):
                        doc.append(i)
                        ks.append(k)
                        out.append(g[a:a + n])
                yield pa.record_batch([
                    batch.column("item_id").slice(row, end - row).take(pa.array(doc, pa.int64())),
                    pa.array(ks, pa.int32()), pa.array(out, pa.list_(pa.int64()))],
                    names=["item_id", "k", "shingles"])

    ids = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return map_arrow(ids, task, "item_id string, k int, shingles array<bigint>")


def _map_bits(shingles: int) -> int:
    """The logarithm of the bits of a map of so many shingles."""
    return min(max((16 * max(shingles, 1) - 1).bit_length(), MAP_LEAST), MAP_MOST)


def _bit_map(windows: DataFrame) -> dict[int, np.ndarray]:
    """For each k, the bits (packed in bytes, least first) set by the windows' shingles."""
    each = windows.select("k", F.explode("shingles").alias("s")).distinct()
    sizes = {k: _map_bits(n) for k, n in sorted(each.groupBy("k").count().collect())}  # at most SHINGLE rows
    if not sizes:
        return {}
    unused = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, 64 - n)])
    rows = (each.withColumn("bit", F.call_function("shiftrightunsigned", "s", unused[F.col("k")]))
            .groupBy("k", F.shiftright("bit", 6).alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow())
    k, at, bits = (rows.column(c).to_numpy() for c in ("k", "at", "bits"))
    maps = {}
    for size, n in sizes.items():
        words_ = np.zeros(1 << (n - 6), "<i8")
        words_[at[k == size]] = bits[k == size]
        maps[size] = words_.view(np.uint8)
    return maps


def _in_map(m: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which shingles have their bit set."""
    at = (g >> np.uint64(64 - (len(m).bit_length() + 2))).astype(np.int64)
    return (m[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _scan(docs: DataFrame, maps: dict[int, np.ndarray], window: int, shingle: int) -> DataFrame:
    """A row (null k) for each document and one for each piece of a run of hits."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(maps)  # at most SHINGLE maps of 2^MAP_MOST bits
    stride = PIECE - (window - shingle)

    def task(batches):
        bits = shared.value
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                spans, h = words(data, offsets)
                n_words = np.diff(spans.rows)
                part = batch.slice(row, end - row)
                none = len(n_words)
                yield pa.record_batch([
                    part.column("doc_id"), part.column("row"), part.column("text_hash"),
                    pa.array(n_words), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64()),
                    pa.nulls(none, pa.list_(pa.int64()))],
                    names=["doc_id", "row", "text_hash", "n_words", "k", "first", "shingles"])
                for k, m in bits.items():
                    g, pos, cuts = grams(h, spans.rows, k)
                    hit = np.flatnonzero(_in_map(m, g))
                    if not len(hit):
                        continue
                    new = np.ones(len(hit), bool)
                    new[1:] = (np.diff(hit) > 1) | (pos[hit[1:]] == 0)
                    a = hit[new]
                    b = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)] + 1
                    # overlapping pieces: every window of a run lies in one of them
                    per = np.maximum(-(-(b - a - (PIECE - stride)) // stride), 1)
                    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
                    s = np.repeat(a, per) + nth * stride
                    e = np.minimum(s + PIECE, np.repeat(b, per))
                    doc = np.searchsorted(cuts, s, "right") - 1
                    size = e - s
                    at = np.concatenate([[0], np.cumsum(size)])
                    take = np.arange(at[-1]) - np.repeat(at[:-1] - s, size)
                    ids = pa.array(doc)
                    yield pa.record_batch([
                        part.column("doc_id").take(ids), part.column("row").take(ids),
                        part.column("text_hash").take(ids), pa.array(n_words[doc]), pa.array(np.full(len(s), k, np.int32)),
                        pa.array(pos[s]), long_list(g[take], at)],
                        names=["doc_id", "row", "text_hash", "n_words", "k", "first", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row"), text_hash(F.col("text")).alias("text_hash"))
    return map_arrow(rows, task, "doc_id bigint, row bigint, text_hash bigint, n_words bigint, k int, first bigint, "
                                 "shingles array<bigint>")


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         shingle: int = SHINGLE) -> DataFrame:
    """Per document: row, doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = stored(_windows(benchmark, window, shingle), "bench-windows")
    scanned = stored(_scan(docs, _bit_map(windows), window, shingle), "bench-runs")
    runs = scanned.where(F.col("k").isNotNull())
    hits = runs.select("row", "n_words", "k", "first", "shingles",
                       F.posexplode("shingles").alias("i", "s"))
    rarity = hits.groupBy("k", "s").agg(F.count("*").alias("n"))
    distinct = windows.select("k", "shingles").distinct()
    # order the shingles of each window by rarity; the first is its prefix. A window with a
    # shingle that no document has drops out here.
    ranked = (distinct.select("k", "shingles", F.posexplode("shingles").alias("o", "s"))
              .join(rarity, ["k", "s"])
              .groupBy("k", "shingles")
              .agg(F.min(F.struct("n", "o", "s")).alias("p"), F.countDistinct("o").alias("found")))
    prefixes = (ranked.where(F.col("found") == F.size("shingles"))
                .select("k", F.col("shingles").alias("w"), F.col("p.o").alias("o"),
                        F.col("p.s").alias("s")))
    at = F.col("i") - F.col("o")  # where in the piece the window would start
    size = F.size("w")
    places = (hits.join(prefixes, ["k", "s"])
              .where((at >= 0) & (at + size <= F.size("shingles"))
                     & (F.col("first") + at + size + F.col("k") - 1 <= F.col("n_words")))
              .where(F.slice("shingles", at + 1, size) == F.col("w"))
              .select("row", "k", "w", (F.col("first") + at).alias("start"),
                      (F.col("first") + at + size + F.col("k") - 1).alias("end")).distinct())
    places = stored(places, "bench-places")
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n_hit = (places.select("row", "start", "end").distinct()
             .withColumn("seen", before)
             .groupBy("row")
             .agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "seen"), F.lit(0))).alias("n_hit")))
    items = (places.select("row", "k", "w").distinct()
             .join(windows.where(F.col("item_id").isNotNull())
                   .select("k", F.col("shingles").alias("w"), "item_id").distinct(), ["k", "w"])
             .select("row", "item_id").distinct()
             .groupBy("row")
             .agg(F.count("*").alias("n_items"),
                  F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("items")))
    n_items = F.coalesce("n_items", F.lit(0))
    hit = F.coalesce("n_hit", F.lit(0))
    return (scanned.where(F.col("k").isNull()).select("row", "doc_id", "text_hash", "n_words")
            .join(n_hit, "row", "left").join(items, "row", "left")
            .select("row", "doc_id", "text_hash", "n_words", hit.alias("n_hit"),
                    n_items.alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                    ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated")))


def run(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(spark, docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
