"""Toxicity by a factorization machine over hashed terms (operator 7).

A text is the set of its words, hashed to ``2 ** BITS`` terms. The score is the logistic
of a bias, a weight for each term and, for each pair of terms, the product of their learned
factor vectors: a pair can count for more than its two words, which additive weights can't
express. Pairs are summed in linear time by the usual square-of-sum identity.

The machine is trained in numpy, in one task, on a bounded sample of labelled rows: about ``FIT_ROWS``
of either label, chosen by a hash of their id and weighted halfway between the classes'
true shares and equal ones. Terms of fewer than ``LEAST`` rows of the sample carry no weight.

Nulls and edge cases: a null or empty text has no terms and gets the bias alone; null labels
are not learned from, and a document with contradicting labels counts once for each; without
any label every score is 0; a null id is never held out; repeated rows are scored each for
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import crc_mod, map_arrow, stored, text_hash, text_slices
from martwright.llm.words import words

BITS = 18
FACTORS = 4
FIT_ROWS = 6000
LEAST = 3
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.8, 2e-5
LEAST_STEPS = 600  # a small sample is gone through more often
# Pairs weigh less in long texts, where they are many.
PAIR_SCALE = 0.25


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of each text, ascending, and offsets by text."""
    spans, h = words(data, offsets)
    n = np.diff(spans.rows)
    key = (np.repeat(np.arange(len(n)), n) << BITS) | (h >> np.uint64(64 - BITS)).astype(np.int64)
    key = np.unique(key)
    return key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(len(n) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the rows of values between offsets."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=float)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def logits(m: Machine, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    v = m.factors[flat]
    scale = PAIR_SCALE / np.sqrt(np.maximum(np.diff(offsets), 1))
    pairs = 0.5 * (_sums(v, offsets) ** 2 - _sums(v * v, offsets)).sum(axis=1)
    return m.bias + _sums(m.weights[flat], offsets) + scale * pairs


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(flat: np.ndarray, offsets: np.ndarray, label: np.ndarray, weight: np.ndarray,
          seed: int = 3, epochs: int = EPOCHS) -> Machine:
    """AdaGrad on the weighted log-loss."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    n = np.diff(offsets)
    often = np.bincount(flat, minlength=size) >= LEAST
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // max(len(n), 1)))
    doc = np.repeat(np.arange(len(n)), n)[often[flat]]
    flat = flat[often[flat]]
    offsets = np.searchsorted(doc, np.arange(len(n) + 1))
    w = np.zeros(size)
    v = np.where(often[:, None], rng.normal(0, 0.02, (size, FACTORS)), 0.0)
    share = float(np.average(label, weights=weight))
    bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    gw, gv, gb = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(n))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            part = np.concatenate([flat[offsets[i]:offsets[i + 1]] for i in pick])
            count = offsets[pick + 1] - offsets[pick]
            off = np.concatenate([[0], np.cumsum(count)])
            d = (sigmoid(logits(Machine(bias, w, v), part, off)) - label[pick]) * weight[pick] / len(pick)
            gb += d.sum() ** 2
            bias -= RATE * d.sum() / np.sqrt(gb)
            if not len(part):
                continue
            used, at = np.unique(part, return_inverse=True)
            each = np.repeat(d, count)
            step = np.bincount(at, each, len(used)) + DECAY * w[used]
            gw[used] += step ** 2
            w[used] -= RATE * step / np.sqrt(gw[used])
            mine = v[part]
            scaled = each * np.repeat(PAIR_SCALE / np.sqrt(np.maximum(count, 1)), count)
            pull = scaled[:, None] * (np.repeat(_sums(mine, off), count, axis=0) - mine)
            for f in range(FACTORS):
                step = np.bincount(at, pull[:, f], len(used)) + DECAY * v[used, f]
                gv[used, f] += step ** 2
                v[used, f] -= 0.2 * RATE * step / np.sqrt(gv[used, f])
    return Machine(bias, w.astype(np.float32), v.astype(np.float32))


def _with_terms(rows: DataFrame) -> DataFrame:
    """(label, terms) of labelled texts."""

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                flat, cuts = terms(data, offsets)
                yield pa.record_batch([
                    batch.column("doc_id").slice(row, end - row),
                    batch.column("label").slice(row, end - row),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                             pa.array(flat.astype(np.int32)))],
                    names=["doc_id", "label", "terms"])

    return map_arrow(rows.select("doc_id", "text", "label"), task,
                     "doc_id bigint, label int, terms array<int>")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine | None:
    """Train on a sample of labelled rows outside the held-out fold; None if there are none.

    About ``fit_rows`` ids of each label are chosen by a hash, then as many of their distinct
    (id, text) rows at most, by another: an id that repeats over many rows brings no more.
    """
    known = (labels.where((crc_mod(F.col("doc_id"), 5) != 0) & F.col("toxic").isin(0, 1))
             .select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.col("toxic").cast("int").alias("label")).distinct())
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    most = 1 << 30
    limit = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(most, most * fit_rows // n))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(most)) < limit[F.col("label")])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id")  # about 2 * fit_rows ids
    # distinct rows of the chosen ids: hash aggregation on the keys alone, then one text of each
    keyed = rows.withColumn("hash", text_hash(F.col("text")))
    each = stored(keyed.select("doc_id", "label", "hash").distinct(), "toxicity-rows")
    have = {r[0]: r[1] for r in each.groupBy("label").count().collect()}
    part = F.create_map(*[F.lit(x) for k, n in have.items() for x in (k, min(most, most * fit_rows // n))]) if have else None
    if part is not None:
        each = each.where(F.pmod(F.xxhash64("doc_id", "hash", F.lit(6)), F.lit(most)) < part[F.col("label")])
    rows = (keyed.join(F.broadcast(each), ["doc_id", "label", "hash"])  # about 2 * fit_rows rows at most
            .groupBy("doc_id", "label", "hash").agg(F.first("text").alias("text")))
    share = (0.5 + counts[1] / (counts[0] + counts[1])) / 2
    return _trained(_with_terms(rows), share)


_MACHINE = pa.schema([("bias", pa.float64()), ("weights", pa.binary()), ("factors", pa.binary())])


def _trained(rows: DataFrame, share: float) -> Machine | None:
    """The machine of the (bounded) sample, trained in a task: the driver gets its weights alone."""

    def task(got: pa.Table) -> pa.Table:
        got = got.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        label = got.column("label").to_numpy().astype(float)
        if len(set(label.tolist())) < 2:
            return _MACHINE.empty_table()
        lists = got.column("terms").combine_chunks()
        flat = np.asarray(lists.flatten()).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        m = train(flat, offsets, label, np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean())))
        return pa.table([[m.bias], [m.weights.tobytes()], [m.factors.tobytes()]], schema=_MACHINE)

    found = rows.groupBy(F.lit(0).alias("all")).applyInArrow(
        task, "bias double, weights binary, factors binary").collect()
    if not found:
        return None
    weights, factors = (np.frombuffer(bytes(x), np.float32) for x in (found[0]["weights"], found[0]["factors"]))
    return Machine(found[0]["bias"], weights, factors.reshape(-1, FACTORS))


def score(docs: DataFrame, m: Machine | None, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the score of each row."""
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:len(keep)])

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch, "__text"):
                p = (np.zeros(end - row) if m is None
                     else sigmoid(logits(m, *terms(data, offsets))))
                yield pa.record_batch(
                    [*batch.slice(row, end - row).columns[:len(keep)], pa.array(p, pa.float64())],
                    names=[*keep, "score"])

    return map_arrow(rows, task, f"{schema}, score double")


def run(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
