"""Language identification by a byte convolutional network (operator 8).

Filters of several widths run over the embedded UTF-8 bytes of fixed-length windows; the
strongest answer of each filter over the window goes into a softmax over the languages.
A text is cut into consecutive windows, all of which are scored; the prediction is the
language of the highest mean log-probability, weighted by the windows' bytes.

The network is trained in numpy on a bounded sample: about ``FIT_DOCS`` documents of each
language, chosen by a hash of their id over the whole table, ``FIT_WINDOWS`` windows of each.

Nulls and edge cases: a text that is null or has no letter gets ``und`` and score 0, as does
every text if there is nothing to learn from; rows with a null or repeated id are scored
each for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import count, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import crc_mod, map_arrow, text_slices

WINDOW = 192
FIT_DOCS = 500
FIT_WINDOWS = 3
DIM, FILTERS, WIDTHS = 8, 16, (2, 3, 4)
STEPS, BATCH, RATE = 188, 64, 4e-3  # steps for each language, however large the sample
UNKNOWN = "und"


class Network(NamedTuple):
    languages: list[str]
    embed: np.ndarray
    convs: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray


def _columns(x: np.ndarray, width: int) -> np.ndarray:
    """(windows, positions, width * DIM): each position's neighbourhood."""
    n = x.shape[1] - width + 1
    return np.concatenate([x[:, j:j + n] for j in range(width)], axis=2)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def forward(net: Network, windows: np.ndarray) -> np.ndarray:
    """Log-probabilities of each window (rows of bytes, zero beyond the text).

    Filters run along the bytes of all windows at once, filter by filter in memory; the
    places that reach into the next window are left out of the maxima.
    """
    n, length = windows.shape
    x = np.take(np.ascontiguousarray(net.embed.T), windows.reshape(-1), axis=1)
    pooled = []
    for width, k in zip(WIDTHS, net.convs, strict=True):
        out = k[:DIM].T @ x
        for j in range(1, width):
            out[:, :-j] += (k[j * DIM:(j + 1) * DIM].T @ x)[:, j:]
        top = out.reshape(FILTERS, n, length)[:, :, :length - width + 1].max(axis=2)
        pooled.append(np.maximum(top, 0))
    return log_softmax(np.concatenate(pooled).T @ net.dense + net.bias)


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 7,
          steps: int = STEPS) -> Network:
    """Adam on the cross-entropy; byte 0 stands for no byte and keeps a zero embedding.

    ``steps`` batches for each language are taken from one shuffling of the windows after another.
    """
    rng = np.random.default_rng(seed)
    f4 = np.float32
    pars = [rng.normal(0, 0.5, (256, DIM)).astype(f4)]
    pars += [rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(f4) for w in WIDTHS]
    pars += [rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(f4),
             np.zeros(len(languages), f4)]
    pars[0][0] = 0
    first, second = [np.zeros_like(p) for p in pars], [np.zeros_like(p) for p in pars]
    shuffled = (part for _ in count() for order in [rng.permutation(len(windows))]
                for part in np.split(order, range(BATCH, len(order), BATCH)))
    for step, pick in enumerate(islice(shuffled, steps * len(languages)), 1):
        b, y = windows[pick], target[pick]
        embed, convs, dense, bias = pars[0], pars[1:-2], pars[-2], pars[-1]
        x = embed[b]
        cols = [_columns(x, w) for w in WIDTHS]
        outs = [c @ k for c, k in zip(cols, convs, strict=True)]
        best = [o.argmax(axis=1) for o in outs]
        top = np.concatenate([o.max(axis=1) for o in outs], axis=1)
        pooled = np.maximum(top, 0)
        g = np.exp(log_softmax(pooled @ dense + bias))
        g[np.arange(len(b)), y] -= 1
        g /= len(b)
        d_pool = (g @ dense.T) * (top > 0)
        d_embed = np.zeros_like(embed)
        d_convs = []
        rows = np.arange(len(b))[:, None]
        for i, w in enumerate(WIDTHS):
            d = d_pool[:, i * FILTERS:(i + 1) * FILTERS]
            at = cols[i][rows, best[i]]  # window, filter, w * DIM
            d_convs.append(np.einsum("nfk,nf->kf", at, d))
            back = np.einsum("kf,nf->nfk", convs[i], d).reshape(-1, DIM)
            where = b[rows[:, :, None], best[i][:, :, None] + np.arange(w)].reshape(-1)
            for c in range(DIM):
                d_embed[:, c] += np.bincount(where, back[:, c], 256)
        d_embed[0] = 0
        for p, d, m, v in zip(pars, [d_embed, *d_convs, pooled.T @ g, g.sum(axis=0)],
                              first, second, strict=True):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, pars[0], list(pars[1:-2]), pars[-2], pars[-1])


def _window(text: str) -> np.ndarray:
    raw = text.lower().encode()[:WINDOW]
    return np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8)


def fit(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang",
        fit_docs: int = FIT_DOCS) -> Network | None:
    """Train on a sample of the rows where ``training`` holds; None if there are none.

    The sample has about ``fit_docs`` distinct (id, text) rows of each language, by a hash.
    """
    rows = docs.where(training & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    # by id and text, so that the rows of an id are chosen one by one
    hashed = rows.withColumn("__hash", F.xxhash64("doc_id", F.col(text), F.lit(17)))
    # of distinct rows, so that a row of many copies doesn't crowd out all others
    counts = {r[0]: r[1] for r in hashed.groupBy(lang).agg(
        F.greatest(F.approx_count_distinct("__hash"), F.lit(1))).collect()}  # a row for each language
    if not counts:
        return None
    most = 1 << 30
    limit = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(most, most * fit_docs // n))])
    chosen = hashed.where(F.pmod("__hash", F.lit(most)) < limit[F.col(lang)])
    span = F.greatest(F.length(text) - F.lit(WINDOW), F.lit(0)) + 1
    # equal rows have equal windows: they are one row of the sample
    cuts = chosen.select(lang, "__hash", F.array(*[
        F.substring(F.col(text), (1 + F.pmod(F.xxhash64("__hash", F.lit(i)), span)).cast("int"),
                    F.lit(WINDOW)) for i in range(FIT_WINDOWS)]).alias("__cuts")).distinct().select(
        lang, F.explode("__cuts").alias("cut")).collect()
    languages = sorted(counts)
    pairs = sorted((r["cut"], languages.index(r[lang])) for r in cuts)
    # every third window is a short one, so that short texts are known as well
    short = [t[:12 + 11 * (i % 7)] if i % 3 == 0 else t for i, (t, _) in enumerate(pairs)]
    return train(np.stack([_window(t) for t in short]), np.array([y for _, y in pairs]), languages)


def _text_windows(low: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, the text of each, bytes of each) of whole texts; an empty text has one."""
    n = np.array([len(x) for x in low])
    per = np.maximum(-(-n // WINDOW), 1)
    flat = np.zeros(per.sum() * WINDOW, np.uint8)
    at = 0
    for x, k in zip(low, per.tolist(), strict=True):
        flat[at:at + len(x)] = np.frombuffer(x, np.uint8)
        at += k * WINDOW
    doc = np.repeat(np.arange(len(low)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    return flat.reshape(-1, WINDOW), doc, np.clip(n[doc] - nth * WINDOW, 1, WINDOW)


def predict_texts(net: Network, texts: list[bytes],
                  chunk: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, probability, the best probability of a window) of lower-cased texts."""
    windows, doc, weight = _text_windows(texts)
    total = np.zeros((len(texts), len(net.languages)))
    clear = np.full(len(texts), -np.inf)
    for a in range(0, len(windows), chunk):
        logs = forward(net, windows[a:a + chunk])
        np.maximum.at(clear, doc[a:a + chunk], logs.max(axis=1))
        logs = logs * weight[a:a + chunk, None]
        for c in range(logs.shape[1]):
            total[:, c] += np.bincount(doc[a:a + chunk], logs[:, c], len(texts))
    p = np.exp(log_softmax(total / np.bincount(doc, weight, len(texts))[:, None]))
    return p.argmax(axis=1), p.max(axis=1), np.exp(clear)


def predict(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """The columns of ``keep``, lang_pred, score, window_score and n_bytes for each row.

    ``window_score`` is the highest probability that a window of the text gives a language: in
    a text of several languages it is high where ``score`` is not. ``n_bytes`` is the length
    of the lower-cased text, 0 without a letter.
    """
    # names of other columns can't clash: what the task needs is renamed
    rows = docs.select(*[F.col(c) for c in keep],
                       F.col("text").alias("__text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:len(keep)])

    def task(batches):
        for batch in batches:
            for row, end, data, offsets in text_slices(batch, "__text", 1 << 20):
                part = batch.slice(row, end - row)
                letters = np.asarray(part.column("__letters").to_numpy(zero_copy_only=False), bool)
                if net is None:
                    names, score = [UNKNOWN] * (end - row), np.zeros(end - row)
                    clear, size = score, np.zeros(end - row, np.int64)
                else:
                    raw = data.tobytes()
                    low = [raw[a:b].lower() if m else b"" for a, b, m in
                           zip(offsets[:-1].tolist(), offsets[1:].tolist(), letters, strict=True)]
                    # only texts beyond ASCII need more than the bytes' own lower case
                    low = [x if x.isascii() else x.decode("utf-8", "replace").lower().encode()
                           for x in low]
                    best, p, clear = predict_texts(net, low)
                    clear, size = np.where(letters, clear, 0.0), np.array([len(x) for x in low])
                    names = [net.languages[i] if m else UNKNOWN
                             for i, m in zip(best.tolist(), letters, strict=True)]
                    score = np.where(letters, p, 0.0)
                yield pa.record_batch([*part.columns[:len(keep)], pa.array(names, pa.string()),
                                       pa.array(score, pa.float64()), pa.array(clear, pa.float64()),
                                       pa.array(size, pa.int64())],
                                      names=[*keep, "lang_pred", "score", "window_score", "n_bytes"])

    return map_arrow(rows, task, f"{schema}, lang_pred string, score double, window_score double, n_bytes bigint")


def training_fold(doc_id: Column) -> Column:
    return crc_mod(doc_id, 4) != 2


def run(docs: DataFrame) -> DataFrame:
    net = fit(docs, F.coalesce(training_fold(F.col("doc_id")), F.lit(False)))
    return predict(docs, net, ["doc_id"]).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")
