from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martwright.llm import language_id, toxicity
from martwright.llm.common import table, text_slices
from tests.llm.conftest import EDGE
from tests.llm.conftest import words as plain_words

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_language_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.run(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean(held) >= 0.97


def test_language_of_edge_rows(spark, edge, empty):
    docs = edge.withColumn("lang", edge["lang"])
    got = language_id.run(docs).collect()
    assert len(got) == len(EDGE)
    letters = {i: any(c.isalpha() for c in t or "") for i, t in EDGE}
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"} and not letters[5]
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got)
    assert language_id.run(empty).count() == 0
    # nothing to learn from
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.run(unknown).collect()} == {"und"}


def test_language_of_one_row_with_many_copies(spark):
    """The sample is a share of the distinct rows: copies neither fill nor empty it."""
    docs = spark.createDataFrame([(1, "der kleine Hund läuft", "de")] * 3000 + [(4, "le petit chien court", "fr")] * 3000,
                                 "doc_id bigint, text string, lang string").withColumn("source", F.lit("s"))
    net = language_id.fit(docs, F.lit(True), fit_docs=5)
    assert net.languages == ["de", "fr"]
    rows = language_id.predict(docs.distinct(), net, ["doc_id"]).collect()
    assert sorted((r.doc_id, r.lang_pred, r.n_bytes) for r in rows) == [(1, "de", 22), (4, "fr", 20)]
    assert all(r.score > 0.9 and r.window_score >= r.score - 1e-6 for r in rows)


def test_windows_cover_whole_texts():
    texts = [b"", b"x", bytes(range(1, 200)) * 5]
    windows, doc, weight = language_id._text_windows(texts)
    for i, t in enumerate(texts):
        assert windows[doc == i].tobytes().rstrip(b"\0") == t
        assert weight[doc == i].sum() == max(len(t), 1)


def test_toxicity_finds_learned_insults_in_new_texts(spark):
    rng = np.random.default_rng(0)
    bad = ["loser", "idiot", "scum", "moron"]
    plain = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        w = rng.choice(plain, 60).tolist()
        if toxic:
            for b in rng.choice(bad, 2, replace=False):
                w.insert(int(rng.integers(60)), b)
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    x = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.run(d, x).collect()}
    held = [i for i in got if fold(i, 5) == 0]
    assert all(got[i].held_out == (fold(i, 5) == 0) for i in got)
    assert np.mean([got[i].predicted == labels[i][1] for i in held]) >= 0.97


def test_pairs_of_terms_are_learned():
    """Toxic only if both words are there: no additive weights can do that with this bias."""
    rng = np.random.default_rng(1)
    texts, y = [], []
    for _ in range(2000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(rng.permutation([f"n{rng.integers(20)}", "aa" if a else "a0", "bb" if b else "b0"])))
        y.append(float(a != b))
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    (_, _, data, offsets), = text_slices(batch)
    flat, cuts = toxicity.terms(data, offsets)
    m = toxicity.train(flat, cuts, np.array(y), np.ones(len(y)), epochs=120)
    right = ((toxicity.logits(m, flat, cuts) > 0) == (np.array(y) > 0.5)).mean()
    assert right > 0.95


def test_rare_insult_is_learned_from_a_large_sample():
    rng = np.random.default_rng(3)
    rare, common = range(0, 12_000, 1200), range(1, 12_000, 4)
    texts = [" ".join(f"n{k}" for k in rng.integers(0, 400, 12)) for _ in range(12_000)]
    y = np.zeros(len(texts))
    for word, rows in (("rareinsult", rare), ("insult", common)):
        for i in rows:
            texts[i], y[i] = f"{texts[i]} {word}", 1.0
    new = ["n1 n2 n3 rareinsult", "n1 n2 n3"]
    cuts = []
    for t in (texts, new):
        (_, _, data, offsets), = text_slices(pa.record_batch({"text": pa.array(t, pa.string())}))
        cuts.append(toxicity.terms(data, offsets))
    m = toxicity.train(*cuts[0], y, np.ones(len(y)))
    insulting, plain = toxicity.sigmoid(toxicity.logits(m, *cuts[1]))
    assert insulting >= 0.5 > plain


def test_logits_are_the_plain_sum_over_pairs():
    rng = np.random.default_rng(2)
    size = 1 << toxicity.BITS
    m = toxicity.Machine(-1.0, rng.normal(size=size), rng.normal(size=(size, toxicity.FACTORS)))
    texts = ["one two three two", "", "solo", "a b c d e"]
    (_, _, data, offsets), = text_slices(pa.record_batch({"text": pa.array(texts)}))
    flat, cuts = toxicity.terms(data, offsets)
    got = toxicity.logits(m, flat, cuts)
    for i, t in enumerate(texts):
        f = flat[cuts[i]:cuts[i + 1]]
        assert len(f) == len(set(plain_words(t)))
        pairs = sum(m.factors[p] @ m.factors[q] for k, p in enumerate(f) for q in f[:k])
        want = m.bias + m.weights[f].sum() + toxicity.PAIR_SCALE / np.sqrt(max(len(f), 1)) * pairs
        assert got[i] == pytest.approx(want)


def test_toxicity_of_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 0, 5), (2, 1, 5), (2, 0, 5), (6, 1, 5), (8, None, 5), (None, 1, 5), (7, 0, 5)],
                                   "doc_id bigint, toxic int, text int")
    got = toxicity.run(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.score for r in toxicity.run(edge, labels.where("false")).collect()} == {0.0}
    assert toxicity.run(empty, labels).count() == 0


def test_forward_is_a_plain_convolution():
    rng = np.random.default_rng(6)
    d, f, classes = language_id.DIM, language_id.FILTERS, 3
    net = language_id.Network(
        [str(i) for i in range(classes)], rng.normal(size=(256, d)),
        [rng.normal(size=(w * d, f)) for w in language_id.WIDTHS],
        rng.normal(size=(f * len(language_id.WIDTHS), classes)), rng.normal(size=classes))
    windows = rng.integers(0, 256, (5, 40)).astype(np.uint8)
    got = language_id.forward(net, windows)
    for row, logs in zip(windows, got, strict=True):
        x = net.embed[row]
        top = []
        for w, k in zip(language_id.WIDTHS, net.convs, strict=True):
            places = [x[i:i + w].reshape(-1) @ k for i in range(len(row) - w + 1)]
            top.append(np.maximum(np.max(places, axis=0), 0))
        z = np.concatenate(top) @ net.dense + net.bias
        assert logs == pytest.approx(z - np.log(np.exp(z - z.max()).sum()) - z.max(), rel=1e-4, abs=1e-4)


def test_an_id_with_many_rows_brings_a_bounded_sample(spark, monkeypatch):
    """A labelled id that holds most of the rows, equal ones and others, stays within the bound."""
    seen = []
    rows = [(0, f"text number {i} of the hot id with words w{i}") for i in range(1500)] + [(0, "the same row")] * 1500
    rows += [(i, f"some other text w{i}") for i in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    # the hot id must lie in the training folds
    at = next(i for i in range(1000, 2000) if fold(i, 5) != 0 and fold(i, 4) != 2)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") == 0, at).otherwise(F.col("doc_id")))
    labels = labels.unionByName(spark.createDataFrame([(at, 1)], "doc_id bigint, toxic int"))
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda flat, offsets, *a: seen.append(len(offsets) - 1) or train(flat, offsets, *a))
    toxicity.fit(docs, labels, fit_rows=200)
    assert seen and seen[0] < 2 * 200 * 1.4
    windows = []
    monkeypatch.setattr(language_id, "train", lambda w, *a: windows.append(len(w)))
    language_id.fit(docs, language_id.training_fold(F.col("doc_id")), fit_docs=100)
    assert windows and windows[0] <= 100 * language_id.FIT_WINDOWS * 1.6


def test_toxicity_is_trained_away_from_the_driver(spark, monkeypatch):
    """The driver gets the weights, never the sample's terms; they are those of the plain training."""
    rows = [(i, f"word{i % 7} you {'idiot' if i % 3 == 0 else 'friend'} and text {i % 11}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    monkeypatch.setattr(type(docs), "toArrow", lambda self: pytest.fail("rows reach the driver"))
    m = toxicity.fit(docs, labels)
    known = [(i, t.encode()) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    flat, cuts = toxicity.terms(np.frombuffer(b"".join(t for _, t in known), np.uint8),
                                np.cumsum([0] + [len(t) for _, t in known]))
    y = np.array([float(i % 3 == 0) for i, _ in known])
    share = (0.5 + y.mean()) / 2
    want = toxicity.train(flat, cuts, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())))
    assert abs(m.bias - want.bias) < 1e-9 and np.array_equal(m.weights, want.weights) and np.array_equal(m.factors, want.factors)
