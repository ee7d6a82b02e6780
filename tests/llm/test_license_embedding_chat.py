from __future__ import annotations

import math

import numpy as np

from martwright.llm import chat_format, embedding_dup, license_scan
from tests.llm.conftest import EDGE, words

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute_base(text):
    w = words(text)
    found = [(a, label) for p, label in PHRASES.items() for a in range(len(w))
             if w[a:a + len(p.split())] == p.split()]
    starts = [a for a, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def test_base_places_of_odd_texts(spark, edge, empty):
    texts = [t for _, t in EDGE] + [
        "CC BY NC CC BY-NC cc by nc", "mit license under the", "under the MIT\nLicense " * 50,
        "Apache License, Version 2", "under the the mit license", "apache license version", "cc by",
        "cc", "under the mit license " + "word " * 30_000 + "cc-by-nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in license_scan.run(spark, docs).collect()}
    assert got == {i: brute_base(t) for i, t in enumerate(texts)}
    rows = license_scan.run(spark, edge).collect()
    assert sorted(((r.doc_id, r.n_words) for r in rows), key=repr) == sorted(((i, len(words(t))) for i, t in EDGE), key=repr)
    assert license_scan.run(spark, empty).count() == 0


def test_notices_with_words_put_in_and_left_out(spark):
    notice = list(license_scan.NOTICES)[0].split()
    changed = [*notice[:12], "very", "much", *notice[12:30], *notice[32:]]
    texts = ["before it all " + " ".join(changed) + " and after", " ".join(notice[:8]),
             " ".join(notice[:20]) + " word " * 500 + " ".join(notice[20:]), "plain words only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.run(spark, docs).collect()}
    assert got[0].labels == "mit" and 0.6 <= got[0].score < 1 and got[0].base_labels == ""
    assert got[1].labels == "" and got[3].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())


def brute_notices(text):
    """(labels, score) from every match of three words with a template, diagonal by diagonal."""
    w, labels, score = words(text), set(), 0.0
    grams = [tuple(w[p:p + 3]) for p in range(len(w) - 2)]
    for phrase, label in license_scan.NOTICES.items():
        t = words(phrase)
        n, limit, least = len(t) - 2, 1.5 * len(t), 1.0 if len(t) <= 20 else 0.6
        diagonals = {}
        for j in range(n):
            for p, g in enumerate(grams):
                if g == tuple(t[j:j + 3]):
                    diagonals.setdefault(p - j, []).append((p, j))
        islands, last = [], None
        for d in sorted(diagonals):
            if last is None or d - last > 6:
                islands.append([])
            islands[-1].append(diagonals[d])
            last = d
        for island in islands:
            spans = [(min(p for p, _ in v), max(p for p, _ in v) + 3, {j for _, j in v}) for v in island]
            cover = len(set().union(*(js for _, _, js in spans))) / n
            if max(b for _, b, _ in spans) - min(a for a, _, _ in spans) > limit:
                best = max(len(set().union(*(js for lo, b, js in spans if lo >= a and b - a <= limit)))
                           for a, _, _ in spans)
                cover = best / n if cover >= least else 0.0
            score = max(score, cover)
            if cover >= least:
                labels.add(label)
    _, n_base, _, _, base = brute_base(text)
    labels |= set(base.split(",")) - {""}
    return ",".join(sorted(labels)), max(score, 1.0 if n_base else 0.0)


def test_labels_and_score_are_those_of_all_diagonals(spark):
    rng = np.random.default_rng(6)
    notices = [words(t) for t in license_scan.NOTICES]
    texts = [" ".join(n) for n in notices]
    for _ in range(250):
        w = []
        for _ in range(rng.integers(1, 4)):
            n = list(notices[rng.integers(len(notices))])
            a, b = sorted(rng.integers(0, len(n) + 1, 2)) if rng.random() < 0.4 else (0, len(n))
            n = n[a:b]
            for _ in range(rng.integers(0, 8)):
                k = int(rng.integers(0, len(n) + 1))
                n[k:k + rng.integers(0, 5)] = ["put"] * rng.integers(0, 9)
            w += n * int(rng.integers(1, 3)) + ["word"] * int(rng.integers(0, 12))
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.run(spark, docs).collect()}
    want = {i: brute_notices(t) for i, t in enumerate(texts)}
    assert got == {i: (x, round(s, 9)) for i, (x, s) in want.items()}


def test_names_that_differ_by_a_word_get_their_own_labels(spark):
    texts = {"licensed under the GNU General Public License, version 2 or later": "gpl-2",
             "licensed under the GNU General Public License": "",
             "under the GNU Lesser General Public License, version 3": "lgpl",
             "licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
             "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
             "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "cc-by-nc-sa"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.labels for r in license_scan.run(spark, docs).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def brute_vectors(rows, cosine=0.98):
    unit = []
    for _, e, label in rows:
        ok = label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
        v = np.array(e, float) if ok else None
        unit.append(v / np.linalg.norm(v) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2]
                    and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine):
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, n[k], least.get(find(k))) for k, (i, _, _) in enumerate(rows)), key=repr)


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []

    def put(v, label):
        rows.append((len(rows), None if v is None else [float(np.float32(x)) for x in v], label))

    for label in (0, 1, 2):
        for _ in range(12):
            c = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 40))):
                put(c + rng.normal(size=16) * 0.07 * np.linalg.norm(c) / 4 * rng.choice([0.3, 1, 2]), label)
    same = rng.normal(size=16)
    for k in range(150):
        put(same, 1)
        put(same * 2, 1)
    for v in ([0.0] * 16, [1.0, float("nan"), *[0.0] * 14], [float("inf"), *[1.0] * 15], None, [], same[:8], same[:8]):
        put(v, 2)
    put(same, None)
    rows.append((40_000, [1.0, None, *[0.0] * 14], 1))
    rows.append((3, list(map(float, same)), 2))  # an id that repeats
    rows.append((None, list(map(float, same)), 2))
    return rows


def test_vector_links_are_those_of_all_pairs(spark, monkeypatch):
    rows = vectors()
    schema = "vec_id bigint, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema).withColumns({"id": chat_format.F.lit(1), "n": chat_format.F.lit(2)})
    # small cells and blocks, so that there are many of both, and a second level
    for name, value in (("CELL_POINTS", 40), ("CELL_LARGE", 60), ("CELLS_MOST", 3), ("COPIES_MOST", 50),
                        ("BLOCK_BYTES", 2048), ("CHUNK", 100)):
        monkeypatch.setattr(embedding_dup, name, value)
    placed, cells = [], embedding_dup.cells
    monkeypatch.setattr(embedding_dup, "cells", lambda *a: placed.append(cells(*a)) or placed[-1])
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embedding_dup.run(df).collect()), key=repr)
    assert got == brute_vectors(rows)
    paths = [tuple(r.path) for r in placed[0].select("path").distinct().collect()]
    assert len({p[0] for p in paths}) > 1 and any(len(p) > 1 and p[-1] > 0 for p in paths)
    assert embedding_dup.run(df.where("false")).count() == 0


def test_a_tight_cluster_is_not_split_and_spread_points_are():
    rng = np.random.default_rng(5)
    tight = embedding_dup.unit(np.ones((500, 8)) + rng.normal(size=(500, 8)) * 0.01)
    assert embedding_dup.split_by(tight, 8) is None
    centres = embedding_dup.unit(rng.normal(size=(8, 32)))
    spread = embedding_dup.unit(np.repeat(centres, 60, axis=0) + rng.normal(size=(480, 32)) * 0.01)
    assert len(embedding_dup.split_by(spread, 8)) == 8


def test_guests_meet_every_linked_point_of_other_cells():
    rng = np.random.default_rng(4)
    x = embedding_dup.unit(rng.normal(size=(300, 8)))
    x = np.concatenate([x, embedding_dup.unit(x + rng.normal(size=x.shape) * 0.05)])
    home, guest = embedding_dup.cells_of(x, embedding_dup.kmeans(x, 20))
    a, b = np.nonzero(x @ x.T >= 0.98)
    assert (home[a] != home[b]).any()
    assert ((home[a] == home[b]) | guest[a, home[b]] | guest[b, home[a]]).all()


def brute_chats(rows):
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    out = []
    for c, v in convs.items():
        same = [k for k in convs if convs[k] == v]
        first = min(same, key=lambda k: (k is None, k or 0))
        longer = any(len(w) > len(v) and w[:len(v)] == v for w in convs.values())
        if c == first and not longer:
            out.append((c, len(v), len(same), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, r, _, t in v)))
    return sorted(out, key=repr)


def chats():
    rows = []
    full = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(9)]
    for conv, n in enumerate((3, 9, 5, 9, 1, 9)):
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(full[:n])]
    rows += [(10, 0, "user", "other"), (10, 1, None, None), (11, 0, "user", "other"), (11, 1, None, ""),
             (12, None, "user", "other"), (12, 1, None, None), (12, 2, "user", "more"),
             (13, 5, "a", "x"), (13, 5, "a", "x"), (13, 5, None, "y"), (14, 5, "a", "x"),
             (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (0, 0, "user", "clash")]
    rows += [(20, i, "user", f"t{i}") for i in range(1300)] + [(21, i, "user", f"t{i}") for i in range(700)]
    rows += [(22, -i, "user", f"t{i}") for i in range(600)]
    return rows


def test_chats_collapse_and_render(spark):
    rows = chats()
    df = (spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
          .withColumns({"pos": chat_format.F.lit(1), "h1": chat_format.F.lit(2)}).repartition(5))
    parts = {}
    for r in chat_format.run(df).collect():
        parts.setdefault((r.conv_id, r.n_turns, r.n_copies), {})[r.part] = r.text
    got = sorted(((*k, "".join(v[p] for p in sorted(v))) for k, v in parts.items()), key=repr)
    assert got == brute_chats(rows)
    assert max(len(v) for v in parts.values()) == 3
    assert chat_format.run(df.where("false")).count() == 0
    plan = chat_format.run(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_a_conversation_with_a_third_of_all_rows_is_numbered_in_stretches(spark):
    """Null ids are one conversation; many of its rows share a turn, and its turns are few."""
    rows = [(None, i % 3, "user" if i % 2 else None, f"text {i % 900}") for i in range(3000)]
    rows += [(i, t, "user", f"t {i % 50} {t}") for i in range(2000) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(6)
    turns = chat_format.numbered(df)
    got = turns.where("not has_id").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 3001))
    want = sorted(((t, r is not None, r or "", x) for c, t, r, x in rows if c is None))
    assert [(r.role or "", r.text) for r in got] == [(r, x) for _, _, r, x in want]
    parts = chat_format.run(df).where("conv_id IS NULL").orderBy("part").collect()
    assert [p.part for p in parts] == list(range(6)) and {p.n_turns for p in parts} == {3000}
    plan = turns._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "stretch" in plan[plan.index("Window"):][:600]


def test_a_notice_with_its_own_words_repeated_behind_it_is_found(spark):
    """Neighbouring diagonals chain into one long island: its best stretch is the notice."""
    notice = list(license_scan.NOTICES)[0]
    tail = " ".join(notice.split()[-4:])
    docs = spark.createDataFrame([
        (0, notice), (1, f"{notice} {(tail + ' ') * 60}"), (2, f"{(tail + ' ') * 60} {notice}"),
        (3, (tail + " ") * 200), (4, f"{(tail + ' ') * 60} {notice} {(tail + ' ') * 60}")], "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.run(spark, docs).collect()}
    assert [got[i] for i in (0, 1, 2, 4)] == [("mit", 1.0)] * 4
    assert got[3][0] == "" and got[3][1] < license_scan.COVER_LEAST
