from __future__ import annotations

from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from martwright.llm import near_dup
from martwright.llm.common import scratch, stored
from martwright.llm.components import components
from martwright.session import ensure_checkpoint_dir
from tests.llm.conftest import words


def brute_classes(rows, similarity=0.8):
    """Class of each row by comparing all pairs of texts."""
    bags = []
    for _, t in rows:
        w = words(t)
        bags.append(Counter(tuple(w[a:a + 5]) for a in range(max(len(w) - 4, 1))) if w else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bags[a] and bags[b]:
                same = sum((bags[a] & bags[b]).values())
                if same >= similarity * (sum(bags[a].values()) + sum(bags[b].values()) - same):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, least.get(find(k)) if bags[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def corpus(seed=5):
    """A star of near copies that are alike only through their base, a tight group, a chain, and noise."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(5000)]

    def text(n):
        return rng.choice(vocabulary, n).tolist()

    rows, n = [], 0

    def put(w):
        nonlocal n
        rows.append((n, " ".join(w)))
        n += 1

    base = text(300)
    put(base)
    for k in range(60):  # each has words of its own changed: alike with the base, hardly with one another
        w = list(base)
        for p in rng.choice(300, 6, replace=False):
            w[p] = f"star{k}-{p}".replace("-", "x")
        put(w)
    tight = text(400)
    for k in range(80):
        put([*tight, f"end{k}"])
    link = text(200)
    for _ in range(12):  # a chain: ends are unlike
        put(link)
        link = [*link[6:], *text(6)]
    shared = text(100)
    for _ in range(60):  # share a passage, but are unlike
        put([*shared, *text(150)])
    for _ in range(40):
        put(text(int(rng.integers(1, 80))))
    put(base)
    return rows


def test_classes_of_groups_are_those_of_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = sorted(((r.doc_id, r.class_id) for r in near_dup.run(docs).collect()), key=repr)
    assert got == brute_classes(rows)


def test_edge_rows(spark, edge, empty):
    from tests.llm.conftest import EDGE
    got = near_dup.run(edge).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute_classes(EDGE)
    assert near_dup.run(empty).count() == 0
    # of equal rows one is kept; texts without words are classes of their own
    kept = [r.doc_id for r in got if r.kept]
    assert all(r.doc_id == r.class_id for r in got if r.kept and r.doc_id is not None)
    assert kept.count(1) == 1 and all(kept.count(i) == 1 for i in (3, 4, 5, 6, 7, 8, 9))


def test_one_of_many_equal_rows_is_kept(spark):
    rows = [(1, "the same words in every one of these rows here")] * 400 + [(None, "a row of its own and of no id at all")] * 50
    got = near_dup.run(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)).collect()
    assert len(got) == 450
    assert sorted((r.doc_id for r in got if r.kept), key=repr) == [1, None]


def near_copies():
    """Three classes: without ids, under one repeated id, and both with a smaller id among them."""
    rng = np.random.default_rng(9)
    rows = []
    for first, ids in ((0, [None] * 8), (1, [70] * 8), (2, [None, None, None, 80, 80, 80, 90, 90])):
        w = [f"v{first}x{k}" for k in rng.integers(0, 1000, 300)]
        copies = [" ".join(w), " ".join(w).upper(), "  ".join(w)] + [" ".join([*w, f"end{k}"]) for k in range(5)]
        rows += list(zip(ids, copies, strict=True))
    return rows + rows[::3]  # and exact repeats


def test_one_text_of_each_class_is_kept(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = near_dup.classes(docs).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute_classes(rows)
    kept = {(r.doc_id, r.text_hash) for r in got if r.kept}
    assert sorted((i for i, _ in kept), key=repr) == [70, 80, None]


@pytest.mark.parametrize("weights", [[1, 1, 1, 1, 1, 1], [3, 1, 0.5, 7.25, 2, 40]])
def test_signatures_agree_as_often_as_the_similarity_says(weights):
    rng = np.random.default_rng(1)
    n, t = 400, near_dup.COORDINATES
    agree = []
    want = None
    for _ in range(60):
        e = rng.integers(1, 1 << 62, n).astype(np.uint64)
        w = np.resize(np.array(weights, float), n)
        other = w * rng.choice([1.0, 1.0, 0.4], n)
        same = np.minimum(w, other).sum() / np.maximum(w, other).sum()
        doc = np.repeat([0, 1], n)
        s = near_dup.darts(doc, np.concatenate([e, e]), np.concatenate([w, other]), 2)
        agree.append((s[0] == s[1]).mean() - same)
        want = same
    assert 0.5 < want < 1
    assert abs(np.mean(agree)) < 4 * np.sqrt(0.25 / (60 * t))


def test_components_of_a_shuffled_path_and_a_star(spark):
    rng = np.random.default_rng(2)
    order = rng.permutation(300).tolist()
    pairs = list(zip(order, order[1:], strict=False)) + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    got = components(spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "a bigint, b bigint"))
    found = {r.id: r.component for r in got.collect()}
    assert found == {i: 0 for i in range(300)} | {1000 + k: 1000 for k in range(200)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_only_tables_that_the_result_reads_are_left(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(4)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = near_dup.classes(docs)
    left = sorted(p.name.split("-")[2] for p in set(folder.iterdir()) - before)
    assert left == ["class", "signatures"]
    assert sorted(((r.doc_id, r.class_id) for r in out.collect()), key=repr) == brute_classes(corpus())


def test_scratch_tables_go_with_their_block(spark):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            stored(spark.range(3), "a")
            b, c = stored(spark.range(4), "b"), stored(spark.range(5), "c")
            inner += [b, c]
        outer.append(c)
        assert b.count() == 4 and len(set(folder.iterdir()) - before) == 2
    assert c.count() == 5 and len(set(folder.iterdir()) - before) == 1
    now = set(folder.iterdir())
    with pytest.raises(ValueError), scratch(spark) as keep:
        keep.append(stored(spark.range(3), "d"))
        raise ValueError
    assert set(folder.iterdir()) == now
