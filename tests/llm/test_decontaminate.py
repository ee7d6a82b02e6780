from __future__ import annotations

import hashlib

import numpy as np

from martwright.llm import decontaminate
from tests.llm.conftest import EDGE, words


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[a:a + n]), set()).add(i)
    sizes = {len(g) for g in grams}
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (g := tuple(w[a:a + n])) in grams:
                    hit.update(range(a, a + n))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def cases(seed=6):
    rng = np.random.default_rng(seed)
    few = [f"v{i}" for i in range(6)]  # so few that shingles often agree by chance

    def text(n):
        return rng.choice(few, n).tolist()

    long, same = text(40), ["la"] * 30
    items = [(i, " ".join(text(int(rng.integers(10, 30))))) for i in range(20)]
    items += [(100, " ".join(long)), (101, " ".join(same)), (102, "just seven words in this short item"),
              (103, "three words only"), (104, "solo"), (105, ""), (106, None), (107, "!!!"), (107, "two items"),
              (None, "an item without any id at all it has thirteen words or more in it"),
              (100, " ".join(long)), (108, " ".join(long[10:30]))]
    docs = []
    for i in range(60):
        w = text(int(rng.integers(5, 80)))
        if i % 3 == 0:
            at = int(rng.integers(len(w)))
            source = [long, same, items[i % 20][1].split(), "just seven words in this short item".split(),
                      ["solo"], "three words only".split()][i % 6]
            a = int(rng.integers(0, max(len(source) - 13, 1)))
            w[at:at] = source[a:a + int(rng.integers(10, 40))]
        docs.append((i, " ".join(w)))
    docs += [(200, " ".join(same * 40)), (201, " ".join(long * 9)), (202, items[-4][1] if items[-4][1] else ""),
             (203, "An item WITHOUT any id at all; it has thirteen words, or more in it")]
    return docs, items


def test_hits_are_those_of_all_windows(spark):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumnRenamed("none", "x").repartition(3)
    got = sorted((tuple(r) for r in decontaminate.run(spark, d, b).collect()), key=repr)
    assert got == brute(docs, items)


def test_edge_rows(spark, edge, empty):
    items = [(1, "Hello world, this is fine."), (2, None), (3, ""), (4, "word " * 20)]
    b = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id bigint, text string, k int, row int")
    got = sorted((tuple(r) for r in decontaminate.run(spark, edge, b).collect()), key=repr)
    assert got == brute(EDGE, items)
    assert decontaminate.run(spark, empty, b).count() == 0
    none = decontaminate.run(spark, edge, b.where("false")).collect()
    assert len(none) == len(EDGE) and not any(r.contaminated or r.n_hit or r.n_items for r in none)


def test_map_grows_with_the_benchmark_and_a_full_one_loses_nothing(spark, monkeypatch):
    assert [decontaminate._map_bits(n) for n in (0, 1 << 19, (1 << 19) + 1, 8_000_000, 10 ** 12)] == [23, 23, 24, 27, 27]
    docs, items = cases(7)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    windows = decontaminate._windows(b)
    shingles = np.array([r.s for r in windows.where("k = 4").selectExpr("explode(shingles) s").distinct().collect()])
    for least, most in ((23, 27), (8, 8)):
        monkeypatch.setattr(decontaminate, "MAP_LEAST", least)
        monkeypatch.setattr(decontaminate, "MAP_MOST", most)
        m = decontaminate._bit_map(windows)[4]
        assert len(m) == 1 << (least - 3) and decontaminate._in_map(m, shingles.view(np.uint64)).all()
        bits = np.unique(shingles.view(np.uint64) >> np.uint64(64 - least))
        assert np.array_equal(np.flatnonzero(np.unpackbits(m, bitorder="little")), bits)
        got = sorted((tuple(r) for r in decontaminate.run(spark, d, b).collect()), key=repr)
        assert got == brute(docs, items)
