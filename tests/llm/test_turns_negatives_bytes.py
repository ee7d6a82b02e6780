"""Turn repair, hard negatives and byte-level BPE against plain forms of their contracts."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from martwright.llm import byte_bpe, hard_negatives, turn_repair
from tests.llm.conftest import EDGE, digest

# ------------------------------------------------------------- turn repair

FOLLOWS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def plain_repair(rows):
    """The contract row by row: every cheapest audit as a string, the least of each state kept
    for every number of inserts."""
    kept = {"": (0, "", ())}  # last initial -> (cost, audit, repaired)

    def better(into, key, value):
        if key not in into or value < into[key]:
            into[key] = value

    def inserts(states):
        out = dict(states)
        for _ in range(2):
            for x, (cost, audit, done) in list(out.items()):
                for role in ("user", "assistant"):
                    if (to := FOLLOWS.get((x, role[0]))):
                        better(out, to, (cost + 3, audit + "I", (*done, f"{role}:")))
        return out

    for role, text, fault in rows:
        new = {}
        for x, (cost, audit, done) in inserts(kept).items():
            better(new, x, (cost + 4, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if (to := FOLLOWS.get((x, role[:1]))):
                better(new, to, (cost + more, audit + "K", (*done, f"{role}:{text}")))
            for other in ("user", "assistant"):
                if (to := FOLLOWS.get((x, other[0]))):
                    better(new, to, (cost + more + 3, audit + "R", (*done, f"{other}:{text}")))
        kept = new
    ends = [v for x, v in inserts(kept).items() if x in ("", "a")]
    cost, audit, done = min(ends)
    return cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest()


def plain_rows(table):
    """conv_id -> the expected row, by the contract's words."""
    after = {conv: [] for conv, *_ in table}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in after.items():
        def key(r, conv=conv):
            name = f"{' ' if conv is None else conv}:{len(r[1])}:{r[1]}{r[2]}"
            return r[0] is not None, r[0] or 0, r[1], hashlib.sha256(name.encode()).hexdigest()
        rows = sorted(rows, key=key)
        seen, faults = set(), []
        for _, role, text in rows:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, sha = plain_repair([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return digest(out)


def test_audits_against_all_edit_lists():
    """Every list of edits of short conversations, split in two pieces at every place."""
    rng = random.Random(5)
    names = {0: "", 1: "blank", 2: "duplicate", 3: "truncated"}
    for _ in range(200):
        rows = [(rng.choice("suaaux"), rng.choice([0, 0, 0, 1, 2, 3]), 1) for _ in range(rng.randint(0, 6))]
        want = plain_all([(i, f) for i, f, _ in rows])
        assert plain_repair([(i, "", names[f]) for i, f, _ in rows])[:2] == want
        for k in range(len(rows) + 1):
            found = [{(s, t): x for s in range(4) for t, x in turn_repair.audits(p, s).items()} for p in (rows[:k], rows[k:])]
            ways = []
            for f in found:
                rank = {a: i for i, a in enumerate(sorted({a for _, a in f.values()}))}
                ways.append({at: (c, rank[a]) for at, (c, a) in f.items()})
            cost, at = turn_repair.choose(ways)
            assert (cost, found[0][at[0]][1] + found[1][at[1]][1] + turn_repair.ENDING[at[1][1]]) == want


def plain_all(rows):
    """(cost, audit): the least of all edit lists, none left out."""
    states = {("", ""): 0}

    def inserts(states):
        out, front = dict(states), states
        for _ in range(2):
            front = {(FOLLOWS[x, r], a + "I"): c + 3 for (x, a), c in front.items() for r in "ua" if (x, r) in FOLLOWS}
            for k, c in front.items():
                out[k] = min(out.get(k, c), c)
        return out

    states = inserts(states)
    for initial, fault in rows:
        new = {}
        for (x, a), c in states.items():
            edits = [((x, a + "D"), c + 4)]
            if fault not in (1, 2):
                c += 3 if fault == 3 else 0
                if (x, initial) in FOLLOWS:
                    edits.append(((FOLLOWS[x, initial], a + "K"), c))
                edits += [((FOLLOWS[x, r], a + "R"), c + 3) for r in "ua" if (x, r) in FOLLOWS]
            for k, c2 in edits:
                new[k] = min(new.get(k, c2), c2)
        states = inserts(new)
    return min((c, a) for (x, a), c in states.items() if x in ("", "a"))


def test_hash_collisions_are_verified(monkeypatch):
    rows = [(i, 3, 1) for i in "uuaasuaxxau" * 4]
    want = turn_repair.audits(rows)
    monkeypatch.setattr(turn_repair, "_PRIME", 2)  # nearly all hashes collide
    assert turn_repair.audits(rows) == want


SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment int, pos int, kind int, audit int"


@pytest.mark.parametrize("bits", [2, 13])
def test_turn_repair_against_plain_form(spark, monkeypatch, bits):
    """Short and long conversations; with segments of four rows nearly all are joined from pieces."""
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", bits)
    rng = random.Random(bits)
    texts = ["Yes.", "No!", "And so", "  ", "", "Why?\n", "a: b.", None, "long " * 3000 + "."]
    table = [(conv, turn, rng.choice(["user", "assistant", "system", "User", "", None, "user", "assistant"]),
              rng.choice(texts)) for conv in [*range(60), None] for turn in range(rng.randint(1, 9))]
    table += [(7, None, "user", "Null turn."), (8, None, None, None), (8, None, None, None)]
    table += [(1000, t % 40, rng.choice(["user", "assistant"]), f"Line {t % 17}.") for t in range(300)]
    table += [(1001, 5, "user", "The same row.")] * 40
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in table], SCHEMA)
    got = turn_repair.run(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert digest(got.collect()) == plain_rows(table)
    assert turn_repair.run(df.where("false")).count() == 0


@pytest.mark.parametrize("bits", [2, 13])
def test_turn_repair_of_odd_ends_and_of_conversations_without_turns(spark, monkeypatch, bits):
    """Only blanks are trimmed from the end of a text, and no turn at all is no gap."""
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", bits)
    rng = random.Random(bits)
    ends = ["x", "0", "b", "c", "0xbc", "Done.c", "Is it 100", "Yes.x0", "Stop.\x0b", "Stop!\x0c", "\x0b\x0c", "\t\r\n ",
            "Yes.\r\n", "\x85", "So.\xa0", "\\", "u", "Hi.\\n"]
    table = [(conv, turn, rng.choice(["user", "assistant", "system"]), rng.choice(ends))
             for conv in range(40) for turn in range(rng.randint(1, 9))]
    table += [(conv, None, "user", "Null turn.") for conv in range(40, 60)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in table], SCHEMA)
    assert digest(turn_repair.run(df).collect()) == plain_rows(table)


# ---------------------------------------------------------- hard negatives


def plain_negatives(rows):
    good = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label)
            for i, v, label in rows if label is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in good]
    out = []
    for a, (i, q, label) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), n is None, n or 0, k)
                        for k, (n, v, _) in enumerate(good) if k != a and len(v) == len(q))
        for s, _, _, k in [x for x in scored if good[x[3]][2] == label][:5]:
            fit = [x for x in scored if good[x[3]][2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, good[k][0], r + 1, good[x[3]][0], -s, -x[0]) for r, x in enumerate(fit)]
    return digest(out)


def test_hard_negatives_against_plain_form(spark, monkeypatch):
    """Ties, repeated rows and ids, a vector held by a third of all rows, nulls, small shards."""
    monkeypatch.setattr(hard_negatives, "SHARD", 64)
    monkeypatch.setattr(hard_negatives, "LEAF", 6)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=8)).round(2).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    rows += [(i, [0.5] * 8, int(i % 3)) for i in range(600, 900)]
    rows += [rows[50], rows[100], rows[100], (None, rows[150][1], 1), (None, rows[150][1], 1), (950, None, 1),
             (1000, [1.0] * 8, None), (1050, [None] + [1.0] * 7, 1), (1100, [float("nan")] * 8, 1), (1150, [float("inf")] * 8, 2),
             (1200, [], 1), (1201, [], 2), (1202, [], 1), (1250, [0.0] * 8, 1), (1300, [1.0, 2.0], 1), (1301, [1.0, 1.0], 1),
             (1302, [0.7, 0.8], 2), (-50, rows[150][1], 3)]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows],
                               "vec_id bigint, embedding array<float>, label int, row int, score double")
    # the table holds floats
    held = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = hard_negatives.run(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert digest(got.collect()) == plain_negatives(held)
    assert hard_negatives.run(df.where("false")).count() == 0


def test_cover_tree_bounds_hold():
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(800, 5)))
    x[::3] = x[0]
    tree = hard_negatives.CoverTree(x, float(np.sqrt((x * x).sum(1).max())))
    q = np.floor(256 * rng.normal(size=(20, 5)))
    lower, upper = tree.bounds(q)

    def members(n):
        return tree.at[tree.below[n]].tolist() if tree.leaf[n] else [i for c in tree.below[n] for i in members(c)]

    assert sorted(members(0)) == list(range(800))
    for n in range(len(tree.radii)):
        s = q @ x[members(n)].T
        assert (s >= lower[:, n:n + 1]).all() and (s <= upper[:, n:n + 1]).all()
        if not tree.leaf[n]:
            assert all(tree.radii[c] <= tree.radii[n] / hard_negatives.SHRINK for c in tree.below[n])


# ------------------------------------------------------------ byte-level BPE

BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(BYTES, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(BYTES, public_tokenizers.PATTERN)


def random_texts(n, longest=80):
    rng = random.Random(n)
    kinds = ["abcdefghijklmnopqrstuvwxyz ETAOIN.,'!0123456789\n", "aaab ", "日本語テキスト ", "éèàüß Étion", "\x1c\x85​᠎　 \t\n'",
             "кириллица и ", "😀👍🏽‍♂️ a", "the ing tion and   er 's 're 'll "]
    for _ in range(n):
        kind = rng.choice(kinds)
        yield rng, "".join(rng.choice(kind) for _ in range(rng.randint(0, longest)))


def test_ids_equal_the_library(encoder, library):
    for rng, text in random_texts(6000):
        if rng.random() < 0.2:
            text += "".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(10))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_every_character_splits_as_the_library_does(encoder, library):
    for c in [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0xE000, 0x1FFFF, 5)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}{chr(c)}a1{chr(c)}1 {chr(c)}"
            assert encoder.encode(text).tolist() == library.encode_ordinary(text), hex(c)


def test_enormous_words_and_stretches(encoder, library, monkeypatch):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    for text in ("".join(rng.choice(letters) for _ in range(300_000)), "x" * 100_000, "ab " * 50_000, " " * 5000 + "a"):
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "STRETCH", 50)
    for _, text in random_texts(300, 400):
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.digests(ids) == (hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(),
                                        hashlib.sha256(text.encode()).hexdigest())


def test_a_full_table_starts_again(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 20)
    monkeypatch.setattr(byte_bpe, "PAIRS_KEPT", 20)
    small = byte_bpe.Encoder(BYTES, public_tokenizers.PATTERN)
    for _, text in random_texts(300):
        assert small.encode(text).tolist() == library.encode_ordinary(text)


def test_edits_and_appends_stay_exact(encoder, library):
    v = encoder.vocabulary
    for rng, text in random_texts(600, 300):
        doc = byte_bpe.Document(v, public_tokenizers.PATTERN, text)
        for _ in range(3):
            a = rng.randint(0, len(text))
            b = rng.randint(a, min(len(text), a + 8))
            new = rng.choice(["", " ", "'", "x", "tion", "\n\n", "é"])
            text = text[:a] + new + text[b:]
            doc.replace(a, b, new)
            assert doc.ids() == library.encode_ordinary(text)
        doc.append("tion's")
        assert doc.ids() == library.encode_ordinary(text + "tion's")
        raw = bytes(rng.randrange(97, 101) for _ in range(rng.randint(0, 200)))
        one, cut = byte_bpe.Prefixes(v, raw), rng.randint(0, len(raw))
        one.replace(cut, cut, b"abc")
        grown = byte_bpe.Prefixes(v, raw[:cut])
        grown.append(b"abc" + raw[cut:])
        assert one.last == grown.last == byte_bpe.Prefixes(v, raw[:cut] + b"abc" + raw[cut:]).last


def test_an_edit_recomputes_its_surroundings_alone(encoder):
    raw = b"internationalization " * 2000
    p = byte_bpe.Prefixes(encoder.vocabulary, raw)
    assert p.replace(20_000, 20_001, b"q") < 10 * encoder.vocabulary.longest
    doc = byte_bpe.Document(encoder.vocabulary, public_tokenizers.PATTERN, "some words here " * 500)
    assert doc.replace(4000, 4001, "Z") < 10


def test_byte_bpe_of_edge_rows(edge, empty, library):
    got = byte_bpe.run(edge, BYTES, public_tokenizers.PATTERN)
    want = []
    for i, text in EDGE:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert digest(got.collect()) == digest(want)
    assert byte_bpe.run(empty, BYTES, public_tokenizers.PATTERN).count() == 0
    ids = {r.doc_id: r.ids for r in byte_bpe.encoded(edge.where("doc_id = 8"), BYTES, public_tokenizers.PATTERN).collect()}
    assert ids[8] == library.encode_ordinary("Ünïcödé ß 日本語 😀 naïve")
