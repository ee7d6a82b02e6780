from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martwright.llm.common import text_slices
from martwright.llm.token_counts import TokenCounts
from martwright.llm.token_ids import TokenIds
from martwright.llm.words import SpanTable, grams, mix, words
from tests.llm.conftest import words as plain_words

ODD = ["", None, " ", "  ", "\n", "\n\n a", "a\n", "a \n b", "   a  b   ", "▁a ▁▁  b", "It's <s> <0x0A> x</s>",
       "It's <|endoftext|> THE<|endoftext|>, x'll é. <|ENDOFTEXT|>", "ΣΑΣ İI ΟΔΟΣ.", "a̸b ≠, H̱. ẖ",
       "1234.5, abc123.., 日本語テキスト。 ñ", "'s's 'Snake ''t I'M", "\t\r\x0b\x1c a\x85b c", "😀!!😀...", " .,a.,",
       "x" * 3000 + "." * 50, "aaaa" * 100, "a\x00b", "=" * 90 + "-" * 70, "one two " * 2000]
PIECES = ["a", "b", " ", "\n", ".", "the ", "▁", "é", "日", "  ", "ing", "!", "er", "0", "<", "'s", "THE", "ß"]
TEXTS = st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), min_size=1, max_size=20)


def slices(texts, **kw):
    yield from text_slices(pa.record_batch({"text": pa.array(texts, pa.string())}), **kw)


@settings(max_examples=50, deadline=None)
@given(TEXTS)
def test_words_are_the_pattern_s(texts):
    texts = [*texts, None, "", *ODD]
    for row, end, data, offsets in slices(texts, most=200):
        spans, h = words(data, offsets)
        low = data.tobytes().lower()
        for i in range(end - row):
            a, b = spans.rows[i], spans.rows[i + 1]
            got = [low[s:s + z].decode() for s, z in zip(spans.start[a:b], spans.size[a:b], strict=True)]
            want = plain_words(texts[row + i])
            assert got == [w.lower() if w.isascii() else got[k] for k, w in enumerate(want)]
            assert len(set(h[a:b].tolist())) == len(set(want))


def test_equal_words_have_equal_hashes_wherever_they_are():
    (_, _, data, offsets), = slices(["longer-than-eight-bytes sixteen_bytes_xx", "x LONGER than eight bytes"])
    spans, h = words(data, offsets)
    assert h[spans.rows[0]] == h[spans.rows[1] + 1]


def test_grams_stay_within_texts():
    h = np.arange(1, 8, dtype=np.uint64)
    g, pos, cuts = grams(h, np.array([0, 2, 2, 7]), 3)
    assert cuts.tolist() == [0, 0, 0, 3] and pos.tolist() == [0, 1, 2]
    assert len(set(g.tolist())) == 3


def test_span_table_finds_what_was_added_and_nothing_else():
    t = SpanTable(8)
    h = mix(np.arange(1, 150, dtype=np.uint64))
    assert (t.find(h) == -1).all()
    t.add(h, np.arange(149))
    assert (t.find(h) == np.arange(149)).all()
    assert (t.find(mix(np.arange(1000, 1100, dtype=np.uint64))) == -1).all()


@pytest.fixture(scope="module")
def ids():
    return TokenIds(public_tokenizers.path("word_bpe_49k.json"), bits=10)  # small: it fills up


@pytest.fixture(scope="module")
def counts():
    return TokenCounts(public_tokenizers.path("piece_bpe_32k.model"), bits=10)


@pytest.fixture(scope="module")
def libraries():
    return (Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")),
            sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_token_ids_are_the_library_s(ids, libraries, texts):
    for part in (texts, ODD):
        for row, end, data, offsets in slices(part, most=500):
            got, cuts = ids.encode(data, offsets)
            for i in range(end - row):
                want = libraries[0].encode(part[row + i] or "", add_special_tokens=False).ids + [1]
                assert got[cuts[i]:cuts[i + 1]].tolist() == want


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_token_counts_are_the_library_s(counts, libraries, texts):
    for part in (texts, ODD):
        for row, end, data, offsets in slices(part, most=500):
            want = [len(libraries[1].encode(t or "")) for t in part[row:end]]
            assert counts.count(data, offsets).tolist() == want
