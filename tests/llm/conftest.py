from __future__ import annotations

import re

import pytest

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "word " * 60_000
# Nulls, empty and odd texts, a very long one, repeated ids and rows.
EDGE = [(1, "Hello world, this is fine."), (None, "a row without an id here now"), (2, None), (3, ""),
        (4, "  \n "), (5, "!!! ???"), (6, LONG), (7, "x" * 50_000), (1, "Hello world, this is fine."),
        (1, "Hello world, this is fine."), (8, "Ünïcödé ß 日本語 😀 naïve"), (2, "same id, other text"),
        (9, "under the MIT license and Apache License, Version 2.0; CC-BY-NC"), (None, None)]


def words(text):
    return PATTERN.findall((text or "").translate(LOWER))


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with columns whose names the operators use inside."""
    rows = [(i, t, "en", "s", 1, 7, 8, 9, 10, 11, 12) for i, t in EDGE]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, "
              "score int, text_hash int, c1 int, id int, __text int")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


def digest(rows):
    return sorted((tuple(r) for r in rows), key=repr)
