from __future__ import annotations

import os
import shutil
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry
from martwright.llm import queries as llm
from martwright.session import ensure_checkpoint_dir
from scripts.oracle_check import compare, duck_rows, spark_rows
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_near_dup import brute_classes, near_copies
from tests.llm.test_tokens import check_packed

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert compare(spark_rows(spark, llm.queries()[name], SF), duck_rows(con, llm.oracle_sql()[name])) is None


def test_registered_names():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in llm.queries()}
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_do_what_their_operators_find(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        if name == "packing":
            rows = out.collect()
            check_packed(rows, 4096, [t for _, t in before])
            break
        assert out.columns == columns
        after = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "near_duplicates":
            assert after == {c for _, c in brute_classes(before)}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert after == {x[0] for x in brute_hits(before, items) if not x[-1]}
            assert len(after) < len(before)
        docs = out


def test_one_row_of_each_class_of_null_and_repeated_ids_is_left(spark):
    docs = spark.createDataFrame(near_copies(), "doc_id bigint, text string").repartition(5)
    left = corpus_pipeline.unique(spark, docs, SF).collect()
    assert sorted((r.doc_id for r in left), key=repr) == [70, 80, None]


def test_edge_rows_pass_every_stage(spark, edge, empty, tmp_path):
    for t in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{t}.parquet", tmp_path)
    edge.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"edge-{name}")
        assert docs.columns == edge.columns
    left = docs.collect()
    # one row is left of the repeated ones; texts without letters are gone
    assert len({(r.doc_id, r.text) for r in left}) == len(left)
    assert {3, 4, 5}.isdisjoint({r.doc_id for r in left}) and {7, 8, 9} <= {r.doc_id for r in left}
    nothing = empty
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, str(tmp_path))
    assert nothing.count() == 0
    assert os.path.isdir(tmp_path)


def test_names_with_dots_pass(spark):
    docs = spark.createDataFrame([(1, "some words of a text to keep", 2, 3)], "doc_id bigint, text string, `a.b` int, `c``d` int")
    assert corpus_pipeline._whole(docs).select("__doc.*").collect() == docs.collect()
    assert corpus_pipeline.unique(spark, docs, SF).columns == docs.columns


def test_language_stage_keeps_short_texts_and_mixtures(spark):
    """Evenly mixed texts and short ones have a low score, but are in known languages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = docs.where("length(text) between 600 and 4000").orderBy("doc_id")
    texts = [[r.text[:576] for r in long.where(f"lang = '{x}'").select("text").limit(4).collect()] for x in ("de", "en", "es", "fr")]
    mixed = [(10_000 + i, " ".join(t), None, "mixed", 2300) for i, t in enumerate(zip(*texts, strict=False))]
    mixed += [(20_000, "A.", None, "short", 2), (20_001, "Re.", None, "short", 3), (20_002, "123 !!", None, "none", 6)]
    every = docs.unionByName(spark.createDataFrame(mixed, docs.schema))
    left = {r.doc_id for r in corpus_pipeline.language(spark, every, SF).select("doc_id").collect()}
    clean = {r.doc_id for r in docs.where(r"text rlike '\\p{L}'").select("doc_id").collect()}
    assert len(mixed) > 4 and {m[0] for m in mixed} - {20_002} <= left and 20_002 not in left
    assert clean <= left


def test_run_leaves_the_last_stages_tables_only(spark):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    rows = corpus_pipeline.run(spark, SF).count()
    left = {p.name.split("llm-")[1].rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert rows and {x for x in left if x.startswith("stage-")} == {f"stage-{n}" for n, _ in corpus_pipeline.STAGES[:-1]}
    assert all(x.startswith(("stage-", "packed-")) or x == "pieces" for x in left)
