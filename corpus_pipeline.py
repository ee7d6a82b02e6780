"""The corpus pipeline: documents in, packed training sequences out.

STAGES are applied in turn; each works on the rows that the one before kept and wrote.

1. language: drops texts without a letter, and texts of a whole window and more (192 bytes) without
   one window in which a language has a majority; shorter ones hold too little to be rejected by,
   and a text of several languages is none without a language.
2. toxicity: drops texts with a score of 0.5 or more.
3. near duplicates: keeps one row of each class, of the smallest doc_id (without ids, or with
   several texts under that id: the one with the least hash).
4. decontamination: drops texts of which benchmark windows cover a twentieth or more.
5. packing: pieces of the rest, packed into sequences (the result).

Null or repeated ids are rows like others (of rows with equal id and text the third stage
keeps one); texts are taken whole, however long; extra columns pass as they are, whatever
their names; an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import decontaminate, language_id, near_dup, packing, toxicity
from martwright.llm.common import scratch, stored, table, text_hash
from martwright.llm.queries import WORD_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _whole(docs: DataFrame) -> DataFrame:
    """Each row as one column, so that no column's name can clash; with its id and text."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    return docs.select(F.struct(*quoted).alias("__doc"), "doc_id", "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = language_id.fit(docs, F.coalesce(language_id.training_fold(F.col("doc_id")), F.lit(False)))
    lettered = _whole(docs).where(F.col("text").rlike(r"\p{L}"))
    rows = language_id.predict(lettered, net, ["__doc"])
    # with nothing to learn from, only texts without a letter can be told
    known = (F.col("window_score") >= 0.5) | (F.col("n_bytes") < language_id.WINDOW)
    return (rows if net is None else rows.where(known)).select("__doc.*")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_whole(docs), machine, ["__doc"]).where("score < 0.5").select("__doc.*")


def _with_key(docs: DataFrame) -> DataFrame:
    return _whole(docs).select("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("id"),
                               text_hash(F.col("text")).alias("hash"))


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select(F.coalesce("doc_id", F.lit(-1 << 63)).alias("id"),
                       F.col("text_hash").alias("hash")).distinct()


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = _keys(near_dup.classes(docs).where("kept"))
    # one row of each key, before the shuffle, so that a key of many rows is no large group
    one = _with_key(docs).groupBy("id", "hash").agg(F.first("__doc").alias("__doc"))
    return one.join(kept, ["id", "hash"], "left_semi").select("__doc.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hit = _keys(decontaminate.find(spark, docs, table(spark, sf_dir, "benchmark")).where("contaminated"))
    return _with_key(docs).join(hit, ["id", "hash"], "left_anti").select("__doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.run(spark, docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("toxicity", not_toxic), ("near_duplicates", unique),
    ("decontamination", uncontaminated), ("packing", packed)]

# The two classifiers, the signatures and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # a stage's own tables go once its rows are written
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
            keep.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
