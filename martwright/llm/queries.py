"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martwright.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    embedding_dup,
    hard_negatives,
    language_id,
    license_scan,
    near_dup,
    packing,
    token_counts,
    token_orc,
    toxicity,
    turn_repair,
)
from martwright.llm.common import table

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.tiktoken"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.run(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.run(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.run(spark, table(spark, sf_dir, "documents"))


def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dup.run(table(spark, sf_dir, "embeddings"))


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.run(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.run(table(spark, sf_dir, "conversations"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.run(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.run(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.run(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.run(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.run(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.run(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.run(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                        public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_best_fit_packing, op2_near_dup, op3_license_scan, op4_embedding_near_dup,
             op5_token_orc, op6_chat_format, op7_toxicity, op8_language_id, op9_decontamination,
             op10_token_counts, op11_turn_repair, op12_hard_negatives, op13_byte_bpe]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_embedding_near_dup": embedding_dup.SQL, "op6_chat_format": chat_format.SQL,
            "op9_decontamination": decontaminate.SQL, "op12_hard_negatives": hard_negatives.SQL}
