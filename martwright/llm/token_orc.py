"""Token ids of documents as ORC files (operator 5).

One row per document: its ids as a list of integers, which ORC stores with integer
run-length encoding, in stripes with row indexes. A Bloom filter and the row-index minima
and maxima on ``doc_id`` let a reader skip stripes and row groups by metadata; tasks read
stripes side by side. Documents lie in ascending ``doc_id`` order: ranges of ids are dealt
over the files, and each file is sorted.

Nulls and edge cases: a null or empty text has the end id alone; a null ``doc_id`` comes
first; rows that repeat an id are each kept, next to one another (ties by the text's hash);
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.common import map_arrow, stored, text_slices
from martwright.llm.token_ids import tokenizer
from martwright.session import scratch_path

STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
SCHEMA = "doc_id bigint, file int, at bigint, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer_path: str, files: int | None = None) -> DataFrame:
    """(doc_id, file, at, ids): ranges of doc_id by file, ``at`` counts the rows of a file.

    Rows that are equal in id and text are dealt over ranges by a random number: many of them are
    not one file, and their order among themselves does not matter.
    """
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumns({"tie": F.xxhash64("text"), "deal": F.rand(11)})
            .repartitionByRange(n, "doc_id", "tie", "deal").sortWithinPartitions("doc_id", "tie")
            .select("doc_id", "text", F.spark_partition_id().alias("file")))

    def task(batches):
        encoder, at = tokenizer(tokenizer_path), 0
        for batch in batches:
            for row, end, data, offsets in text_slices(batch):
                ids, cuts = encoder.encode(data, offsets)
                part = batch.slice(row, end - row)
                yield pa.record_batch([
                    part.column("doc_id"), part.column("file"),
                    pa.array(np.arange(at, at + end - row)),
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                             pa.array(ids.view(np.int32)))],
                    names=["doc_id", "file", "at", "ids"])
                at += end - row

    return map_arrow(rows, task, SCHEMA)


def write_orc(encoded: DataFrame, path: str) -> None:
    (encoded.write.option("compression", "zlib")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(INDEX_ROWS))
     .option("orc.stripe.size", str(STRIPE_BYTES)).orc(path))


def read_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The documents of the files; with ``doc_ids``, stripes and row groups without them are skipped."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def document_digest(rows: DataFrame) -> DataFrame:
    """(doc_id, file, at, n_tokens, ids_crc32) of the ids that the files hold."""

    def task(batches):
        for batch in batches:
            col = batch.column("ids")
            flat = np.asarray(col.flatten()).astype("<u4", copy=False)
            cuts = np.concatenate([[0], np.cumsum(np.diff(np.asarray(col.offsets)))]).tolist()
            raw = memoryview(np.ascontiguousarray(flat)).cast("B")
            yield pa.record_batch([
                batch.column("doc_id"), batch.column("file"), batch.column("at"),
                pa.array(np.diff(cuts)),
                pa.array([zlib.crc32(raw[4 * a:4 * b])
                          for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64())],
                names=["doc_id", "file", "at", "n_tokens", "ids_crc32"])

    return map_arrow(rows, task, "doc_id bigint, file int, at bigint, n_tokens bigint, ids_crc32 bigint")


def with_starts(digest: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before: running sums within files, over file totals."""
    inner = Window.partitionBy("file").orderBy("at")
    before = (digest.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row for each file
              .withColumn("base", F.sum("n").over(Window.orderBy("file")) - F.col("n"))
              .select("file", "base"))
    return (digest.withColumn("upto", F.sum("n_tokens").over(inner))
            .join(before, "file")
            .withColumn("start", F.col("base") + F.col("upto") - F.col("n_tokens")))


def run(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    path = scratch_path(spark, "llm-token-orc")
    write_orc(encode_documents(docs, tokenizer_path), path)
    digest = stored(document_digest(read_orc(spark, path)), "token-orc-digest")
    return with_starts(digest).select("doc_id", "start", "n_tokens", "ids_crc32")
