"""Shared helpers of the training-data operators: tables, Arrow tasks, stored intermediates."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import scratch_path
from martwright.sinks.tables import remove

# Texts reach Python in Arrow batches; both bounds keep a worker's memory flat
# however long single texts are.
ARROW_ROWS = 2000
ARROW_BYTES = "16m"
# Within a batch, texts are worked on in slices of about so many bytes.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once a session), wherever its folder lies."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="martwright-py-"), "martwright.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))  # Spark itself brings it to the executors
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(task, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    scope = _SCOPE.get()
    if scope is not None:
        scope.append((out, path))
    return out


_SCOPE: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes the tables that are ``stored`` inside when their last reader is done: at the end.

    Tables put on the list are still read by what the block returns: they stay, or go with the
    block around this one. What reads the others has to be stored inside as well.
    """
    mine: list[tuple[DataFrame, str]] = []
    keep: list[DataFrame] = []
    outer = _SCOPE.get()
    token = _SCOPE.set(mine)
    try:
        yield keep
    except BaseException:
        keep.clear()
        raise
    finally:
        _SCOPE.reset(token)
        for df, path in mine:
            if not any(df is k for k in keep):
                remove(spark, path)
            elif outer is not None:
                outer.append((df, path))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo n (the folds of the classifiers)."""
    return F.crc32(doc_id.cast("string")) % n


def text_hash(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(text.isNull(), text)


def text_slices(batch: pa.RecordBatch, column: str = "text",
                most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of a batch; a null text is empty.

    A slice has at least one row, so a text longer than ``most`` is a slice of its own.
    """
    col = batch.column(column)
    if col.null_count:
        col = pc.fill_null(col, "")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), len(col))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def long_list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list<long> column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                    pa.array(values.view(np.int64) if values.dtype == np.uint64
                                             else values.astype(np.int64)))
