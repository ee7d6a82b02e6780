"""CSV / JSON / Parquet sinks.

An export is one CSV file per table, ``name.csv``, with a header line. Its rows are written by all
tasks as parts without a header; the parts are then joined by the file system, in order, behind the
header: by its own concatenation where it has one (no byte moves), else by streaming copies with a
small buffer, each part deleted once it is copied. So no task, and no memory, ever holds a whole table,
and the disk never holds it twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.sinks.tables import _at, list_names, remove

EXPORT_TABLES = ("dim_customers", "dim_products", "dim_sellers", "mart_orders",
                 "mart_order_items", "mart_sales_daily")


def as_text_columns(df: DataFrame) -> DataFrame:
    """Timestamps/dates rendered by Spark's string cast: ``2018-01-01 00:00:00``, with
    ``.ffffff`` only when the fraction is non-zero; other columns unchanged."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("timestamp", "timestamp_ntz", "date"):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """Header + comma CSV parts in a folder; NULL as an empty field."""
    as_text_columns(df).write.mode("overwrite").option("header", True).option("delimiter", ",").csv(path)


def write_csv_file(df: DataFrame, path: str) -> str:
    """One CSV file with a header line; its rows are written in parallel. Returns the path."""
    spark, out = df.sparkSession, as_text_columns(df)
    parts = f"{path}.parts-{uuid.uuid4().hex[:12]}"
    out.write.option("header", False).option("delimiter", ",").csv(parts)
    names = [f"{parts}/{n}" for n in list_names(spark, parts) if n.startswith("part-")]
    joined = f"{parts}/joined"
    fs, at = _at(spark, joined)
    stream = fs.create(at, False)
    try:
        stream.write(bytearray((",".join(_quoted(c) for c in out.columns) + "\n").encode()))
    finally:
        stream.close()
    if names:
        _join(spark, joined, names)
    remove(spark, path)
    if not fs.rename(at, _at(spark, path)[1]):
        raise OSError(f"can't rename {joined} to {path}")
    remove(spark, parts)
    return path


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in ',"\n') else name


def _join(spark: SparkSession, target: str, parts: list[str]) -> None:
    """Put the parts' bytes behind the target's, in order. The parts are gone afterwards."""
    fs, at = _at(spark, target)
    jvm, paths = spark.sparkContext._jvm, [_at(spark, p)[1] for p in parts]
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(paths))
    for i, p in enumerate(paths):
        array[i] = p
    try:
        fs.concat(at, array)
        return
    except Exception as e:  # noqa: BLE001  (the JVM's exception, in one of several wrappers)
        if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
            raise
    whole = f"{target}.whole"
    stream = fs.create(_at(spark, whole)[1], False)
    buffer = 1 << 20
    try:
        for p in (at, *paths):
            source = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, buffer, False)
            finally:
                source.close()
            fs.delete(p, False)
    finally:
        stream.close()
    if not fs.rename(_at(spark, whole)[1], at):
        raise OSError(f"can't rename {whole} to {target}")


def read_csv_typed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an export back as text by header, then cast to the known schema (no inference)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def export_marts(marts: dict[str, DataFrame], out_dir: str,
                 tables=EXPORT_TABLES) -> dict[str, str]:
    """Write each mart to ``out_dir/<name>.csv``; returns name → path."""
    return {name: write_csv_file(marts[name], f"{out_dir.rstrip('/')}/{name}.csv") for name in tables}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_metrics_json(metrics: DataFrame, path: str) -> DataFrame:
    """Persist the one-row table of metrics as JSON; returns it read back."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return metrics.sparkSession.read.schema(metrics.schema).json(path)
