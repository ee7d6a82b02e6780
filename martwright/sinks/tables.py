"""Stored tables and small texts on whatever file system the path names."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession


def write_table(spark: SparkSession, df: DataFrame, path: str,
                partition_by: list[str] | None = None, plain: Collection[str] = (),
                codec: str | None = None) -> DataFrame:
    """Overwrite ``path`` with ``df`` and return a DataFrame reading the stored copy.

    ``plain`` names columns of nearly as many values as rows: the writer then doesn't build a
    dictionary of them, which it would give up at a megabyte. ``codec``: other than the session's.

    Reading back (instead of ``cache``) cuts the lineage: consumers scan the
    files with pruning/pushdown, and a lost executor never forces the
    upstream joins to be recomputed.
    """
    writer = df.write.mode("overwrite").options(
        **{f"parquet.enable.dictionary#{c}": "false" for c in df.columns if c in plain})
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _at(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table or file; none there is no error."""
    fs, at = _at(spark, path)
    fs.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """name|size|time of all files under a folder, sorted."""
    fs, at = _at(spark, path)
    out, found = [], fs.listFiles(at, True)
    while found.hasNext():
        f = found.next()
        out.append(f"{f.getPath().toUri().getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text beside its place and rename it there: readers see the old or the new one.

    A file system that does not rename onto a file loses the old one first; ``current_version`` below
    doesn't depend on that, as pointers are files of their own.
    """
    fs, at = _at(spark, path)
    part, new = _at(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(new, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(new, at):
        fs.delete(at, False)
        if not fs.rename(new, at):
            raise OSError(f"can't rename {new.toString()} to {path}")


# -------------------------------------------------------------- versions
# A versioned folder holds a folder per version and, under ``_pointers``, a small file per
# published version whose name sorts by time. The last pointer is the current version: publishing
# is the creation of one file, and no file that readers use is ever replaced.

POINTERS = "_pointers"


def new_version(root: str) -> str:
    """A folder for the tables of a new version; nobody reads it before it is published."""
    return f"{root.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, version: str, about: dict | None = None) -> None:
    """Make a finished version the current one."""
    name = version.rsplit("/", 1)[1]
    write_text(spark, f"{root.rstrip('/')}/{POINTERS}/{name}", json.dumps({"version": name} | (about or {})))


def versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions, oldest first."""
    return [n for n in list_names(spark, f"{root.rstrip('/')}/{POINTERS}") if n.startswith("v-") and "." not in n]


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version, or None if none was published."""
    found = versions(spark, root)
    return f"{root.rstrip('/')}/{found[-1]}" if found else None


def release_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete published versions but the last ``keep``, pointers first; returns their names.

    The one before the current version stays for readers that have opened it. Unpublished folders
    (of builds that died) older than the oldest kept version go too.
    """
    root = root.rstrip("/")
    found = versions(spark, root)
    kept, old = set(found[-keep:]), found[:-keep]
    for name in old:
        remove(spark, f"{root}/{POINTERS}/{name}")
    oldest = min(kept, default="")
    gone = [n for n in list_names(spark, root) if n.startswith("v-") and n not in kept and n < oldest]
    for name in gone:
        remove(spark, f"{root}/{name}")
    return sorted(set(gone) | set(old))


def write_versioned(spark: SparkSession, df: DataFrame, root: str, keep: int = 2) -> DataFrame:
    """Replace a table such that readers see the old or the new one, whole; returns it read back."""
    version = new_version(root)
    write_table(spark, df, version)
    publish(spark, root, version)
    release_versions(spark, root, keep)
    return spark.read.parquet(version)


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version of a table was published under {root}")
    return spark.read.parquet(version)
