"""Spark session settings and the shared scratch folder.

The engine never relies on a machine-local folder on a cluster: lineage is
cut and intermediate tables are written under ``spark.checkpoint.dir``, the
shared folder the cluster names. Only a local-mode session (tests, bench)
that has no such setting gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps in the data are zone-less
# (TIMESTAMP_NTZ); UTC keeps any zone-aware path stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Strict casts fail on bad text instead of turning it into NULL.
    "spark.sql.ansi.enabled": "true",
    # collect_set over few values per key: hash aggregation holds many keys before it sorts.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys (one product / customer / day holding a third of all rows)
    # are split at runtime by AQE instead of landing in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # AQE turns a shuffle join into a broadcast only after measuring the
    # materialised side; this is the size check behind every dimension join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    # Reliable checkpoints are removed once their DataFrame is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = 8,
                  app_name: str = "martwright", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied.

    ``shuffle_partitions=None`` (the cluster setting) sizes the shuffle width
    from the cluster: AQE starts from 16 × default parallelism and coalesces
    to ~128 MB partitions, so the same setting serves small and 100 TB inputs.
    ``event_log_dir`` writes Spark's event log there (stage/task timings
    without the UI).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if event_log_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    conf.setdefault("spark.driver.memory", os.environ.get("MARTWRIGHT_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if shuffle_partitions is None:
        # AQE can merge shuffle partitions but not split them (skew aside), so
        # start wide (a 30 TB item shuffle needs ~10^5 partitions to stay near the
        # 128 MB advisory size) and let AQE coalesce to that size, not to core count.
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", str(max(200, 4 * cores)))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(max(1000, 16 * cores)))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for "
            "checkpoints and intermediate tables")
    local = tempfile.mkdtemp(prefix="martwright-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/martwright-{name}-{uuid.uuid4().hex[:12]}"


def checkpoint(df):
    """Reliable checkpoint into the shared folder (never ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends; else they stay until the JVM's next large collection.

    For queries that run once: one that runs again would shuffle again.
    """
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once an application), for functions that run in Python."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="martwright-pkg-"), "martwright_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))  # code, not data: Spark itself brings it to the executors
    _SHIPPED.add(sc.applicationId)
