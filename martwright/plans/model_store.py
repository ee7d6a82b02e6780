"""Store of fitted models: tables in a shared folder, found by what they were fitted on.

The key of an entry is a digest of its training rows, its parameters and its features, so a second
session loads it without fitting, changed rows or parameters give another entry, and nothing stale
is ever served. An entry is complete once its manifest is there (written last); two sessions that
fit the same write their own folders, and the manifest names the folder to read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import ensure_checkpoint_dir
from martwright.sinks import tables

FORMAT = 1  # of the stored models; part of the key


def rows_digest(df: DataFrame) -> str:
    """Digest of a table's rows in any order: their number and two sums of row hashes."""
    whole = "decimal(38,0)"
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # nulls are marked, or a null and a value could change places
    marked = [x for c in cols for x in (c.isNull(), c)]
    r = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.xxhash64(F.lit(s), *marked).cast(whole)).alias(f"s{s}") for s in (1, 2)]).first()
    text = json.dumps([sorted(df.dtypes), r["n"], str(r["s1"]), str(r["s2"])])
    return hashlib.sha256(text.encode()).hexdigest()


def store_root(spark: SparkSession) -> str:
    """The folder named by spark.martwright.models.dir, or one beside the cluster's checkpoints."""
    conf = spark.sparkContext.getConf()
    for name, below in (("spark.martwright.models.dir", ""), ("spark.checkpoint.dir", "/martwright-models")):
        at = spark.conf.get(name, None) or conf.get(name, None)
        if at:
            return at.rstrip("/") + below
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/martwright-models"


@dataclass
class Entry:
    tables: dict[str, DataFrame]
    manifest: dict
    fitted: bool  # now, not loaded


class ModelStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or store_root(spark)).rstrip("/")

    def get(self, kind: str, rows: dict[str, DataFrame], parameters: dict, features: list[str],
            fit: Callable[[], dict[str, DataFrame]]) -> Entry:
        """The tables of the model of these rows and parameters; fitted only if there is none."""
        digests = {name: rows_digest(df) for name, df in sorted(rows.items())}
        key = {"kind": kind, "format": FORMAT, "rows": digests, "parameters": parameters, "features": features}
        name = hashlib.sha256(json.dumps(key, sort_keys=True).encode()).hexdigest()[:32]
        at = f"{self.root}/{kind}-{name}"
        manifest = tables.read_text(self.spark, f"{at}/manifest.json")
        fitted = manifest is None
        if fitted:
            folder = f"{at}/{uuid.uuid4().hex[:12]}"
            made = fit()
            for table, df in made.items():
                df.write.parquet(f"{folder}/{table}")
            manifest = json.dumps(key | {"folder": folder, "tables": sorted(made)}, sort_keys=True)
            tables.write_text(self.spark, f"{at}/manifest.json", manifest)
        found = json.loads(manifest)
        return Entry({t: self.spark.read.parquet(f"{found['folder']}/{t}") for t in found["tables"]}, found, fitted)
