"""Serving entry points: build-if-missing and the page data of the dashboard.

There is no UI; each dashboard page's data is a function returning a
DataFrame over the stored marts. Results that pages share are stored once per
state of the marts (``MemoisedReads``).
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators import features, forecasting, insights, segmentation, serving
from martwright.operators.marts import kpi_summary
from martwright.operators.sampling import sample_exact_n
from martwright.plans.warehouse import MART_TABLES, run_pipeline
from martwright.session import checkpoint
from martwright.sinks.tables import current_version, exists, list_files, list_names, remove, write_table

log = logging.getLogger(__name__)


def warehouse_exists(spark: SparkSession, root: str) -> bool:
    """Whether a build came to its end: a version is published after its last table."""
    return current_version(spark, root) is not None


def mart_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each mart in the current version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no warehouse was built under {root}")
    return {name: f"{version}/mart/{name}" for name in MART_TABLES}


def open_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts of the current version; all of them belong to the same build."""
    # the month that a partitioned mart is stored by is no column of the mart
    marts = {name: spark.read.parquet(path).drop("order_purchase_month")
             for name, path in mart_paths(spark, root).items()}
    marts["kpi_summary"] = kpi_summary(marts["mart_sales_daily"])
    return marts


def ensure_built(spark: SparkSession, raw, root: str,
                 train_dir: str | None = None) -> dict[str, DataFrame]:
    """Open the warehouse, building it (and training, step by step) when missing.

    ``raw`` is the dict of raw inputs or a zero-argument callable returning it
    (only called when a build is needed). A failing training step is logged
    and skipped so the marts stay usable.
    """
    if warehouse_exists(spark, root):
        return open_marts(spark, root)
    layers = run_pipeline(spark, raw() if callable(raw) else raw, root)
    if train_dir:
        daily = layers.mart["mart_sales_daily"]
        try:
            if not daily.isEmpty():
                write_table(spark, forecasting.train_gbt(daily, test_days=30).model, f"{train_dir}/gbt")
        except Exception as e:  # noqa: BLE001
            log.warning("tree model training skipped: %s", e)
        try:
            items = delivered_extract(layers.mart["mart_order_items"])
            if not items.isEmpty():
                # model and scaler too: new customers can be scored after a cold start
                rfm = checkpoint(segmentation.rfm(items, materialise=checkpoint))
                scaler = write_table(spark, segmentation.scaling_stats(rfm), f"{train_dir}/rfm_scaler")
                scaled = checkpoint(segmentation.rfm_scale(rfm, stats=scaler))
                centres = write_table(spark, segmentation.fit_kmeans(scaled), f"{train_dir}/rfm_kmeans")
                write_table(spark, segmentation.assign_segments(centres, scaled), f"{train_dir}/rfm_scored")
        except Exception as e:  # noqa: BLE001
            log.warning("RFM training skipped: %s", e)
    return open_marts(spark, root)


def delivered_extract(items: DataFrame) -> DataFrame:
    return (items.select("customer_unique_id", "order_id", "order_purchase_date", "item_gmv",
                         "order_status")
            .where((F.col("order_status") == "delivered")
                   & F.col("customer_unique_id").isNotNull()
                   & F.col("order_purchase_date").isNotNull())
            .drop("order_status"))


def files_digest(spark: SparkSession, paths: dict[str, str]) -> str:
    """Digest of the names, sizes and times of all files of some tables."""
    lines = []
    for name, path in sorted(paths.items()):
        lines += [f"{name}|{line}" for line in list_files(spark, path)]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:32]


class MemoisedReads:
    """The four dashboard loaders, each stored once per state of the marts' files.

    A loader's result lies in a folder named by the digest of the mart files it was computed from.
    While they stay the same, also in other sessions, it is read from there; after a refresh the
    digest differs and the result is computed anew. ``release`` deletes results of other digests.
    Nothing stays in executors' memory.
    """

    LOADERS = {
        "kpis": lambda m: m["kpi_summary"],
        "daily": lambda m: serving.daily_sorted(m["mart_sales_daily"]),
        "top_categories": lambda m: serving.top_categories(m["mart_order_items"]),
        "state_sales": lambda m: serving.state_sales(m["mart_order_items"]),
    }
    SORTED = {"daily": ["ds"], "top_categories": [F.desc("gmv"), "product_category_en"], "state_sales": [F.desc("gmv")]}

    def __init__(self, spark: SparkSession, marts: dict[str, DataFrame], paths: dict[str, str], root: str):
        """``paths`` are the folders that ``marts`` are read from, ``root`` is the results' folder."""
        self.spark, self.marts, self.paths, self.root = spark, marts, paths, root.rstrip("/")
        self.computed: list[str] = []

    def read(self, name: str) -> DataFrame:
        at = f"{self.root}/{files_digest(self.spark, self.paths)}/{name}"
        if not exists(self.spark, f"{at}/_SUCCESS"):
            write_table(self.spark, self.LOADERS[name](self.marts), at)
            self.computed.append(name)
        found = self.spark.read.parquet(at)
        return found.orderBy(*self.SORTED[name]) if name in self.SORTED else found

    def release(self, every: bool = False) -> list[str]:
        """Delete the results of marts that are no longer current, or all of them."""
        keep = "" if every else files_digest(self.spark, self.paths)
        gone = [n for n in list_names(self.spark, self.root) if n != keep]
        for n in gone:
            remove(self.spark, f"{self.root}/{n}")
        return gone


def memoised_reads(spark: SparkSession, root: str) -> MemoisedReads:
    """The loaders over the current version of a warehouse; results lie under its ``_memo``."""
    return MemoisedReads(spark, open_marts(spark, root), mart_paths(spark, root), f"{root.rstrip('/')}/_memo")


def insight_page(marts: dict[str, DataFrame]) -> DataFrame:
    return insights.insights_all(marts["kpi_summary"], marts["mart_sales_daily"])


def pages(spark: SparkSession, marts: dict[str, DataFrame], rfm_scored: DataFrame | None = None,
          horizon: int = 60, model=None) -> dict[str, dict[str, DataFrame]]:
    """Data of the six dashboard pages, as DataFrames (no UI).

    Forecast: ``flat`` is what the source dashboard actually shows (constant
    mean of the last 7 days); ``recursive`` is the intended model roll-forward,
    produced when a fitted tree ``model`` is given.
    """
    daily = marts["mart_sales_daily"]
    items = marts["mart_order_items"]
    out = {
        "overview": {"kpi": serving.kpi_card_values(marts["kpi_summary"]),
                     "daily": serving.daily_sorted(daily),
                     "top_categories": serving.top_categories(items)},
        "sales": {"state_sales": serving.state_sales_top(items),
                  "daily": serving.daily_sorted(daily)},
        "forecast": {"flat": features.forecast_flat(daily, horizon, 7)},
        "insights": {"insights": insight_page(marts)},
        "data_health": {"row_counts": serving.row_counts(
            {k: marts[k] for k in ("mart_orders", "mart_order_items", "mart_sales_daily",
                                   "dim_customers")})},
    }
    if model is not None:
        out["forecast"]["recursive"] = forecasting.forecast_recursive(model, daily, horizon)
    if rfm_scored is not None:
        out["customers"] = {
            "profile": segmentation.segment_profile(rfm_scored),
            "scatter_sample": sample_exact_n(rfm_scored, 5000, ["customer_unique_id"]),
        }
    return out
