"""Training job: daily series → two forecasters; delivered items → RFM segments; metrics."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators import boosting, forecasting, segmentation
from martwright.session import checkpoint
from martwright.sinks.exports import write_metrics_json
from martwright.sinks.tables import write_table

log = logging.getLogger(__name__)


class EmptyMartError(RuntimeError):
    pass


def empty_guard(daily: DataFrame) -> None:
    """Fail early when the daily mart has no rows (the warehouse was not built)."""
    if daily.isEmpty():
        raise EmptyMartError("mart_sales_daily is empty: run the warehouse build first")


def fit_all(spark: SparkSession, daily: DataFrame, rfm: DataFrame, delivered_items: DataFrame,
            test_days: int = 60, k: int = 4,
            settings: boosting.Settings = boosting.Settings()) -> dict[str, DataFrame]:
    """All tables of the job: models, holdouts, scored customers and one row of metrics.

    Metrics: ``seasonal`` and ``gbt`` (structs of mae, rmse, mape), ``gbt_features``, row counts.
    ``daily`` and ``rfm`` are stored tables: several passes read them.
    """
    empty_guard(daily)
    seasonal = forecasting.train_seasonal(daily, test_days)
    gbt = forecasting.train_gbt(daily, test_days, settings=settings)
    scaler = checkpoint(segmentation.scaling_stats(rfm))
    scaled = checkpoint(segmentation.rfm_scale(rfm, stats=scaler))
    centres = segmentation.fit_kmeans(scaled, k=k)

    def counted(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    def held(result: forecasting.TrainResult):
        return result.metrics.select(F.struct("mae", "rmse", "mape")).scalar()

    metrics = spark.range(1).select(
        held(seasonal).alias("seasonal"), held(gbt).alias("gbt"),
        F.array(*[F.lit(c) for c in gbt.features]).alias("gbt_features"),
        counted(daily).alias("rows_daily"), counted(delivered_items).alias("rows_order_items"),
        counted(rfm).alias("rows_rfm"))
    return {"seasonal": seasonal.model, "seasonal_holdout": seasonal.predictions, "gbt": gbt.model,
            "gbt_holdout": gbt.predictions, "rfm": rfm, "rfm_scaler": scaler, "rfm_kmeans": centres,
            "rfm_scored": segmentation.assign_segments(centres, scaled), "metrics": metrics}


def train_all(spark: SparkSession, daily: DataFrame, delivered_items: DataFrame, out_dir: str,
              test_days: int = 60, k: int = 4,
              settings: boosting.Settings = boosting.Settings()) -> dict[str, DataFrame]:
    """Fit, evaluate and persist both forecasters and the RFM segmentation under ``out_dir``.

    The daily series (one row per day) and the RFM table feed several passes: they are stored
    first, so none re-runs the item joins. The metrics also go to ``out_dir/metrics`` as JSON.
    """
    daily = checkpoint(daily)
    empty_guard(daily)
    rfm = checkpoint(segmentation.rfm(delivered_items, materialise=checkpoint))
    made = {name: write_table(spark, df, f"{out_dir}/{name}" if name != "metrics" else f"{out_dir}/metrics_table")
            for name, df in fit_all(spark, daily, rfm, delivered_items, test_days, k, settings).items()}
    write_metrics_json(made["metrics"], f"{out_dir}/metrics")
    log.info("training complete: %s", out_dir)
    return made
