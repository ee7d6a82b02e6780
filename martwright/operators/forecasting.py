"""Daily sales forecasters, holdout metrics and the forecast loop.

* ``forecast_metrics``: MAE, RMSE, MAPE (denominator floored at 1e-9 on the signed actual) per
  series, as one aggregation.
* ``train_gbt``: gradient-boosted trees on 12 calendar/lag features with a time-ordered holdout of
  the last ``test_days`` rows, one ensemble per series (``operators.boosting``).
* ``train_seasonal``: piecewise-linear trend and seasonality, one closed-form fit per series
  (``operators.seasonal``).
* ``forecast_recursive``: predict day t, write the prediction back as history, step forward;
  sequential in the horizon within a series' task, parallel over series, one job.

A model is a table with one row per series. A series has a row a day, so its size is bounded by
calendar days, not by order volume; all steps are partitioned by series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions import abs_error, calendar_columns, pct_error, squared_error, to_numeric
from martwright.operators import boosting, seasonal
from martwright.operators.features import model_frame, tail_rows, time_split
from martwright.schemas import GBT_FEATURES
from martwright.session import checkpoint

STATE_LEN = 28  # values of the past that the features need


def forecast_metrics(pred: DataFrame, y: str = "y", yhat: str = "yhat",
                     series_keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE (%) per series (one global row without keys)."""
    keys = list(series_keys)
    return pred.groupBy(*keys).agg(
        F.avg(abs_error(y, yhat)).alias("mae"),
        F.sqrt(F.avg(squared_error(y, yhat))).alias("rmse"),
        (F.avg(pct_error(y, yhat)) * 100.0).alias("mape"))


def eval_frame(split_df: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Rows to score: the test split, or the training rows when a series has no test rows."""
    keys = list(series_keys)
    # a window, not a join: a series with a NULL key keeps its rows
    has_test = F.max(F.when(F.col("split") == "test", 1).otherwise(0)).over(Window.partitionBy(*keys))
    return (split_df.withColumn("_has_test", has_test)
            .where((F.col("split") == "test") | (F.col("_has_test") == 0)).drop("_has_test"))


@dataclass
class TrainResult:
    model: DataFrame
    metrics: DataFrame
    predictions: DataFrame
    features: list[str]


def train_gbt(daily: DataFrame, test_days: int = 60, series_keys: Sequence[str] = (),
              settings: boosting.Settings = boosting.Settings()) -> TrainResult:
    """Features → NULL-row drop → split (after the drop) → fit on train → score holdout."""
    keys = list(series_keys)
    frame = checkpoint(time_split(model_frame(daily, keys), test_days, keys))
    model = checkpoint(boosting.fit_series(frame.where(F.col("split") == "train"), GBT_FEATURES, keys,
                                           settings=settings))
    scored = checkpoint(boosting.score(model, eval_frame(frame, keys), GBT_FEATURES, keys)
                        .select(*keys, "ds", "y", "yhat"))
    return TrainResult(model, forecast_metrics(scored, series_keys=keys), scored, list(GBT_FEATURES))


def train_seasonal(daily: DataFrame, test_days: int = 60, series_keys: Sequence[str] = (),
                   penalty: float = seasonal.PENALTY, points: int = seasonal.CHANGE_POINTS) -> TrainResult:
    """Split raw rows (no NULL drop) → trend and seasonality fit per series → score."""
    keys = list(series_keys)
    frame = checkpoint(seasonal.frame(daily, test_days, keys))
    model = checkpoint(seasonal.fit(frame, keys, penalty, points))
    pred = seasonal.score(model, eval_frame(frame, keys).select(*keys, "ds", "y"), keys)
    return TrainResult(model, forecast_metrics(pred, series_keys=keys), pred, ["origin", "span", "coef"])


def forecast_state(daily: DataFrame, horizon: int, series_keys: Sequence[str] = (),
                   fallback_n: int = 7) -> DataFrame:
    """One row per series: last values, fallback mean and the horizon's days with their calendar."""
    keys = list(series_keys)
    recent = tail_rows(daily.select(*keys, "ds", to_numeric("y").alias("y")), STATE_LEN, keys)
    series = recent.groupBy(*keys).agg(
        F.max("ds").alias("_last"),
        F.transform(F.array_sort(F.collect_list(F.struct("ds", "y"))), lambda s: s["y"]).alias("hist"))
    tail = F.slice("hist", -F.least(F.lit(fallback_n), F.size("hist")), F.lit(fallback_n))
    days = (series.select(*keys, "hist", F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon)))
                          .alias("ds")).withColumns(calendar_columns("ds")))
    fallback = F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail)
    day = F.struct("ds", *calendar_columns())
    # the history is the same in all rows of a series
    return days.groupBy(*keys).agg(F.any_value(F.struct("hist")).alias("_s"),
                                   F.array_sort(F.collect_list(day)).alias("days")).select(
        *keys, F.col("_s.hist").alias("hist"), "days").withColumn("fallback", fallback)


def forecast_recursive(model: DataFrame, daily: DataFrame, horizon: int, series_keys: Sequence[str] = (),
                       fallback_n: int = 7) -> DataFrame:
    """Recursive multi-step forecast of every series by its own ensemble, in one pass.

    A series with fewer than 28 rows has no complete feature row; until it has, its days get the
    mean of its last ``fallback_n`` historical values, as in the source dashboard when the target
    row is missing.
    """
    keys = list(series_keys)
    return boosting.recursive(model, forecast_state(daily, horizon, keys, fallback_n), GBT_FEATURES, keys)
