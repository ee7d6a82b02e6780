"""Time-series features over daily series (one or many).

Lags and rolling means count **rows**, not calendar days (days without
sales have no row), matching the positional semantics of the source
system. Every window is ``partitionBy(series_keys)``: with series keys the
work spreads over tasks; without them there is one series, whose length is
bounded by the number of calendar days (thousands of rows), never by the
number of orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions import calendar_columns, to_numeric

DEFAULT_LAGS = (1, 7, 14, 28)
DEFAULT_ROLLS = (7, 14)


def _window(keys: Sequence[str], ds: str = "ds"):
    return Window.partitionBy(*keys).orderBy(ds) if keys else Window.orderBy(ds)


def time_features(daily: DataFrame, ds: str = "ds") -> DataFrame:
    """dow (Mon=0), ISO week, month, calendar year, day of month, weekend flag."""
    return daily.withColumns(calendar_columns(ds))


def rolling_history_mean(y: str, n: int, keys: Sequence[str] = (), ds: str = "ds") -> Column:
    """Mean of the previous ``n`` rows (current excluded); NULL unless all ``n`` are present."""
    frame = _window(keys, ds).rowsBetween(-n, -1)
    return F.when(F.count(y).over(frame) == n, F.avg(y).over(frame))


def lag_features(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS,
                 rolls: Sequence[int] = DEFAULT_ROLLS, series_keys: Sequence[str] = (),
                 y: str = "y", ds: str = "ds") -> DataFrame:
    """``lag_k`` = y k rows back; ``roll_n`` = full-window mean of the n rows before."""
    w = _window(series_keys, ds)
    cols = {f"lag_{k}": F.lag(y, k).over(w) for k in lags}
    cols.update({f"roll_{n}": rolling_history_mean(y, n, series_keys, ds) for n in rolls})
    return df.withColumns(cols)


def drop_null_rows(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Drop a row if any column (but those named) is NULL."""
    return df.dropna(how="any", subset=[c for c in df.columns if c not in but])


def lag_features_complete(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS,
                          series_keys: Sequence[str] = ()) -> DataFrame:
    """Lags + rolling means, then rows with any NULL removed (the first 28 rows go).

    A NULL series key names a series; it is no missing value.
    """
    return drop_null_rows(lag_features(df, lags=lags, series_keys=series_keys), series_keys)


def model_frame(daily: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Calendar + lag features with NULL rows dropped: the tree model's input."""
    return lag_features_complete(time_features(daily), series_keys=series_keys)


def with_position_from_end(df: DataFrame, series_keys: Sequence[str] = (),
                           ds: str = "ds") -> DataFrame:
    """Adds ``_pos_end`` (1 = last row) and ``_n`` (rows in the series)."""
    keys = list(series_keys)
    w_desc = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(F.col(ds).desc())
    w_all = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return df.withColumns({"_pos_end": F.row_number().over(w_desc),
                           "_n": F.count(F.lit(1)).over(w_all)})


def time_split(df: DataFrame, test_days: int = 60, series_keys: Sequence[str] = (),
               ds: str = "ds") -> DataFrame:
    """Adds ``split``: the last ``test_days`` rows are 'test' when the series is longer
    than that; otherwise every row is 'train' (and the test set is empty)."""
    p = with_position_from_end(df, series_keys, ds)
    split = F.when((F.col("_n") > test_days) & (F.col("_pos_end") <= test_days), "test") \
        .otherwise("train")
    return p.withColumn("split", split).drop("_pos_end", "_n")


def tail_rows(df: DataFrame, n: int, series_keys: Sequence[str] = (), ds: str = "ds",
              skip: int = 0) -> DataFrame:
    """Rows ``skip+1 .. skip+n`` counted from the end (``tail(n)``, ``iloc[-60:-30]``)."""
    if not series_keys and not skip:
        return df.orderBy(F.col(ds).desc()).limit(n)
    p = with_position_from_end(df, series_keys, ds)
    return (p.where((F.col("_pos_end") > skip) & (F.col("_pos_end") <= skip + n))
            .drop("_pos_end", "_n"))


def tail_mean(daily: DataFrame, n: int = 7, series_keys: Sequence[str] = (),
              y: str = "y", alias: str = "tail_mean") -> DataFrame:
    """Mean of the last ``n`` historical y per series."""
    keys = list(series_keys)
    return tail_rows(daily, n, keys).groupBy(*keys).agg(F.avg(y).alias(alias))


def future_calendar(daily: DataFrame, horizon: int, series_keys: Sequence[str] = (),
                    ds: str = "ds") -> DataFrame:
    """The ``horizon`` consecutive days after each series' last day."""
    keys = list(series_keys)
    last = daily.groupBy(*keys).agg(F.max(ds).alias("_last"))
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))
    return last.select(*keys, F.explode(days).alias(ds))


def append_future_rows(daily: DataFrame, horizon: int, series_keys: Sequence[str] = (),
                       ds: str = "ds", y: str = "y") -> DataFrame:
    """History (ds, y) followed by ``horizon`` future days whose y is NULL; y that is no number is too."""
    keys = list(series_keys)
    hist = daily.select(*keys, ds, to_numeric(y).alias(y))
    fut = future_calendar(daily, horizon, keys, ds).withColumn(y, F.lit(None).cast("double"))
    return hist.unionByName(fut)


def forecast_flat(daily: DataFrame, horizon: int = 60, n: int = 7,
                  series_keys: Sequence[str] = ()) -> DataFrame:
    """The dashboard's actual forecast: the constant mean of the last ``n`` y per future day.

    (The target row of a future day always has y = NULL, the NULL-row drop
    removes it, and the fallback mean is used for every step.)
    """
    keys = list(series_keys)
    # last day and mean in one aggregate: no join, so a series with a NULL key keeps its mean
    series = with_position_from_end(daily, keys).groupBy(*keys).agg(
        F.max("ds").alias("_last"), F.avg(F.when(F.col("_pos_end") <= n, F.col("y"))).alias("yhat"))
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))
    return series.select(*keys, F.explode(days).alias("ds"), "yhat")
