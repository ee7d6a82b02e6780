"""Golden values on the shipped 612-day daily series (read-only input file).

"""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martwright.operators import features, insights, marts
from martwright.schemas import DAILY

# Path of the shipped daily series (ds, y, orders, items) CSV, supplied by the caller.
GOLDEN = os.environ.get("MARTWRIGHT_GOLDEN_DAILY", "")


@pytest.fixture(scope="module")
def daily(spark):
    if not GOLDEN or not os.path.exists(GOLDEN):
        pytest.skip("set MARTWRIGHT_GOLDEN_DAILY to the shipped daily series CSV")
    raw = spark.read.option("header", True).csv(GOLDEN)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DAILY.fields]).cache()


def test_series_shape(daily):
    assert daily.count() == 612
    k = marts.kpi_summary(daily).first()
    assert (k.min_date, k.max_date) == (dt.date(2016, 9, 15), dt.date(2018, 8, 29))
    assert round(k.total_gmv, 2) == 15419773.75
    assert (k.total_orders, k.total_items) == (96478, 110197)
    assert k.avg_daily_gmv == pytest.approx(25195.708741830065, rel=1e-12)


def test_insights(daily):
    kpi = marts.kpi_summary(daily)
    texts = [r.insight for r in insights.insights_all(kpi, daily).orderBy("rank").collect()]
    assert texts == [
        "Total GMV is 15419773.75 (BRL) across the dataset period.",
        "GMV is up 6.5% in the last 30 days vs the previous 30 days.",
        "Highest average GMV day is Monday.",
    ]
    best = insights.best_weekday(daily).first()
    assert best.mean_y == pytest.approx(28751.06852272727, rel=1e-12)
    s = insights.trend_stats(daily).first()
    assert round(s.last30, 2) == 1038259.90 and round(s.prev30, 2) == 975039.02


def test_feature_rows_and_split(daily):
    frame = features.model_frame(daily)
    assert frame.count() == 584
    split = features.time_split(frame, 60)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": 524, "test": 60}
    rng = split.where(F.col("split") == "test").agg(F.min("ds"), F.max("ds")).first()
    assert tuple(rng) == (dt.date(2018, 7, 1), dt.date(2018, 8, 29))


def test_flat_forecast(daily):
    out = features.forecast_flat(daily, 60, 7).orderBy("ds").collect()
    assert len(out) == 60
    assert out[0].ds == dt.date(2018, 8, 30) and out[-1].ds == dt.date(2018, 10, 28)
    assert all(r.yhat == pytest.approx(9099.648571428572, rel=1e-12) for r in out)


def test_gaps_preserved(daily):
    days = [r.ds for r in daily.orderBy("ds").collect()]
    gaps = [(a, (b - a).days) for a, b in zip(days, days[1:]) if (b - a).days > 1]
    assert (dt.date(2016, 9, 15), 18) in gaps and (dt.date(2016, 10, 10), 74) in gaps
