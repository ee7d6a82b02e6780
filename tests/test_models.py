"""Forecasting and segmentation: fits against plain forms, stored models, invariants."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.operators import boosting, features, forecasting, seasonal, segmentation
from martwright.plans.context import Context
from martwright.plans.model_store import ModelStore, rows_digest
from martwright.schemas import GBT_FEATURES
from martwright.session import checkpoint, scratch_path

FEW = boosting.Settings(trees=30, step=0.2)


@pytest.fixture(scope="module")
def daily(spark):
    """The daily series of the sf0.01 tables, stored once."""
    return checkpoint(Context(spark, "/root/testdata/sf0.01").mart("mart_sales_daily"))


@pytest.fixture(scope="module")
def gbt(daily):
    return forecasting.train_gbt(daily, test_days=60, settings=FEW)


@pytest.fixture(scope="module")
def two_series(spark):
    """Two series of weekly ups and downs, one with a NULL key, and a short one."""
    rows = []
    for k, n, high in (("a", 200, 100.0), (None, 150, 500.0), ("short", 10, 5.0)):
        rows += [(k, dt.date(2021, 1, 1) + dt.timedelta(days=i), high + (i % 7) * high / 10 + i % 3)
                 for i in range(n)]
    return checkpoint(spark.createDataFrame(rows, "k string, ds date, y double"))


# ------------------------------------------------------------- tree model


def test_full_default_finishes(daily):
    """All 800 trees of depth 6; no smaller setting stands in for them."""
    assert (boosting.TREES, boosting.STEP, boosting.DEPTH) == (800, 0.03, 6)
    res = forecasting.train_gbt(daily, test_days=60)
    model = res.model.first()
    assert len(model.root) == 800
    assert max(depths(model)) == 6
    m = res.metrics.first()
    assert res.predictions.count() == 60
    zero = res.predictions.select(F.avg(F.abs("y"))).first()[0]
    assert 0 < m.mae < zero and m.rmse >= m.mae and m.mape > 0
    assert res.features == GBT_FEATURES


def depths(model):
    out = []
    for root in model.root[:20]:
        todo = [(root, 0)]
        while todo:
            at, d = todo.pop()
            if model.feature[at] < 0:
                out.append(d)
            else:
                todo += [(model.child[at], d + 1), (model.child[at] + 1, d + 1)]
    return out


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(200, 3)).round(1), rng.normal(size=200)
    y += 2 * (x[:, 1] > 0.3)
    e = boosting.fit(x, y, boosting.Settings(trees=1, step=1.0, depth=1, subsample=1.1, feature_share=1.0), 0)
    g = y - y.mean()
    best = max((sum(v.sum() ** 2 / (len(v) + 1.0) for v in (g[x[:, f] < c], g[x[:, f] >= c])), f, c)
               for f in range(3) for c in (np.unique(x[:, f])[1:] + np.unique(x[:, f])[:-1]) / 2)
    assert (e.feature[0], e.threshold[0]) == (best[1], pytest.approx(best[2]))
    for side, node in ((x[:, best[1]] < best[2], 1), (x[:, best[1]] >= best[2], 2)):
        assert e.value[node] == pytest.approx(g[side].sum() / (side.sum() + 1.0))


def test_predictions_walk_the_nodes_and_boosting_descends():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = x[:, 0] * x[:, 1] + np.sin(3 * x[:, 2])
    e = boosting.fit(x, y, boosting.Settings(trees=60, step=0.2), 1)

    def walk(row):
        total = e.base
        for at in e.root:
            while e.feature[at] >= 0:
                at = e.child[at] + (row[e.feature[at]] >= e.threshold[at])
            total += e.value[at]
        return total

    got = e.predict(x)
    assert np.allclose(got, [walk(r) for r in x])
    assert np.abs(got - y).mean() < 0.25 * np.abs(y - y.mean()).mean()
    again = boosting.fit(x, y, boosting.Settings(trees=60, step=0.2), 1)
    assert (again.predict(x) == got).all()
    flat = boosting.fit(x, np.full(300, 7.0), FEW, 1)
    assert (flat.predict(x) == 7.0).all() and len(flat.feature) == FEW.trees


def test_every_series_has_its_own_trees(spark, two_series):
    keys = ["k"]
    res = forecasting.train_gbt(two_series, test_days=20, series_keys=keys, settings=FEW)
    assert {r.k for r in res.model.select("k").collect()} == {"a", None}  # the short one has no feature row
    metrics = {r.k: r.mae for r in res.metrics.collect()}
    assert set(metrics) == {"a", None} and metrics[None] < 60 and metrics["a"] < 12
    # the same trees as the series alone gives under its name
    alone = forecasting.train_gbt(two_series.where("k = 'a'"), 20, keys, FEW).model.first()
    assert alone == res.model.where("k = 'a'").first()


def test_recursive_steps_match_feature_rows(daily, gbt):
    last = daily.agg(F.max("ds")).first()[0]
    out = forecasting.forecast_recursive(gbt.model, daily, horizon=3).orderBy("ds").collect()
    assert [r.ds for r in out] == [last + dt.timedelta(days=k) for k in (1, 2, 3)]
    # brute force: features over history + the earlier predictions written back as y
    spark = daily.sparkSession
    hist = daily.select("ds", "y")
    for i in range(3):
        fed = hist.unionByName(spark.createDataFrame(
            [(r.ds, float(r.yhat)) for r in out[:i]] + [(out[i].ds, None)], "ds date, y double"))
        row = (features.lag_features(features.time_features(fed))
               .where(F.col("ds") == out[i].ds))
        assert out[i].yhat == pytest.approx(boosting.score(gbt.model, row, GBT_FEATURES).first().yhat, rel=1e-9)


def test_recursive_is_one_job_for_all_series(spark, two_series):
    keys = ["k"]
    model = forecasting.train_gbt(two_series, 20, keys, FEW).model
    sc = spark.sparkContext
    sc.setJobGroup("recursive-test", "")
    out = forecasting.forecast_recursive(model, two_series, 60, keys)
    assert len(sc.statusTracker().getJobIdsForGroup("recursive-test")) == 0  # nothing runs while it is built
    rows = out.collect()
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == 180 and len({(r.k, r.ds) for r in rows}) == 180
    # the short series has no ensemble: always the historical 7-row mean
    short = two_series.where("k = 'short'").orderBy(F.desc("ds")).limit(7).agg(F.avg("y")).first()[0]
    assert all(r.yhat == pytest.approx(short) for r in rows if r.k == "short")
    assert all(400 < r.yhat < 1000 for r in rows if r.k is None)


def test_recursive_short_series_falls_back(spark, gbt):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i), 1, 1) for i in range(10)]
    short = spark.createDataFrame(rows, "ds date, y double, orders bigint, items bigint")
    out = forecasting.forecast_recursive(gbt.model, short, horizon=25).orderBy("ds").collect()
    # 10 history rows + 18 fallback steps < 28: every step uses the historical 7-row mean
    assert all(r.yhat == pytest.approx(sum(range(3, 10)) / 7) for r in out[:18])
    assert len(out) == 25


def test_empty_daily_gives_empty_models(spark, two_series):
    none = two_series.where("false")
    assert forecasting.train_gbt(none, 20, ["k"], FEW).metrics.count() == 0
    assert forecasting.train_seasonal(none, 20, ["k"]).metrics.count() == 0


# -------------------------------------------------------- seasonal model


def design(frame, origin, span, points):
    d = np.array([(x - origin).days for x in frame.ds], dtype=float)
    u = d / span
    waves = []
    for period, order in ((365.25, 2), (7.0, 3)):
        for k in range(1, order + 1):
            waves += [np.sin(2 * np.pi * k * d / period), np.cos(2 * np.pi * k * d / period)]
    hinges = [np.maximum(0.0, u - 0.8 * j / (points + 1)) for j in range(1, points + 1)]
    return np.column_stack([u, *hinges, *waves, *[u * w for w in waves]])


@pytest.mark.parametrize("penalty", [1e-9, 0.08])
def test_seasonal_fit_matches_numpy(spark, sf_small, penalty):
    """The solution from Gram sums equals ridge regression on an independently built design."""
    rows = Context(spark, sf_small).mart("mart_sales_daily").orderBy("ds").toPandas()
    res = forecasting.train_seasonal(spark.createDataFrame(rows), test_days=60, penalty=penalty)
    pred = res.predictions.orderBy("ds").toPandas()
    train, test = rows.iloc[:-60], rows.iloc[-60:]
    origin, span = train.ds.min(), (train.ds.max() - train.ds.min()).days
    x, y = design(train, origin, span, seasonal.CHANGE_POINTS), train.y.to_numpy()
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / sd
    b = np.linalg.solve(z.T @ z / len(y) + penalty * np.eye(z.shape[1]), z.T @ (y - y.mean()) / len(y))
    expect = (design(test, origin, span, seasonal.CHANGE_POINTS) - mean) / sd @ b + y.mean()
    assert np.allclose(pred.yhat.to_numpy(), expect, rtol=1e-4, atol=1e-4 * y.mean())


def test_seasonal_follows_a_change_of_trend(spark):
    """A series that rises, then falls: the piecewise trend turns, one line through all can't."""
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), 1000.0 + min(i, 600) - 0.5 * max(0, i - 600)) for i in range(1200)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    mae = {n: forecasting.train_seasonal(df, 60, ["k"], penalty=1e-6, points=n).metrics.first().mae for n in (1, 10)}
    assert 3 * mae[10] < mae[1]


def test_seasonal_series_are_apart(spark, two_series):
    res = forecasting.train_seasonal(two_series, 20, ["k"])
    assert {r.k for r in res.metrics.collect()} == {"a", None, "short"}
    alone = forecasting.train_seasonal(two_series.where("k IS NULL").drop("k"), 20)
    assert alone.metrics.first().mae == pytest.approx(res.metrics.where("k IS NULL").first().mae)


def test_empty_test_set_gives_in_sample_metrics(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(100 + (i % 7) * 10), 1, 1)
            for i in range(50)]
    daily = spark.createDataFrame(rows, "ds date, y double, orders bigint, items bigint")
    res = forecasting.train_seasonal(daily, test_days=60)
    assert res.predictions.count() == 50  # all rows are train; scored in-sample


# ------------------------------------------------------------ model store


def test_store_loads_the_same_rows_and_refits_changed_ones(spark):
    root, fits = scratch_path(spark, "store"), []
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "2")], "x int, y string")

    def fit(rows):
        fits.append(1)
        return {"model": rows.agg(F.count("*").alias("n"))}

    def get(rows, parameters, store):
        return store.get("m", {"rows": rows}, parameters, ["x"], lambda: fit(rows))

    first = get(df, {"p": 1}, ModelStore(spark, root))
    assert first.fitted and first.manifest["features"] == ["x"] and first.manifest["parameters"] == {"p": 1}
    # another session of the store, the rows in another order and other partitions
    again = get(df.repartition(3).orderBy(F.desc("x")), {"p": 1}, ModelStore(spark, root))
    assert not again.fitted and again.tables["model"].first().n == 3 and len(fits) == 1
    changed = spark.createDataFrame([(1, "a"), (None, "2"), (2, "b")], "x int, y string")
    assert get(changed, {"p": 1}, ModelStore(spark, root)).fitted
    assert get(df, {"p": 2}, ModelStore(spark, root)).fitted
    assert len(fits) == 3
    assert rows_digest(df) != rows_digest(df.unionByName(df))
    assert rows_digest(df.where("false")) != rows_digest(df)


def test_an_unfinished_fit_is_not_served(spark):
    store = ModelStore(spark, scratch_path(spark, "store-died"))
    df = spark.range(5)

    def dies():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.get("m", {"rows": df}, {}, [], dies)
    assert store.get("m", {"rows": df}, {}, [], lambda: {"model": df}).fitted


# ----------------------------------------------------------- segmentation


def test_kmeans_segments_cover_customers_once(spark, sf_small):
    ctx = Context(spark, sf_small)
    items = ctx.delivered_items()
    model, scored = segmentation.segment_customers(items, k=4)
    n_rfm = segmentation.rfm(items).count()
    assert scored.count() == n_rfm == scored.select("customer_unique_id").distinct().count()
    segs = sorted(r.segment for r in scored.select("segment").distinct().collect())
    assert segs == [0, 1, 2, 3]
    prof = segmentation.segment_profile(scored).collect()
    assert [r.segment for r in prof] == [0, 1, 2, 3]  # renumbered by monetary, desc


def test_kmeans_ends_at_a_fixed_point(spark, sf_small):
    """Every label is the nearest centre, every centre the mean of its customers."""
    scaled = checkpoint(segmentation.rfm_scale(segmentation.rfm(Context(spark, sf_small).delivered_items())))
    model = segmentation.fit_kmeans(scaled, k=4)
    cols = segmentation.RFM_COLUMNS
    centres = model.orderBy("cluster").toPandas()[cols].to_numpy()
    pdf = segmentation.predict_cluster(model, scaled).toPandas()
    x = np.floor(pdf[[f"{c}_z" for c in cols]].to_numpy() * 1e6 + 0.5)
    nearest = np.argmin(((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2), axis=1)
    assert (nearest == pdf["_cluster"].to_numpy()).all()
    for k in range(4):
        assert np.allclose(x[nearest == k].mean(0), centres[k])


def test_kmeans_of_few_and_equal_customers(spark):
    schema = "customer_unique_id string, recency bigint, frequency bigint, monetary double"
    same = segmentation.rfm_scale(spark.createDataFrame([(f"c{i}", 1, 1, 5.0) for i in range(6)], schema))
    scored = segmentation.assign_segments(segmentation.fit_kmeans(same, k=4), same)
    assert {r.segment for r in scored.collect()} == {0}
    none = same.where("false")
    assert segmentation.assign_segments(segmentation.fit_kmeans(none, k=4), none).count() == 0


def test_metrics_nonnegative_and_mape_floor(spark):
    pred = spark.createDataFrame([(0.0, 1.0), (-2.0, -1.0), (4.0, 2.0)], "y double, yhat double")
    m = forecasting.forecast_metrics(pred).first()
    assert m.mae == pytest.approx(4 / 3)
    assert m.rmse == pytest.approx(((1 + 1 + 4) / 3) ** 0.5)
    # y=0 → |−1|/1e-9; y=−2 → floor 1e-9 (signed); y=4 → 0.5
    assert m.mape == pytest.approx((1e9 + 1e9 + 0.5) / 3 * 100)
