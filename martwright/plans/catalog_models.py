"""RFM segmentation and forecasting-model queries."""

from __future__ import annotations

import math
from dataclasses import asdict

from pyspark.sql import functions as F

from martwright.operators import boosting, forecasting, seasonal, segmentation
from martwright.operators.features import model_frame, time_split
from martwright.operators.sampling import sample_exact_n
from martwright.plans.context import Context
from martwright.plans.model_store import ModelStore
from martwright.plans.registry import register
from martwright.schemas import GBT_FEATURES
from martwright.session import checkpoint, scratch_path
from martwright.sinks.tables import write_table

MONEY = 2
Z = 6

RFM_SQL = """SELECT customer_unique_id,
       CAST(date_diff('day', max(order_purchase_date),
            (SELECT max(order_purchase_date) FROM delivered_items) + 1) AS BIGINT) AS recency,
       count(DISTINCT order_id) AS frequency,
       coalesce(sum(item_gmv), 0.0) AS monetary
FROM delivered_items GROUP BY customer_unique_id"""

RFM_SCALE_SQL = f"""SELECT r.*,
       CASE WHEN rs > 0 THEN (recency - rm) / rs ELSE 0.0 END AS recency_z,
       CASE WHEN fs > 0 THEN (frequency - fm) / fs ELSE 0.0 END AS frequency_z,
       CASE WHEN ms > 0 THEN (monetary - mm) / ms ELSE 0.0 END AS monetary_z
FROM ({RFM_SQL}) r,
     (SELECT avg(recency) AS rm, stddev_pop(recency) AS rs, avg(frequency) AS fm,
             stddev_pop(frequency) AS fs, avg(monetary) AS mm, stddev_pop(monetary) AS ms
      FROM ({RFM_SQL}) x) s"""


@register("rfm", RFM_SQL, rounding={"monetary": MONEY})
def rfm(ctx: Context):
    """Recency / frequency / monetary per customer, as-of = last purchase + 1 day."""
    return segmentation.rfm(ctx.delivered_items(), materialise=checkpoint)


@register("rfm_scale", RFM_SCALE_SQL,
          rounding={"monetary": MONEY, "recency_z": Z, "frequency_z": Z, "monetary_z": Z})
def rfm_scale(ctx: Context):
    """Population z-scores of the three RFM columns."""
    # the per-customer table is stored once; the statistics and the projection read it
    return segmentation.rfm_scale(checkpoint(segmentation.rfm(ctx.delivered_items(), materialise=checkpoint)))


K, SEED, SCATTER = 4, 42, 500  # the dashboard shows 5,000 points at most; 500 is below the test tables

_XYZ = ("x", "y", "z")


def _dist(a: str, b: str) -> str:
    return " + ".join(f"(CAST({a}.{v} AS DOUBLE) - {b}.{v}) * (CAST({a}.{v} AS DOUBLE) - {b}.{v})" for v in _XYZ)


def _start_sql() -> str:
    """Farthest-first start: one table of centres after the other."""
    out = "s0 AS (SELECT 0 AS k, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z FROM few ORDER BY h, id LIMIT 1)"
    for k in range(1, K):
        out += f""", s{k} AS (SELECT * FROM s{k - 1} UNION ALL (
          SELECT {k}, CAST(any_value(p.x) AS DOUBLE), CAST(any_value(p.y) AS DOUBLE), CAST(any_value(p.z) AS DOUBLE)
          FROM few p, s{k - 1} c GROUP BY p.id, p.h ORDER BY min({_dist("p", "c")}) DESC, p.h, p.id LIMIT 1))"""
    return out


def _moved_sql(v: str) -> str:
    return f"coalesce(CAST(sum(a.{v}) AS DOUBLE) / count(a.{v}), any_value(l.{v}))"


SEGMENTS_SQL = f"""WITH RECURSIVE scaled AS MATERIALIZED ({RFM_SCALE_SQL}),
points AS MATERIALIZED (
  SELECT customer_unique_id AS id, md5('{SEED}:' || customer_unique_id) AS h, recency, frequency, monetary,
         CAST(floor(recency_z * 1000000.0 + 0.5) AS BIGINT) AS x,
         CAST(floor(frequency_z * 1000000.0 + 0.5) AS BIGINT) AS y,
         CAST(floor(monetary_z * 1000000.0 + 0.5) AS BIGINT) AS z FROM scaled),
few AS MATERIALIZED (SELECT * FROM points ORDER BY h, id LIMIT {segmentation.START_ROWS}),
{_start_sql()},
lloyd AS (
  SELECT 0 AS step, k, x, y, z, true AS moved FROM s{K - 1}
  UNION ALL
  SELECT step + 1, k, nx, ny, nz, bool_or(nx <> x OR ny <> y OR nz <> z) OVER ()
  FROM (SELECT l.k, any_value(l.step) AS step, any_value(l.x) AS x, any_value(l.y) AS y, any_value(l.z) AS z,
               {_moved_sql("x")} AS nx, {_moved_sql("y")} AS ny, {_moved_sql("z")} AS nz
        FROM lloyd l LEFT JOIN (
          SELECT p.id, any_value(p.x) AS x, any_value(p.y) AS y, any_value(p.z) AS z,
                 min([{_dist("p", "c")}, CAST(c.k AS DOUBLE)])[2] AS k
          FROM points p, lloyd c GROUP BY p.id) a ON a.k = l.k
        WHERE l.moved AND l.step < 300 GROUP BY l.k)),
labelled AS (
  SELECT p.id AS customer_unique_id, any_value(p.recency) AS recency, any_value(p.frequency) AS frequency,
         any_value(p.monetary) AS monetary, min([{_dist("p", "c")}, CAST(c.k AS DOUBLE)])[2] AS k
  FROM points p, (SELECT * FROM lloyd WHERE step = (SELECT max(step) FROM lloyd)) c GROUP BY p.id),
ranks AS (SELECT k, CAST(row_number() OVER (ORDER BY avg(monetary) DESC, k) - 1 AS INTEGER) AS segment
          FROM labelled GROUP BY k)
SELECT customer_unique_id, recency, frequency, monetary, segment FROM labelled JOIN ranks USING (k)"""

PROFILE_SQL = f"""SELECT segment, avg(recency) AS recency, avg(frequency) AS frequency, avg(monetary) AS monetary,
       count(*) AS customers FROM ({SEGMENTS_SQL}) s GROUP BY segment"""
_PROFILE_ROUND = {"recency": Z, "frequency": Z, "monetary": Z}


def _segments(ctx: Context):
    _, scored = segmentation.segment_customers(ctx.delivered_items(), k=K, seed=SEED)
    return scored


@register("rfm_kmeans", SEGMENTS_SQL, rounding={"monetary": MONEY})
def rfm_kmeans(ctx: Context):
    """KMeans (k=4) segment per customer, segments renumbered by mean monetary."""
    return _segments(ctx)


@register("segment_profile", PROFILE_SQL, rounding=_PROFILE_ROUND)
def segment_profile(ctx: Context):
    """Mean R/F/M and size per segment, highest monetary first."""
    return segmentation.segment_profile(_segments(ctx))


@register("rfm_scatter_sample", f"""SELECT * FROM ({SEGMENTS_SQL}) s
          ORDER BY md5('42:' || customer_unique_id) LIMIT {SCATTER}""", rounding={"monetary": MONEY})
def rfm_scatter_sample(ctx: Context):
    """Scored customers for the scatter plot, an exact-size deterministic sample."""
    return sample_exact_n(_segments(ctx), SCATTER, ["customer_unique_id"], seed=42)


@register("segments_by_monetary", PROFILE_SQL, rounding=_PROFILE_ROUND)
def segments_by_monetary(ctx: Context):
    """Segment profile ordered by mean monetary, highest first."""
    return segmentation.segment_profile(_segments(ctx)).orderBy(F.col("monetary").desc())


@register("scan_parquet_rfm", SEGMENTS_SQL, rounding={"monetary": MONEY})
def scan_parquet_rfm(ctx: Context):
    """Scored customers persisted as Parquet, then read back for the customer page."""
    path = scratch_path(ctx.spark, "rfm-scored")
    _segments(ctx).write.mode("overwrite").parquet(path)
    return ctx.spark.read.parquet(path)


@register("save_models", SEGMENTS_SQL, rounding={"monetary": MONEY})
def save_models(ctx: Context):
    """Scaler and centres persisted and read back; the reloaded ones scale and label the customers."""
    r = checkpoint(segmentation.rfm(ctx.delivered_items(), materialise=checkpoint))
    path = scratch_path(ctx.spark, "kmeans-model")
    stats = write_table(ctx.spark, segmentation.scaling_stats(r), f"{path}/scaler")
    scaled = segmentation.rfm_scale(r, stats=stats)
    centres = write_table(ctx.spark, segmentation.fit_kmeans(scaled, K, SEED), f"{path}/centres")
    return segmentation.assign_segments(centres, scaled)


def _daily(ctx: Context):
    """The daily series, stored once: training, state and metrics read it several times."""
    return checkpoint(ctx.mart("mart_sales_daily"))


def gbt_entry(ctx: Context, daily, keys: tuple[str, ...] = ()):
    """The tree model of a daily series from the model store: its ensembles and holdout metrics."""
    settings = boosting.Settings()

    def fit():
        made = forecasting.train_gbt(daily, test_days=60, series_keys=keys, settings=settings)
        return {"model": made.model, "metrics": made.metrics}

    return ModelStore(ctx.spark).get("gbt", {"daily": daily.select(*keys, "ds", "y")},
                                     asdict(settings) | {"test_days": 60, "keys": list(keys)}, GBT_FEATURES, fit)


def trained(ctx: Context):
    """Tables of the training job for these marts, from the model store."""
    from martwright.plans.training import fit_all
    daily = _daily(ctx)
    rfm_rows = checkpoint(segmentation.rfm(ctx.delivered_items(), materialise=checkpoint))
    n_items = ctx.delivered_items()
    parameters = asdict(boosting.Settings()) | {"test_days": 60, "k": K, "seed": SEED, "penalty": seasonal.PENALTY,
                                                "change_points": seasonal.CHANGE_POINTS}
    return daily, ModelStore(ctx.spark).get(
        "train-all", {"daily": daily, "rfm": rfm_rows, "items": n_items.agg(F.count("*").alias("n"))}, parameters,
        GBT_FEATURES, lambda: fit_all(ctx.spark, daily, rfm_rows, n_items, k=K))


@register("forecast_gbt_train")
def forecast_gbt_train(ctx: Context):
    """Boosted trees (800, step 0.03, depth 6) on 12 features, 60-row holdout → MAE/RMSE/MAPE."""
    metrics = gbt_entry(ctx, _daily(ctx)).tables["metrics"]
    return metrics.select(F.lit("gbt").alias("model"), "mae", "rmse", "mape")


@register("forecast_seasonal_train")
def forecast_seasonal_train(ctx: Context):
    """Piecewise trend × seasonality regression, 60-row holdout → MAE/RMSE/MAPE."""
    made = forecasting.train_seasonal(_daily(ctx), test_days=60)
    return made.metrics.select(F.lit("seasonal").alias("model"), "mae", "rmse", "mape")


def _number(x: float) -> str:
    return f"{x!r}e0"  # a DOUBLE, not a DECIMAL


def _gram_sql() -> str:
    """Gram sums as cosines of the columns (1, terms, y) and the logarithms of their squared lengths."""
    hinges = ", ".join(f"greatest({_number(0.0)}, u - {_number(seasonal.CHANGE_RANGE * j / (seasonal.CHANGE_POINTS + 1))})"
                       for j in range(1, seasonal.CHANGE_POINTS + 1))
    waves = [f"{f}(d * {_number(2.0 * math.pi * k / period)})"
             for period, order in ((seasonal.YEARLY_PERIOD, seasonal.YEARLY_ORDER),
                                   (seasonal.WEEKLY_PERIOD, seasonal.WEEKLY_ORDER))
             for k in range(1, order + 1) for f in ("sin", "cos")]
    size = 3 + seasonal.CHANGE_POINTS + 2 * len(waves)
    return f"""WITH daily AS (
  SELECT customer_state, order_purchase_date AS ds, CAST(sum(item_gmv) AS DOUBLE) AS y FROM mart_order_items
  WHERE order_status = 'delivered' AND order_purchase_date IS NOT NULL GROUP BY 1, 2),
train AS (
  SELECT customer_state, ds, y, CAST(ds - min(ds) OVER s AS DOUBLE) AS d,
         CAST(ds - min(ds) OVER s AS DOUBLE) / CAST(greatest(max(ds) OVER s - min(ds) OVER s, 1) AS DOUBLE) AS u
  FROM (SELECT *, count(*) OVER (PARTITION BY customer_state) AS n,
               row_number() OVER (PARTITION BY customer_state ORDER BY ds DESC) AS back FROM daily) q
  WHERE n <= 60 OR back > 60
  WINDOW s AS (PARTITION BY customer_state)),
rows AS (SELECT customer_state, CAST([1.0, u, {hinges}, {", ".join(waves)}, {", ".join(f"u * {w}" for w in waves)}, y]
                                     AS DOUBLE[]) AS v FROM train),
sums AS (SELECT customer_state, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, sum(v[i + 1] * v[j + 1]) AS total
         FROM rows, (SELECT unnest(range({size})) AS i) a, (SELECT unnest(range({size})) AS j) b
         WHERE i <= j GROUP BY ALL)
SELECT g.customer_state, g.i, g.j,
       CASE WHEN abs(g.total) >= 5e-7 * sqrt(a.total * b.total) AND a.total * b.total > 0
            THEN g.total / sqrt(a.total * b.total) ELSE 0.0 END AS cosine,
       CASE WHEN a.total > 0 THEN ln(a.total) END AS log_square
FROM sums g
JOIN sums a ON a.customer_state IS NOT DISTINCT FROM g.customer_state AND a.i = g.i AND a.j = g.i
JOIN sums b ON b.customer_state IS NOT DISTINCT FROM g.customer_state AND b.i = g.j AND b.j = g.j"""


@register("seasonal_gram_by_state", _gram_sql(), rounding={"cosine": Z, "log_square": Z})
def seasonal_gram_by_state(ctx: Context):
    """Sums of products that the seasonal fit of every state series is solved from, as cosines."""
    keys = ["customer_state"]
    rows = seasonal.frame(_state_daily(ctx), 60, keys)
    sums = seasonal.gram_sums(rows.where("split = 'train' AND y IS NOT NULL"), keys)
    at = F.map_from_entries(F.collect_list(F.struct("i", "total")))
    squares = sums.where("i = j").groupBy(F.col("customer_state").alias("s")).agg(at.alias("square"))
    both = F.col("square")[F.col("i")] * F.col("square")[F.col("j")]
    return (sums.join(squares, F.col("customer_state").eqNullSafe(F.col("s")))
            .select("customer_state", "i", "j",
                    F.when((both > 0) & (F.abs("total") >= 5e-7 * F.sqrt(both)), F.col("total") / F.sqrt(both))
                    .otherwise(0.0).alias("cosine"),
                    F.when(F.col("square")[F.col("i")] > 0, F.ln(F.col("square")[F.col("i")])).alias("log_square")))


@register("forecast_seasonal_by_state")
def forecast_seasonal_by_state(ctx: Context):
    """A seasonal model per state series, 60-row holdouts → MAE/RMSE/MAPE of every state."""
    return forecasting.train_seasonal(_state_daily(ctx), 60, ["customer_state"]).metrics


@register("load_models")
def load_models(ctx: Context):
    """The stored tree model, read back from the model store, scores the holdout."""
    daily = _daily(ctx)
    model = gbt_entry(ctx, daily).tables["model"]
    frame = time_split(model_frame(daily), 60).where(F.col("split") == "test")
    return boosting.score(model, frame, GBT_FEATURES).select("ds", "y", "yhat")


@register("forecast_recursive")
def forecast_recursive(ctx: Context):
    """Recursive 60-day forecast with the tree model (ŷ fed back as history)."""
    daily = _daily(ctx)
    return forecasting.forecast_recursive(gbt_entry(ctx, daily).tables["model"], daily, horizon=60)


@register("train_all")
def train_all_q(ctx: Context):
    """Training job (both forecasters, RFM + KMeans); one row of holdout metrics per model."""
    _, entry = trained(ctx)
    return entry.tables["metrics"].select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("model"), *[F.col(f"{m}.{c}").alias(c) for c in ("mae", "rmse", "mape")])
                           for m in ("seasonal", "gbt")])), "rows_daily", "rows_order_items", "rows_rfm")


@register("model_checks", f"""
    SELECT 'rows_daily' AS name, CAST(count(*) AS DOUBLE) AS value FROM mart_sales_daily
    UNION ALL SELECT 'rows_order_items', count(*) FROM delivered_items
    UNION ALL SELECT 'rows_rfm', count(*) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'scored_customers', count(*) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'scored_recency', sum(recency) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'scored_frequency', sum(frequency) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'scored_monetary', sum(monetary) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'profile_customers', count(*) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'profile_monetary', sum(monetary) FROM ({RFM_SQL}) r
    UNION ALL SELECT 'forecast_days', 60
    UNION ALL SELECT 'forecast_first', max(ds) - DATE '1970-01-01' + 1 FROM mart_sales_daily
    UNION ALL SELECT 'forecast_last', max(ds) - DATE '1970-01-01' + 60 FROM mart_sales_daily
    UNION ALL SELECT 'reloaded_' || m, CASE m WHEN 'gbt' THEN 60 WHEN 'seasonal' THEN 60
                     ELSE (SELECT count(*) FROM ({RFM_SQL}) r) END
              FROM (VALUES ('gbt'), ('seasonal'), ('kmeans')) AS t(m)""", rounding={"value": MONEY})
def model_checks(ctx: Context):
    """What is certain about the trained models: counts, sums over scored customers and segments,
    the forecast's calendar, and rows that the stored models score as the job did when it fitted them."""
    daily, entry = trained(ctx)
    t = entry.tables
    metrics, scored = t["metrics"], t["rfm_scored"]
    profile = segmentation.segment_profile(scored)
    future = forecasting.forecast_recursive(t["gbt"], daily, horizon=60)
    days = F.datediff("ds", F.lit("1970-01-01").cast("date"))

    def one(name, df, value):
        return df.agg(value.cast("double").alias("value")).select(F.lit(name).alias("name"), "value")

    def agree(name, again, kept, output, key):
        same = again.select(key, F.col(output).alias("_again")).join(kept, key).where(F.col(output) == F.col("_again"))
        return one(f"reloaded_{name}", same, F.count("*"))

    gbt_rows = forecasting.eval_frame(time_split(model_frame(daily), 60))
    seasonal_rows = forecasting.eval_frame(seasonal.frame(daily, 60)).select("ds", "y")
    checks = [one(c, metrics, F.max(c)) for c in ("rows_daily", "rows_order_items", "rows_rfm")]
    checks += [one("scored_customers", scored, F.count("*"))]
    checks += [one(f"scored_{c}", scored, F.sum(c)) for c in segmentation.RFM_COLUMNS]
    checks += [one("profile_customers", profile, F.sum("customers")),
               one("profile_monetary", profile, F.sum(F.col("monetary") * F.col("customers"))),
               one("forecast_days", future.where("yhat IS NOT NULL"), F.count_distinct("ds")),
               one("forecast_first", future, F.min(days)), one("forecast_last", future, F.max(days)),
               agree("gbt", boosting.score(t["gbt"], gbt_rows, GBT_FEATURES), t["gbt_holdout"], "yhat", "ds"),
               agree("seasonal", seasonal.score(t["seasonal"], seasonal_rows), t["seasonal_holdout"], "yhat", "ds"),
               agree("kmeans", segmentation.assign_segments(t["rfm_kmeans"], segmentation.rfm_scale(
                   t["rfm"], stats=t["rfm_scaler"])), scored, "segment", "customer_unique_id")]
    result = checks[0]
    for c in checks[1:]:
        result = result.unionByName(c)
    return result


def _state_daily(ctx: Context):
    from martwright.operators.marts import mart_sales_daily
    facts = ctx.items("customer_state", "order_status", "order_purchase_date", "order_id",
                      "item_gmv")
    return checkpoint(mart_sales_daily(facts, ["customer_state"]))


@register("forecast_recursive_by_state")
def forecast_recursive_by_state(ctx: Context):
    """A tree model per state series; 60-day recursive forecast of all of them in one pass."""
    daily = _state_daily(ctx)
    model = gbt_entry(ctx, daily, ("customer_state",)).tables["model"]
    return forecasting.forecast_recursive(model, daily, horizon=60, series_keys=["customer_state"])
