"""Serving, time-series feature and insight queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.operators import features, insights, serving
from martwright.operators.forecasting import forecast_metrics
from martwright.operators.marts import kpi_summary, mart_sales_daily
from martwright.plans.context import Context
from martwright.plans.registry import register
from martwright.session import checkpoint, scratch_path

MONEY = 2
MEAN = 6

# Calendar + lag/rolling columns of the daily series in DuckDB SQL.
_CAL = """CAST(isodow(ds) - 1 AS INTEGER) AS dow, CAST(weekofyear(ds) AS INTEGER) AS week,
          CAST(month(ds) AS INTEGER) AS month, CAST(year(ds) AS INTEGER) AS year,
          CAST(day(ds) AS INTEGER) AS day,
          CAST(CASE WHEN isodow(ds) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"""


def _lags_sql(part: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    cols = [f"lag(y, {k}) OVER ({p}ORDER BY ds) AS lag_{k}" for k in (1, 7, 14, 28)]
    for n in (7, 14):
        frame = f"({p}ORDER BY ds ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        cols.append(f"CASE WHEN count(y) OVER {frame} = {n} THEN avg(y) OVER {frame} END AS roll_{n}")
    return ", ".join(cols)


_LAG_ROUND = {"y": MONEY, "lag_1": MONEY, "lag_7": MONEY, "lag_14": MONEY, "lag_28": MONEY,
              "roll_7": MEAN, "roll_14": MEAN}
_MODEL_FRAME_SQL = f"""SELECT * FROM (SELECT ds, y, orders, items, {_CAL}, {_lags_sql()}
                                      FROM mart_sales_daily) f
    WHERE lag_28 IS NOT NULL AND roll_7 IS NOT NULL AND roll_14 IS NOT NULL
      AND lag_1 IS NOT NULL AND lag_7 IS NOT NULL AND lag_14 IS NOT NULL AND y IS NOT NULL"""
_POS_SQL = """SELECT *, row_number() OVER (ORDER BY ds DESC) AS pos_end,
                         count(*) OVER () AS n_rows FROM mart_sales_daily"""

# ------------------------------------------------------------- serving


def _state_facts(ctx: Context):
    return ctx.items("customer_state", "order_status", "order_purchase_date", "order_id",
                     "item_gmv")


@register("scan_table_daily", "SELECT ds, y, orders, items FROM mart_sales_daily",
          rounding={"y": MONEY})
def scan_table_daily(ctx: Context):
    """Daily mart read in day order."""
    return serving.daily_sorted(ctx.mart("mart_sales_daily"))


@register("top_categories",
          """SELECT CASE WHEN p_partkey % 61 <> 0 THEN lower(p_type) || '_en' END AS product_category_en,
                    sum(l_extendedprice + l_quantity) AS gmv
             FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
             WHERE o_orderstatus = 'F'
             GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
          rounding={"gmv": MONEY})
def top_categories(ctx: Context):
    """Top-15 categories by delivered GMV."""
    return serving.top_categories(ctx.items("product_category_en", "item_gmv", "order_status"))


@register("state_sales",
          """SELECT n_name AS customer_state, sum(spent) AS gmv, count(*) AS orders
             FROM (SELECT o_custkey, sum(l_extendedprice + l_quantity) AS spent FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                   WHERE o_orderstatus = 'F' GROUP BY o_orderkey, o_custkey) placed
                  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
             GROUP BY 1""",
          rounding={"gmv": MONEY})
def state_sales(ctx: Context):
    """Delivered GMV and distinct orders per customer state, largest first."""
    return serving.state_sales(ctx.items("customer_state", "item_gmv", "order_id", "order_status"))


@register("state_sales_top20",
          """SELECT n_name AS customer_state, sum(l_extendedprice + l_quantity) AS gmv,
                    count(DISTINCT o_orderkey) AS orders
             FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
             WHERE o_orderstatus = 'F'
             GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
          rounding={"gmv": MONEY})
def state_sales_top20(ctx: Context):
    """The 20 states with the largest delivered GMV."""
    return serving.state_sales_top(ctx.items("customer_state", "item_gmv", "order_id",
                                             "order_status"))


@register("row_counts",
          """SELECT 'mart_orders' AS t, count(*) AS rows FROM orders
             UNION ALL SELECT 'mart_order_items', count(*) FROM lineitem
             UNION ALL SELECT 'mart_sales_daily', count(DISTINCT CAST(o_orderdate AS DATE))
                       FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'
             UNION ALL SELECT 'dim_customers', count(*) FROM customer""")
def row_counts(ctx: Context):
    """(table, rows) for the four serving tables, as a UNION ALL."""
    return serving.row_counts({
        "mart_orders": ctx.mart("mart_orders"),
        "mart_order_items": ctx.mart("mart_order_items"),
        "mart_sales_daily": ctx.mart("mart_sales_daily"),
        "dim_customers": ctx.mart("dim_customers"),
    })


@register("kpi_card_values",
          """SELECT CAST(total_gmv AS DOUBLE) AS total_gmv, total_orders, total_items,
                    CAST(avg_daily_gmv AS DOUBLE) AS avg_daily_gmv FROM kpi_summary""",
          rounding={"total_gmv": MONEY, "avg_daily_gmv": MEAN})
def kpi_card_values(ctx: Context):
    """The four KPI card numbers with their display types."""
    return serving.kpi_card_values(ctx.mart("kpi_summary"))


@register("mart_sales_daily_by_state",
          """SELECT customer_state, order_purchase_date AS ds, sum(item_gmv) AS y,
                    count(DISTINCT order_id) AS orders, count(*) AS items
             FROM mart_order_items
             WHERE order_status = 'delivered' AND order_purchase_date IS NOT NULL
             GROUP BY 1, 2""",
          rounding={"y": MONEY})
def mart_sales_daily_by_state(ctx: Context):
    """Daily mart as a panel: one series per customer state."""
    return mart_sales_daily(_state_facts(ctx), ["customer_state"])


# ------------------------------------------------------------ features


@register("time_features", f"SELECT ds, y, orders, items, {_CAL} FROM mart_sales_daily",
          rounding={"y": MONEY})
def time_features(ctx: Context):
    """Six calendar features of the daily series."""
    return features.time_features(ctx.mart("mart_sales_daily"))


@register("lag_features", f"SELECT ds, y, orders, items, {_lags_sql()} FROM mart_sales_daily",
          rounding=_LAG_ROUND)
def lag_features(ctx: Context):
    """Row-based lags 1/7/14/28 and full-window history means (no NULL drop)."""
    return features.lag_features(ctx.mart("mart_sales_daily"))


@register("rolling_mean_history",
          f"SELECT ds, roll_7, roll_14 FROM (SELECT ds, {_lags_sql()} FROM mart_sales_daily) r",
          rounding={"roll_7": MEAN, "roll_14": MEAN})
def rolling_mean_history(ctx: Context):
    """Full-window means of the previous 7 / 14 rows."""
    return features.lag_features(ctx.mart("mart_sales_daily")).select("ds", "roll_7", "roll_14")


@register("lag_features_complete", _MODEL_FRAME_SQL, rounding=_LAG_ROUND)
def lag_features_complete(ctx: Context):
    """Calendar + lag features, rows with any NULL dropped (first 28 rows go)."""
    return features.model_frame(ctx.mart("mart_sales_daily"))


@register("lag_features_by_state",
          f"""SELECT customer_state, ds, y, orders, items, {_lags_sql('customer_state')}
              FROM (SELECT customer_state, order_purchase_date AS ds, sum(item_gmv) AS y,
                           count(DISTINCT order_id) AS orders, count(*) AS items
                    FROM mart_order_items
                    WHERE order_status = 'delivered' AND order_purchase_date IS NOT NULL
                    GROUP BY 1, 2) d""",
          rounding=_LAG_ROUND)
def lag_features_by_state(ctx: Context):
    """Lags per series (windows partitioned by state: parallel over series)."""
    daily = mart_sales_daily(_state_facts(ctx), ["customer_state"])
    return features.lag_features(daily, series_keys=["customer_state"])


@register("drop_null_rows",
          """SELECT * FROM mart_orders
             WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
               AND customer_unique_id IS NOT NULL AND customer_city IS NOT NULL
               AND customer_state IS NOT NULL AND order_status IS NOT NULL
               AND order_purchase_ts IS NOT NULL AND order_delivered_customer_ts IS NOT NULL
               AND order_estimated_delivery_ts IS NOT NULL AND order_purchase_date IS NOT NULL
               AND delivery_days IS NOT NULL AND delay_days IS NOT NULL AND is_late IS NOT NULL
               AND payment_value_total IS NOT NULL AND payment_installments_max IS NOT NULL
               AND payment_types IS NOT NULL AND review_score_avg IS NOT NULL""",
          rounding={"payment_value_total": MONEY})
def drop_null_rows(ctx: Context):
    """Any-NULL row drop over the order mart."""
    return features.drop_null_rows(ctx.mart("mart_orders"))


@register("time_split",
          f"""SELECT *, CASE WHEN count(*) OVER () > 60
                              AND row_number() OVER (ORDER BY ds DESC) <= 60
                             THEN 'test' ELSE 'train' END AS split
              FROM ({_MODEL_FRAME_SQL}) m""",
          rounding=_LAG_ROUND)
def time_split(ctx: Context):
    """Last 60 rows of the model frame are the holdout (split after the NULL drop)."""
    return features.time_split(features.model_frame(ctx.mart("mart_sales_daily")), 60)


@register("tail_n_rows", f"SELECT ds, y, orders, items FROM ({_POS_SQL}) p WHERE pos_end <= 30",
          rounding={"y": MONEY})
def tail_n_rows(ctx: Context):
    """Last 30 rows of the daily series."""
    return features.tail_rows(ctx.mart("mart_sales_daily"), 30)


@register("tail7_mean", f"SELECT avg(y) AS tail_mean FROM ({_POS_SQL}) p WHERE pos_end <= 7",
          rounding={"tail_mean": MEAN})
def tail7_mean(ctx: Context):
    """Mean y of the last 7 rows."""
    return features.tail_mean(ctx.mart("mart_sales_daily"), 7)


_FUTURE_SQL = """SELECT CAST(m + to_days(CAST(i AS INTEGER)) AS DATE) AS ds
                 FROM (SELECT max(ds) AS m FROM mart_sales_daily) s, range(1, 61) r(i)"""


@register("future_calendar", _FUTURE_SQL)
def future_calendar(ctx: Context):
    """The 60 days after the last sales day."""
    return features.future_calendar(ctx.mart("mart_sales_daily"), 60)


@register("forecast_flat7",
          f"""SELECT f.ds, t.tail_mean AS yhat FROM ({_FUTURE_SQL}) f,
                     (SELECT avg(y) AS tail_mean FROM ({_POS_SQL}) p WHERE pos_end <= 7) t""",
          rounding={"yhat": MEAN})
def forecast_flat7(ctx: Context):
    """What the dashboard emits: mean of the last 7 days for each of the next 60 days."""
    return features.forecast_flat(ctx.mart("mart_sales_daily"), 60, 7)


@register("forecast_flat7_by_state",
          """WITH d AS (SELECT customer_state, order_purchase_date AS ds, sum(item_gmv) AS y
                        FROM mart_order_items
                        WHERE order_status = 'delivered' AND order_purchase_date IS NOT NULL
                        GROUP BY 1, 2),
                  p AS (SELECT *, row_number() OVER (PARTITION BY customer_state ORDER BY ds DESC)
                                  AS pos_end FROM d),
                  s AS (SELECT customer_state, max(ds) AS m, avg(y) FILTER (WHERE pos_end <= 7)
                                  AS yhat FROM p GROUP BY 1)
             SELECT customer_state, CAST(m + to_days(CAST(i AS INTEGER)) AS DATE) AS ds, yhat
             FROM s, range(1, 61) r(i)""",
          rounding={"yhat": MEAN})
def forecast_flat7_by_state(ctx: Context):
    """Flat 7-row-mean forecast for every state series."""
    daily = mart_sales_daily(_state_facts(ctx), ["customer_state"])
    return features.forecast_flat(daily, 60, 7, series_keys=["customer_state"])


@register("append_future_rows",
          f"""SELECT ds, y FROM mart_sales_daily
              UNION ALL SELECT ds, CAST(NULL AS DOUBLE) AS y FROM ({_FUTURE_SQL}) f""",
          rounding={"y": MONEY})
def append_future_rows(ctx: Context):
    """History plus 60 future days with NULL y."""
    return features.append_future_rows(ctx.mart("mart_sales_daily"), 60)


@register("future_row_select",
          f"""SELECT * FROM ({_MODEL_FRAME_SQL}) m
              WHERE ds = (SELECT max(ds) FROM mart_sales_daily)""",
          rounding=_LAG_ROUND)
def future_row_select(ctx: Context):
    """Feature row for one target date (the last sales day)."""
    daily = ctx.mart("mart_sales_daily")
    frame = features.model_frame(daily)
    return frame.where(F.col("ds") == daily.select(F.max("ds")).scalar())


@register("forecast_metrics",
          f"""WITH p AS ({_POS_SQL}),
                  base AS (SELECT avg(y) AS yhat FROM p WHERE pos_end > 60 AND pos_end <= 67)
             SELECT avg(abs(y - yhat)) AS mae, sqrt(avg(pow(y - yhat, 2))) AS rmse,
                    avg(abs((y - yhat) / greatest(1e-9, y))) * 100.0 AS mape
             FROM p, base WHERE pos_end <= 60""",
          rounding={"mae": MEAN, "rmse": MEAN, "mape": MEAN})
def forecast_metrics_q(ctx: Context):
    """MAE/RMSE/MAPE of the flat baseline (mean of the last 7 training rows) on the 60-row holdout."""
    daily = ctx.mart("mart_sales_daily")
    split = features.time_split(daily, 60)
    train = split.where(F.col("split") == "train")
    base = features.tail_mean(train, 7, alias="yhat").select("yhat").scalar()
    test = split.where(F.col("split") == "test").select("y", base.alias("yhat"))
    return forecast_metrics(test)


# ------------------------------------------------------------ insights


@register("weekday_mean", "SELECT dayname(ds) AS weekday, avg(y) AS mean_y FROM mart_sales_daily GROUP BY 1",
          rounding={"mean_y": MEAN})
def weekday_mean(ctx: Context):
    """Mean y per English weekday name."""
    return insights.weekday_mean(ctx.mart("mart_sales_daily"))


@register("best_weekday",
          """SELECT dayname(ds) AS weekday, avg(y) AS mean_y FROM mart_sales_daily GROUP BY 1, isodow(ds)
             ORDER BY mean_y DESC, isodow(ds) LIMIT 1""",
          rounding={"mean_y": MEAN})
def best_weekday(ctx: Context):
    """Weekday with the highest mean y."""
    return insights.best_weekday(ctx.mart("mart_sales_daily"))


_TOTAL_SQL = """SELECT 1 AS rule,
                       printf('Total GMV is %.2f (BRL) across the dataset period.', total_gmv) AS insight
                FROM kpi_summary WHERE total_gmv > 0"""
_TREND_SQL = f"""SELECT 2 AS rule,
                        printf('GMV is %s %.1f%% in the last 30 days vs the previous 30 days.',
                               CASE WHEN (last30 - prev30) / prev30 * 100.0 >= 0 THEN 'up'
                                    ELSE 'down' END,
                               abs((last30 - prev30) / prev30 * 100.0)) AS insight
                 FROM (SELECT count(*) AS n, sum(CASE WHEN pos_end <= 30 THEN y END) AS last30,
                              sum(CASE WHEN pos_end > 30 AND pos_end <= 60 THEN y END) AS prev30
                       FROM ({_POS_SQL}) p) s
                 WHERE n >= 60 AND prev30 > 0"""
_BEST_SQL = """SELECT 3 AS rule, printf('Highest average GMV day is %s.', weekday) AS insight
               FROM (SELECT dayname(ds) AS weekday, avg(y) AS mean_y FROM mart_sales_daily
                     GROUP BY 1 ORDER BY mean_y DESC, weekday ASC LIMIT 1) b
               WHERE (SELECT count(*) FROM mart_sales_daily) >= 7"""


@register("insight_total_gmv", _TOTAL_SQL)
def insight_total_gmv(ctx: Context):
    """Total GMV text rule."""
    return insights.insight_total_gmv(ctx.mart("kpi_summary"))


@register("insight_gmv_trend", _TREND_SQL)
def insight_gmv_trend(ctx: Context):
    """Last-30 vs previous-30 rows trend text rule."""
    return insights.insight_gmv_trend(ctx.mart("mart_sales_daily"))


@register("insight_best_weekday", _BEST_SQL)
def insight_best_weekday(ctx: Context):
    """Best weekday text rule."""
    return insights.insight_best_weekday(ctx.mart("mart_sales_daily"))


@register("insights_all",
          f"""SELECT CAST(row_number() OVER (ORDER BY rule) AS INTEGER) AS rank, insight
              FROM ({_TOTAL_SQL} UNION ALL {_TREND_SQL} UNION ALL {_BEST_SQL}) u""")
def insights_all(ctx: Context):
    """Ordered, numbered union of the three insight rules."""
    daily = checkpoint(ctx.mart("mart_sales_daily"))  # read by all three rules
    return insights.insights_all(kpi_summary(daily), daily)


@register("sort_daily", "SELECT ds, y, orders, items FROM mart_sales_daily", rounding={"y": MONEY})
def sort_daily(ctx: Context):
    """Daily mart ordered by day ascending."""
    return ctx.mart("mart_sales_daily").orderBy("ds")


def _loaders(ctx: Context):
    """Loaders over marts stored for this query: the daily mart, and the item columns that pages read."""
    from martwright.plans.app import MemoisedReads
    from martwright.sinks.tables import write_table
    root = scratch_path(ctx.spark, "pages")
    items = ctx.items("customer_state", "product_category_en", "item_gmv", "order_id", "order_status",
                      "order_purchase_date")
    paths = {name: f"{root}/mart/{name}" for name in ("mart_order_items", "mart_sales_daily")}
    stored = write_table(ctx.spark, items, paths["mart_order_items"])
    daily = write_table(ctx.spark, mart_sales_daily(stored), paths["mart_sales_daily"])
    marts = {"mart_order_items": stored, "mart_sales_daily": daily, "kpi_summary": kpi_summary(daily)}
    return MemoisedReads(ctx.spark, marts, paths, f"{root}/_memo")


@register("memoised_reads",
          """SELECT n_name AS customer_state, sum(l_extendedprice + l_quantity) AS gmv,
                    count(DISTINCT l_orderkey) AS orders
             FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
                  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
             GROUP BY 1""",
          rounding={"gmv": MONEY})
def memoised_reads(ctx: Context):
    """Dashboard loader served from its stored result (state sales page): stored, then read again."""
    loaders = _loaders(ctx)
    loaders.read("state_sales")
    return loaders.read("state_sales")


@register("memoised_kpis", "SELECT * FROM kpi_summary", rounding={"total_gmv": MONEY, "avg_daily_gmv": MEAN})
def memoised_kpis(ctx: Context):
    """Dashboard loader of the KPI row."""
    return _loaders(ctx).read("kpis")


@register("memoised_daily", "SELECT ds, y, orders, items FROM mart_sales_daily", rounding={"y": MONEY})
def memoised_daily(ctx: Context):
    """Dashboard loader of the daily series."""
    return _loaders(ctx).read("daily")


@register("memoised_top_categories",
          """SELECT lower(p_type) || '_en' AS product_category_en, sum(gmv) AS gmv
             FROM (SELECT CASE WHEN l_partkey % 61 <> 0 THEN p_type END AS p_type, l_extendedprice + l_quantity AS gmv
                   FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
                   WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) sold
             GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
          rounding={"gmv": MONEY})
def memoised_top_categories(ctx: Context):
    """Dashboard loader of the 15 largest categories."""
    return _loaders(ctx).read("top_categories")


@register("forecast_metrics_by_state",
          """WITH d AS (SELECT customer_state, order_purchase_date AS ds, sum(item_gmv) AS y
                        FROM mart_order_items
                        WHERE order_status = 'delivered' AND order_purchase_date IS NOT NULL
                        GROUP BY 1, 2),
                  p AS (SELECT *, row_number() OVER (PARTITION BY customer_state ORDER BY ds DESC)
                                  AS pos_end,
                               count(*) OVER (PARTITION BY customer_state) AS n FROM d),
                  s AS (SELECT *, CASE WHEN n > 60 AND pos_end <= 60 THEN 'test' ELSE 'train' END
                                  AS split FROM p),
                  tr AS (SELECT *, row_number() OVER (PARTITION BY customer_state ORDER BY ds DESC)
                                   AS tpos FROM s WHERE split = 'train'),
                  base AS (SELECT customer_state, avg(y) AS yhat FROM tr WHERE tpos <= 7 GROUP BY 1)
             SELECT s.customer_state, avg(abs(y - yhat)) AS mae,
                    sqrt(avg(pow(y - yhat, 2))) AS rmse,
                    avg(abs((y - yhat) / greatest(1e-9, y))) * 100.0 AS mape
             FROM s JOIN base ON s.customer_state IS NOT DISTINCT FROM base.customer_state
             WHERE s.split = 'test' GROUP BY 1""",
          rounding={"mae": MEAN, "rmse": MEAN, "mape": MEAN})
def forecast_metrics_by_state(ctx: Context):
    """Per-state holdout metrics of the flat baseline (mean of each series' last 7 train rows)."""
    keys = ["customer_state"]
    daily = mart_sales_daily(_state_facts(ctx), keys)
    split = features.time_split(daily, 60, keys)
    base = features.tail_mean(split.where(F.col("split") == "train"), 7, keys, alias="yhat")
    base = base.withColumnRenamed("customer_state", "_state")
    test = split.where(F.col("split") == "test").join(base, F.col("customer_state").eqNullSafe(F.col("_state")))
    return forecast_metrics(test, series_keys=keys)
