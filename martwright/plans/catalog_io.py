"""Sampling, source/sink round trips and composed pipeline jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.operators import segmentation
from martwright.operators.sampling import sample_by_keys, sample_children, sample_exact_n
from martwright.plans.catalog_models import RFM_SQL, trained
from martwright.plans.catalog_serving import _BEST_SQL, _TOTAL_SQL, _TREND_SQL
from martwright.plans.context import Context
from martwright.plans.registry import register
from martwright.schemas import DAILY
from martwright.session import scratch_path
from martwright.sinks.exports import (EXPORT_TABLES, export_marts, read_csv_typed, write_csv,
                                      write_csv_file, write_metrics_json, write_parquet)
from martwright.sinks.tables import read_versioned, remove, write_table, write_versioned

MONEY = 2
N_SAMPLE = 2000  # orders sampled by the sampling checks (the job default is 15,000)

_SAMPLE_SQL = f"SELECT * FROM stg_orders ORDER BY md5('42:' || order_id) LIMIT {N_SAMPLE}"
_SAMPLE_ITEMS_SQL = f"""SELECT * FROM stg_order_items
                        WHERE order_id IN (SELECT order_id FROM ({_SAMPLE_SQL}) s)"""


def _sampled_orders(ctx: Context):
    return sample_exact_n(ctx.stg("orders"), N_SAMPLE, ["order_id"], seed=42)


# ------------------------------------------------------------- sampling


@register("sample_exact_n", _SAMPLE_SQL)
def sample_orders(ctx: Context):
    """Exact-size sample: the orders with the smallest md5('42:' || order_id)."""
    return _sampled_orders(ctx)


@register("sample_semi_orders", _SAMPLE_ITEMS_SQL)
def sample_semi_orders(ctx: Context):
    """Items of the sampled orders (left semi join)."""
    return sample_children({"items": ctx.stg("order_items")}, _sampled_orders(ctx),
                           "order_id")["items"]


@register("sample_semi_payments",
          f"""SELECT * FROM stg_payments
              WHERE order_id IN (SELECT order_id FROM ({_SAMPLE_SQL}) s)""")
def sample_semi_payments(ctx: Context):
    """Payments of the sampled orders (left semi join)."""
    return sample_children({"p": ctx.stg("payments")}, _sampled_orders(ctx), "order_id")["p"]


@register("sample_semi_reviews",
          f"""SELECT * FROM stg_reviews
              WHERE order_id IN (SELECT order_id FROM ({_SAMPLE_SQL}) s)""")
def sample_semi_reviews(ctx: Context):
    """Reviews of the sampled orders (left semi join)."""
    return sample_children({"r": ctx.stg("reviews")}, _sampled_orders(ctx), "order_id")["r"]


@register("sample_semi_customers",
          f"""SELECT * FROM stg_customers
              WHERE customer_id IN (SELECT customer_id FROM ({_SAMPLE_SQL}) s)""")
def sample_semi_customers(ctx: Context):
    """Customers of the sampled orders (left semi join)."""
    return sample_by_keys(ctx.stg("customers"), _sampled_orders(ctx), "customer_id",
                          "customer_id")


def _sampled_items(ctx: Context):
    return sample_children({"i": ctx.stg("order_items")}, _sampled_orders(ctx), "order_id")["i"]


@register("sample_semi_products",
          f"""SELECT * FROM stg_products
              WHERE product_id IN (SELECT product_id FROM ({_SAMPLE_ITEMS_SQL}) i)""")
def sample_semi_products(ctx: Context):
    """Products of the sampled *items* (not of all items)."""
    return sample_by_keys(ctx.stg("products"), _sampled_items(ctx), "product_id", "product_id")


@register("sample_semi_sellers",
          f"""SELECT * FROM stg_sellers
              WHERE seller_id IN (SELECT seller_id FROM ({_SAMPLE_ITEMS_SQL}) i)""")
def sample_semi_sellers(ctx: Context):
    """Sellers of the sampled items (left semi join)."""
    return sample_by_keys(ctx.stg("sellers"), _sampled_items(ctx), "seller_id", "seller_id")


N_POINTS = 50_000  # points to sample: as many as the job takes
_POINT = "geolocation_zip_code_prefix, geolocation_city, geolocation_state, geolocation_lat, geolocation_lng"


@register("sample_geolocation", f"""
    SELECT {_POINT} FROM (
      SELECT *, row_number() OVER (ORDER BY h) AS nth FROM (
        SELECT *, md5('42:' || array_to_string(list_transform(k, lambda x: length(x) || '|' || x), '|')) AS h FROM (
          SELECT {_POINT}, [coalesce(CAST(geolocation_zip_code_prefix AS VARCHAR), ''), coalesce(geolocation_city, ''),
                            coalesce(geolocation_state, ''), coalesce(CAST(CAST(round(geolocation_lat * 100000) AS BIGINT) AS VARCHAR), ''),
                            coalesce(CAST(CAST(round(geolocation_lng * 100000) AS BIGINT) AS VARCHAR), '')] AS k
          FROM raw_geolocation) p) p) p
    WHERE nth <= {N_POINTS}""", rounding={"geolocation_lat": 5, "geolocation_lng": 5})
def sample_geolocation(ctx: Context):
    """Raw geolocation points (no key), exact-n sample by the hash of whole rows."""
    points = ctx.raw("geolocation")
    place = [F.round(F.col(c).cast("double") * 100000).cast("bigint").alias(f"_{c[-3:]}")
             for c in ("geolocation_lat", "geolocation_lng")]
    key = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state", "_lat", "_lng"]
    return sample_exact_n(points.select("*", *place), N_POINTS, key, seed=42).drop("_lat", "_lng")


# ------------------------------------------------------ sources / sinks


@register("scan_csv", "SELECT * FROM stg_orders")
def scan_csv(ctx: Context):
    """Raw orders written as CSV text, scanned back by header (all text), then staged."""
    from martwright.operators.staging import stage_orders
    from martwright.sources.csv_files import scan_csv as scan
    path = scratch_path(ctx.spark, "raw-orders-csv")
    write_csv(ctx.raw("orders"), path)
    return stage_orders(scan(ctx.spark, path, "orders"))


@register("sink_csv_export", "SELECT * FROM mart_sales_daily", rounding={"y": MONEY})
def sink_csv_export(ctx: Context):
    """Daily mart exported as one CSV file and read back with its schema."""
    path = scratch_path(ctx.spark, "daily-csv")
    return read_csv_typed(ctx.spark, write_csv_file(ctx.mart("mart_sales_daily"), f"{path}/mart_sales_daily.csv"), DAILY)


@register("sink_layer_table", "SELECT * FROM dim_products")
def sink_layer_table(ctx: Context):
    """Layer table refreshed twice as versions, the current one read back through its pointer."""
    root = scratch_path(ctx.spark, "dim")
    write_versioned(ctx.spark, ctx.mart("dim_products").where("product_id IS NULL"), root)
    write_versioned(ctx.spark, ctx.mart("dim_products"), root)
    return read_versioned(ctx.spark, root)


@register("sink_parquet_rfm", f"SELECT * FROM ({RFM_SQL}) r", rounding={"monetary": MONEY})
def sink_parquet_rfm(ctx: Context):
    """RFM table persisted as Parquet and read back."""
    path = scratch_path(ctx.spark, "rfm")
    write_parquet(segmentation.rfm(ctx.delivered_items()), path)
    return ctx.spark.read.parquet(path)


@register("sink_kpi_view", "SELECT * FROM kpi_summary",
          rounding={"total_gmv": MONEY, "avg_daily_gmv": 6})
def sink_kpi_view(ctx: Context):
    """KPI registered as a (lazy) view over the daily mart and read through the catalog."""
    name = "kpi_summary_view"
    ctx.mart("kpi_summary").createOrReplaceTempView(name)
    return ctx.spark.table(name)


@register("sink_metrics_json")
def sink_metrics_json(ctx: Context):
    """Training metrics persisted as JSON and read back (one row)."""
    _, entry = trained(ctx)
    return write_metrics_json(entry.tables["metrics"], scratch_path(ctx.spark, "metrics-json"))


# -------------------------------------------------------------- pipelines

# A text of each row's values, in words that Spark and DuckDB share; money in whole cents.
_ROW_TEXT = {
    "stg_orders": "concat_ws('|', order_id, customer_id, order_status, CAST(CAST(order_purchase_ts AS DATE) AS VARCHAR(10)))",
    "stg_order_items": "concat_ws('|', order_id, order_item_id, product_id, seller_id, CAST(round(price * 100) AS BIGINT))",
    "stg_payments": "concat_ws('|', order_id, payment_sequential, payment_type, CAST(round(payment_value * 100) AS BIGINT))",
    "stg_reviews": "concat_ws('|', review_id, order_id, review_score)",
    "stg_customers": "concat_ws('|', customer_id, customer_unique_id, customer_zip_prefix, customer_city, customer_state)",
    "stg_products": "concat_ws('|', product_id, product_category_name, product_name_length, product_photos_qty)",
    "stg_sellers": "concat_ws('|', seller_id, seller_zip_prefix, seller_city, seller_state)",
    "stg_geolocation": "concat_ws('|', zip_prefix, city, state, CAST(round(lat * 1000) AS BIGINT))",
    "stg_category_translation": "concat_ws('|', product_category_name, product_category_name_english)",
    "dim_customers": "concat_ws('|', customer_id, customer_state, CAST(round(customer_lat * 1000) AS BIGINT))",
    "dim_sellers": "concat_ws('|', seller_id, seller_state, CAST(round(seller_lat * 1000) AS BIGINT))",
    "dim_products": "concat_ws('|', product_id, product_category_en)",
    "order_payments": "concat_ws('|', order_id, payment_installments_max, payment_types, CAST(round(payment_value_total * 100) AS BIGINT))",
    "order_reviews": "concat_ws('|', order_id, CAST(round(review_score_avg * 1000) AS BIGINT))",
    "mart_orders": "concat_ws('|', order_id, customer_state, order_status, delivery_days, delay_days, is_late, CAST(round(payment_value_total * 100) AS BIGINT))",
    "mart_order_items": "concat_ws('|', order_id, order_item_id, customer_state, product_category_en, seller_state, CAST(round(item_gmv * 100) AS BIGINT), CAST(round(payment_value_total * 100) AS BIGINT))",
    "mart_sales_daily": "concat_ws('|', CAST(ds AS VARCHAR(10)), orders, items, CAST(round(y * 100) AS BIGINT))",
}


def _digest_sql(name: str, source: str, text: str) -> str:
    """Rows, and the sum of the first 28 bits of their texts' md5."""
    return (f"SELECT '{name}' AS t, count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr(md5({text}), 1, 7) "
            f"AS BIGINT)), 0) AS BIGINT) AS digest FROM {source}")


def _digests(tables: dict, texts: dict | None = None):
    texts = texts or _ROW_TEXT
    out = None
    for name, df in tables.items():
        bits = F.conv(F.substring(F.md5(F.expr(texts[name])), 1, 7), 16, 10).cast("bigint")
        one = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).alias("digest"))
        one = one.select(F.lit(name).alias("t"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


@register("run_pipeline", " UNION ALL ".join(_digest_sql(t, t, x) for t, x in _ROW_TEXT.items()))
def run_pipeline_q(ctx: Context):
    """Full raw → stg → mart refresh to Parquet; rows and digest of every stored table."""
    from martwright.plans.warehouse import run_pipeline
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(ctx.spark, "warehouse")
    layers = run_pipeline(ctx.spark, raw_inputs(ctx.spark, ctx.sf_dir), root)
    tables = {f"stg_{k}": v for k, v in layers.stg.items()}
    tables.update({k: v for k, v in layers.mart.items() if k != "kpi_summary"})
    return _digests(tables)


@register("scan_csv_all", " UNION ALL ".join(
    _digest_sql(t, t, x) for t, x in _ROW_TEXT.items() if t.startswith("stg_")))
def scan_csv_all(ctx: Context):
    """All nine raw inputs written as CSV files, read back after the manifest check, and staged."""
    from martwright.operators.staging import stage_all
    from martwright.schemas import REQUIRED_FILES
    from martwright.sources.csv_files import read_raw_dir
    from martwright.sources.driver_tables import raw_inputs
    out = scratch_path(ctx.spark, "raw-csv-all")
    for name, df in raw_inputs(ctx.spark, ctx.sf_dir).items():
        write_csv_file(df, f"{out}/{REQUIRED_FILES[name]}")
    return _digests({f"stg_{n}": df for n, df in stage_all(read_raw_dir(ctx.spark, out)).items()})


@register("export_all", " UNION ALL ".join(_digest_sql(t, t, _ROW_TEXT[t]) for t in EXPORT_TABLES))
def export_all(ctx: Context):
    """Six marts exported as CSV; rows and digest of each export read back."""
    from martwright.operators.marts import ITEM_DERIVED, item_derived
    from martwright.plans.warehouse import PLAIN_COLUMNS, build_marts, build_stg
    from martwright.session import shuffles_dropped
    from martwright.sources.driver_tables import raw_inputs
    out, held = scratch_path(ctx.spark, "exports"), scratch_path(ctx.spark, "export-marts")

    def keep(name, df):
        if name == "mart_order_items":  # read by its export and the daily mart; on disk beside its export
            return item_derived(write_table(ctx.spark, df.drop(*ITEM_DERIVED), f"{held}/{name}",
                                            plain=PLAIN_COLUMNS, codec="zstd"))
        # a stored dimension has a known size: it is broadcast while it is small, and computed once
        return write_table(ctx.spark, df, f"{held}/{name}") if name.startswith("dim_") else df

    try:
        with shuffles_dropped(ctx.spark):
            marts = build_marts(build_stg(raw_inputs(ctx.spark, ctx.sf_dir)), keep, one_shuffle=True)
            written = export_marts(marts, out)
    finally:
        remove(ctx.spark, held)
    return _digests({name: ctx.spark.read.option("header", True).csv(p).withColumns(
        {c: F.col(c).cast("double") for c in ("item_gmv", "payment_value_total", "customer_lat", "seller_lat", "y")
         if c in marts[name].columns}) for name, p in written.items()})


# The sampling job below the size of its tables (the job's own defaults are 15,000 and 50,000).
N_JOB_ORDERS, N_JOB_POINTS = 1000, 600
_JOB_ORDERS = f"(SELECT * FROM stg_orders ORDER BY md5('42:' || order_id) LIMIT {N_JOB_ORDERS})"
_JOB_ITEMS = f"(SELECT * FROM stg_order_items WHERE order_id IN (SELECT order_id FROM {_JOB_ORDERS} o))"
_JOB_SOURCES = {
    "orders": _JOB_ORDERS,
    "order_items": _JOB_ITEMS,
    "payments": f"(SELECT * FROM stg_payments WHERE order_id IN (SELECT order_id FROM {_JOB_ORDERS} o))",
    "reviews": f"(SELECT * FROM stg_reviews WHERE order_id IN (SELECT order_id FROM {_JOB_ORDERS} o))",
    "customers": f"(SELECT * FROM stg_customers WHERE customer_id IN (SELECT customer_id FROM {_JOB_ORDERS} o))",
    "products": f"(SELECT * FROM stg_products WHERE product_id IN (SELECT product_id FROM {_JOB_ITEMS} i))",
    "sellers": f"(SELECT * FROM stg_sellers WHERE seller_id IN (SELECT seller_id FROM {_JOB_ITEMS} i))",
    "category_translation": "stg_category_translation",
}
_JOB_TEXT = {
    "orders": "concat_ws('|', order_id, customer_id, order_status)",
    "order_items": "concat_ws('|', order_id, order_item_id, product_id, seller_id)",
    "payments": "concat_ws('|', order_id, payment_sequential, payment_type)",
    "reviews": "concat_ws('|', review_id, order_id, review_score)",
    "customers": "concat_ws('|', customer_id, customer_unique_id, customer_city, customer_state)",
    "products": "concat_ws('|', product_id, product_category_name)",
    "sellers": "concat_ws('|', seller_id, seller_city, seller_state)",
    "category_translation": "concat_ws('|', product_category_name, product_category_name_english)",
}


@register("make_sample", " UNION ALL ".join(
    [_digest_sql(t, f"{_JOB_SOURCES[t]} x", x) for t, x in _JOB_TEXT.items()]
    + [f"SELECT 'geolocation' AS t, least(count(*), {N_JOB_POINTS}) AS rows, CAST(0 AS BIGINT) AS digest FROM customer"]))
def make_sample_q(ctx: Context):
    """Sampling job below the tables' sizes: rows and digest of each written CSV (points: rows)."""
    from martwright.plans.sample_job import make_sample
    from martwright.sources.driver_tables import raw_inputs
    out = scratch_path(ctx.spark, "sample")
    written = make_sample(ctx.spark, raw_inputs(ctx.spark, ctx.sf_dir), out, N_JOB_ORDERS, N_JOB_POINTS)
    read = {name: ctx.spark.read.option("header", True).csv(p) for name, p in written.items()}
    points = read.pop("geolocation").agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("digest"))
    return _digests({t: read[t] for t in _JOB_TEXT}, _JOB_TEXT).unionByName(
        points.select(F.lit("geolocation").alias("t"), "rows", "digest"))


@register("ensure_built", f"""SELECT CAST(row_number() OVER (ORDER BY rule) AS INTEGER) AS rank,
                                      insight
                               FROM ({_TOTAL_SQL} UNION ALL {_TREND_SQL} UNION ALL {_BEST_SQL}) u""")
def ensure_built_q(ctx: Context):
    """Build-if-missing (warehouse + best-effort training), then the insight page."""
    from martwright.plans.app import ensure_built, insight_page
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(ctx.spark, "app-warehouse")
    marts = ensure_built(ctx.spark, raw_inputs(ctx.spark, ctx.sf_dir), root,
                         train_dir=f"{root}/artifacts")
    return insight_page(marts)

