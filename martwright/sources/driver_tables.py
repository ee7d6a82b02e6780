"""Adapter: the TPC-H-style test tables → the nine raw marketplace inputs.

Every mapping is a per-row projection (map-only, no shuffle) except the
nation / region look-ups, which are broadcast: those tables have one row
per nation / region, a size fixed by the key domain, not by the data.
The same mapping is written in DuckDB SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _i(c) -> F.Column:
    return c.cast("int")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    purchase = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), _i(k % 1440))
    delivered = F.when(
        (F.col("o_orderstatus") == "F") & (k % 50 != 0),
        purchase + F.make_dt_interval(_i(1 + k % 40), _i(k % 23)))
    estimate = F.when(k % 97 != 0, F.col("o_orderdate") + F.make_dt_interval(F.lit(24)))
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped")
              .when(F.col("o_orderstatus") == "P", "canceled"))
    return o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        (purchase + F.make_dt_interval(F.lit(0), F.lit(1))).alias("order_approved_at"),
        (purchase + F.make_dt_interval(F.lit(2))).alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        estimate.alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ptype = (F.when(F.col("l_returnflag") == "A", "boleto")
             .when(F.col("l_returnflag") == "N", "credit_card")
             .otherwise("voucher"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    e = F.col("event_id")
    return ev.select(
        e.cast("string").alias("review_id"),
        F.expr("event_id div 2").cast("string").alias("order_id"),
        _i(1 + e % 5).alias("review_score"),
        F.col("ts").alias("review_creation_date"),
        (F.col("ts") + F.make_dt_interval(F.lit(1))).alias("review_answer_timestamp"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.expr("c_custkey div 2").cast("string").alias("customer_unique_id"),
                F.col("c_nationkey").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state")))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 61 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        size.cast("double").alias("product_weight_g"),
        (size + 1).cast("double").alias("product_length_cm"),
        (size + 2).cast("double").alias("product_height_cm"),
        (size + 3).cast("double").alias("product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left")
            .select(
                F.col("s_suppkey").cast("string").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.col("n_name").alias("seller_state")))


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    return (c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey, "left")
            .select(
                F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                F.col("n_name").alias("geolocation_city"),
                F.col("r_name").alias("geolocation_state"),
                (F.col("c_acctbal") / 100).alias("geolocation_lat"),
                (-F.col("c_acctbal") / 200).alias("geolocation_lng")))


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English names derived from the categories present in ``part``.

    One row per distinct category (a key domain, not a data volume).
    """
    p = read_table(spark, sf_dir, "part")
    cats = p.select(F.col("p_type").alias("product_category_name")).distinct()
    return (cats.where(F.col("product_category_name").isNotNull())
            .select("product_category_name",
                    F.concat(F.lower("product_category_name"), F.lit("_en"))
                    .alias("product_category_name_english")))


RAW_BUILDERS = {
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
    "customers": raw_customers,
    "products": raw_products,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "category_translation": raw_category_translation,
}


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine raw inputs as lazy DataFrames."""
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}

