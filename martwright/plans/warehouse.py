"""Warehouse build: raw → stg → mart.

``build_layers`` wires the whole star schema as lazy DataFrames (one
Catalyst plan per table). ``run_pipeline`` materialises the layers as Parquet
in a new version under a warehouse root, full refresh, and reads each written table back for
the layers above it: the write is the lineage cut (an executor lost later
re-reads Parquet instead of recomputing the raw joins), and downstream
scans get column pruning and predicate pushdown on the stored files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martwright.operators import dimensions, marts, order_aggregates, staging

STG_TABLES = ("orders", "order_items", "payments", "reviews", "customers", "products",
              "sellers", "geolocation", "category_translation")
MART_TABLES = ("dim_customers", "dim_sellers", "dim_products", "order_payments",
               "order_reviews", "mart_orders", "mart_order_items", "mart_sales_daily")


# The current version, and the one before it for readers that have opened it.
KEEP_VERSIONS = 2


@dataclass
class Layers:
    stg: dict[str, DataFrame] = field(default_factory=dict)
    mart: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, qualified: str) -> DataFrame:
        layer, name = qualified.split(".", 1)
        return getattr(self, layer)[name]


def build_stg(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return staging.stage_all(raw)


def build_marts(stg: dict[str, DataFrame], materialise=None,
                one_shuffle: bool = False, all_stored: bool = False) -> dict[str, DataFrame]:
    """Star schema from staged tables. ``materialise(name, df) -> df`` may persist each table; it
    stores the dimensions, if given. ``one_shuffle``: payments are aggregated in one shuffle, by bits of
    their types, which are read first (too many types: see ``order_aggregates.order_payments``).
    ``all_stored``: the same, and ``materialise`` stores every table, so the items join the stored order mart."""
    keep = materialise or (lambda _name, df: df)
    m: dict[str, DataFrame] = {}
    m["dim_customers"] = keep("dim_customers",
                              dimensions.dim_customers(stg["customers"], stg["geolocation"]))
    m["dim_sellers"] = keep("dim_sellers",
                            dimensions.dim_sellers(stg["sellers"], stg["geolocation"]))
    m["dim_products"] = keep("dim_products",
                             dimensions.dim_products(stg["products"], stg["category_translation"]))
    types = order_aggregates.payment_types(stg["payments"]) if one_shuffle or all_stored else None
    m["order_payments"] = keep("order_payments",
                               order_aggregates.order_payments(stg["payments"], one_shuffle, types))
    m["order_reviews"] = keep("order_reviews", order_aggregates.order_reviews(stg["reviews"]))
    m["mart_orders"] = keep("mart_orders", marts.mart_orders(
        stg["orders"], m["dim_customers"], m["order_payments"], m["order_reviews"]))
    m["mart_order_items"] = keep("mart_order_items", marts.mart_order_items(
        stg["order_items"], stg["orders"], m["dim_customers"], m["order_payments"],
        m["order_reviews"], m["dim_products"], m["dim_sellers"], materialise is not None,
        m["mart_orders"] if all_stored else None))
    m["mart_sales_daily"] = keep("mart_sales_daily", marts.mart_sales_daily(m["mart_order_items"]))
    m["kpi_summary"] = marts.kpi_summary(m["mart_sales_daily"])
    return m


def build_layers(raw: dict[str, DataFrame]) -> Layers:
    stg = build_stg(raw)
    return Layers(stg=stg, mart=build_marts(stg))


# Staging tables that are real work (an aggregation), stored even when the
# plain cast/rename projections are not.
AGGREGATED_STG = ("geolocation",)


# Order- and item-grain marts that can be stored partitioned by purchase month.
MONTH_PARTITIONED = ("mart_orders", "mart_order_items")


# Columns of the marts stored without a dictionary: ids and amounts of single orders and items.
PLAIN_COLUMNS = ("order_id", "customer_id", "customer_unique_id", "product_id", "price", "item_gmv",
                 "payment_value_total")


def month_partitioned(df: DataFrame, buckets: int) -> DataFrame:
    """Add ``order_purchase_month`` and spread rows by (month, hash of order id).

    Each writer task then holds few (month, bucket) groups, so the file count
    stays near months × buckets instead of tasks × months, and a month holding
    a third of all rows is written by ``buckets`` tasks, not one.
    """
    from pyspark.sql import functions as F
    month = F.trunc("order_purchase_date", "month")
    salt = F.pmod(F.xxhash64("order_id"), F.lit(buckets))
    return df.withColumn("order_purchase_month", month).repartition("order_purchase_month", salt)


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], root: str,
                 persist_stg: bool = False, persist_raw: bool = False,
                 month_buckets: int | None = None) -> Layers:
    """Full refresh of the warehouse as Parquet under ``root``.

    Marts (and the aggregated staging table) are always stored. The other
    staging tables are cast/rename projections; by default they stay views
    fused into the mart builds, so each raw input is scanned once (of the payments, the types' column
    twice).
    ``persist_stg=True`` stores them too (a second full write and read of
    every raw table). ``month_buckets=N`` stores the order and item marts
    partitioned by ``order_purchase_month`` (an extra column; month filters
    then prune directories), written by N tasks per month. ``persist_raw=True`` first stores the raw
    inputs as Parquet in the version's ``raw`` (a one-time CSV → columnar conversion, as the
    source system copies its CSVs into a raw schema) and builds from that copy.
    ``kpi_summary`` stays a view over the stored daily mart.

    All tables go to a new version's folder, which is published, by one small file, after the last
    of them is written: until then, and if the job dies, readers get the version before. The last
    ``KEEP_VERSIONS`` published versions stay, older ones are deleted.
    """
    from martwright.sinks.tables import new_version, publish, release_versions, write_table

    version = new_version(root)
    if persist_raw:
        raw = {name: write_table(spark, df, f"{version}/raw/{name}") for name, df in raw.items()}

    def stg_keep(name: str, df: DataFrame) -> DataFrame:
        if persist_stg or name in AGGREGATED_STG:
            return write_table(spark, df, f"{version}/stg/{name}")
        df.createOrReplaceTempView(f"stg_{name}")
        return df

    def mart_keep(name: str, df: DataFrame) -> DataFrame:
        if month_buckets and name in MONTH_PARTITIONED:
            return write_table(spark, month_partitioned(df, month_buckets),
                               f"{version}/mart/{name}", partition_by=["order_purchase_month"],
                               plain=PLAIN_COLUMNS)
        return write_table(spark, df, f"{version}/mart/{name}", plain=PLAIN_COLUMNS)

    stg = {name: stg_keep(name, df) for name, df in build_stg(raw).items()}
    mart = build_marts(stg, materialise=mart_keep, all_stored=True)
    publish(spark, root, version, {"marts": list(MART_TABLES)})
    release_versions(spark, root, KEEP_VERSIONS)
    mart["kpi_summary"].createOrReplaceTempView("kpi_summary")
    for name in MART_TABLES:
        mart[name].createOrReplaceTempView(name)
    return Layers(stg=stg, mart=mart)
