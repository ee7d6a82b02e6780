"""Order, item and daily marts plus the KPI summary.

Plan shape (the part that matters at scale):

* Payment and review aggregates are hash-partitioned on ``order_id`` by their
  ``groupBy``; customers join the orders at order grain.
* Items join orders, payments and reviews on ``order_id`` in a left chain: one
  item-grain shuffle besides the product / seller dimension joins, which are
  broadcast when their size is checked small and otherwise left to AQE (which
  also splits a hot product or seller key). NULL order ids match nothing.
* The daily mart aggregates ``(ds, order_id)`` map-side first (Spark's plan
  for an exact ``count(DISTINCT)``), so a day holding a third of all sales
  still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import day_boundaries_between, is_late, purchase_date
from martwright.operators.joins import checked_small, left_join_dim

ORDER_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
    "order_status", "order_purchase_ts", "order_delivered_customer_ts",
    "order_estimated_delivery_ts", "order_purchase_date", "delivery_days", "delay_days",
    "is_late", "payment_value_total", "payment_installments_max", "payment_types",
    "review_score_avg",
]

ITEM_COLUMNS = [
    "order_id", "order_item_id", "order_status", "order_purchase_ts", "order_purchase_date",
    "customer_id", "customer_unique_id", "customer_city", "customer_state",
    "product_id", "product_category_en", "seller_id", "seller_city", "seller_state",
    "price", "freight_value", "item_gmv", "payment_value_total", "review_score_avg",
]

# Columns that follow from others of their row.
ITEM_DERIVED = ("order_purchase_date", "item_gmv")


def _order_derived(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "order_status", "order_purchase_ts", "order_delivered_customer_ts",
        "order_estimated_delivery_ts",
        purchase_date("order_purchase_ts").alias("order_purchase_date"),
        day_boundaries_between("order_purchase_ts", "order_delivered_customer_ts")
        .alias("delivery_days"),
        day_boundaries_between("order_estimated_delivery_ts", "order_delivered_customer_ts")
        .alias("delay_days"),
        is_late("order_delivered_customer_ts", "order_estimated_delivery_ts").alias("is_late"),
        "payment_value_total", "payment_installments_max", "payment_types", "review_score_avg",
    )


def mart_orders(orders: DataFrame, dim_customers: DataFrame, payments_agg: DataFrame,
                reviews_agg: DataFrame) -> DataFrame:
    """orders ⟕ customers ⟕ payments ⟕ reviews at order grain.

    The two ``order_id`` joins go first: both aggregates arrive partitioned
    on ``order_id`` and the orders are shuffled to match once.
    """
    pay = payments_agg.select("order_id", "payment_value_total", "payment_installments_max",
                              "payment_types")
    rev = reviews_agg.select("order_id", "review_score_avg")
    cust = dim_customers.select("customer_id", "customer_unique_id", "customer_city",
                                "customer_state")
    joined = (orders.join(pay, "order_id", "left").join(rev, "order_id", "left"))
    joined = left_join_dim(joined, cust, "customer_id")
    return _order_derived(joined)


def mart_order_items(items: DataFrame, orders: DataFrame, dim_customers: DataFrame,
                     payments_agg: DataFrame, reviews_agg: DataFrame, dim_products: DataFrame,
                     dim_sellers: DataFrame, dims_stored: bool = False,
                     orders_mart: DataFrame | None = None) -> DataFrame:
    """Item grain. Order-level money (payment total, review mean) repeats per item: never sum it.

    items ⟕ orders (with customers) ⟕ payments ⟕ reviews, all on the item's order id: items are
    shuffled on it once, and the two aggregates arrive partitioned by it.

    ``dims_stored`` says that the sizes of the product and seller dimensions are known, not
    estimated: one too large for a broadcast then joins the items first, as it shuffles them by its
    key, and they are still narrow. An estimated one joins last, where AQE has measured it by then.

    ``orders_mart`` is the stored ``mart_orders`` of these orders, customers, payments and reviews: the
    items then join it alone, instead of joining the orders' tables again, one by one, at item grain.
    """
    dims = {"product_id": dim_products.select("product_id", "product_category_en"),
            "seller_id": dim_sellers.select("seller_id", "seller_city", "seller_state")}
    first = [key for key, dim in dims.items() if dims_stored and not checked_small(dim)]
    for key in first:
        items = left_join_dim(items, dims.pop(key), key)
    if orders_mart is not None:
        joined = items.join(_order_side(orders_mart, payments_agg, reviews_agg), "order_id", "left")
    else:
        cust = dim_customers.select("customer_id", "customer_unique_id", "customer_city",
                                    "customer_state")
        o = left_join_dim(orders.select("order_id", "order_status", "order_purchase_ts", "customer_id"),
                          cust, "customer_id")
        joined = (items.join(o, "order_id", "left")
                  .join(payments_agg.select("order_id", "payment_value_total"), "order_id", "left")
                  .join(reviews_agg.select("order_id", "review_score_avg"), "order_id", "left"))
    for key, dim in dims.items():
        joined = left_join_dim(joined, dim, key)
    return item_derived(joined)


def item_derived(df: DataFrame) -> DataFrame:
    """The item mart's columns, of a table that has all but ``ITEM_DERIVED``."""
    return df.select(*[c for c in ITEM_COLUMNS if c not in ITEM_DERIVED]).withColumns({
        "order_purchase_date": purchase_date("order_purchase_ts"),
        "item_gmv": F.col("price") + F.col("freight_value")}).select(*ITEM_COLUMNS)


def _order_side(orders_mart: DataFrame, payments_agg: DataFrame, reviews_agg: DataFrame) -> DataFrame:
    """What items take from their order: the order mart's columns, and for ids that are in no order
    (an item of one still has its payments and reviews) those of the two aggregates.
    """
    known = orders_mart.select("order_id")
    pay = payments_agg.select("order_id", "payment_value_total").join(known, "order_id", "left_anti")
    rev = reviews_agg.select("order_id", "review_score_avg").join(known, "order_id", "left_anti")
    return (orders_mart.select("order_id", "order_status", "order_purchase_ts", "customer_id", "customer_unique_id",
                               "customer_city", "customer_state", "payment_value_total", "review_score_avg")
            .unionByName(pay.join(rev, "order_id", "full"), allowMissingColumns=True))


_ORDER_ATTRS = {"order_status", "order_purchase_ts", "order_purchase_date", "customer_id"}
_CUSTOMER_ATTRS = {"customer_unique_id", "customer_city", "customer_state"}


def item_facts(columns: list[str], items: DataFrame, orders: DataFrame,
               dim_customers=None, dim_products=None, dim_sellers=None,
               payments_agg=None, reviews_agg=None) -> DataFrame:
    """Item-grain columns of ``mart_order_items``, joining only what ``columns`` need.

    Catalyst cannot drop an unused left join (dimension keys are not
    declared unique), so a query reading four item-mart columns would still
    pay for every dimension join. This builder plans only the needed ones:
    order (and customer, at order grain) attributes by ``order_id``, then
    product / seller / payment / review attributes. Same rows and values as
    the full mart for unique dimension keys. Dimension arguments are
    zero-argument callables, evaluated only when needed.
    """
    need = set(columns)
    base_cols = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]
    df = items.select(*base_cols)
    if need & (_ORDER_ATTRS | _CUSTOMER_ATTRS):
        o = orders.select("order_id", "customer_id", "order_status", "order_purchase_ts")
        if need & _CUSTOMER_ATTRS:
            cust = dim_customers().select("customer_id", *sorted(need & _CUSTOMER_ATTRS))
            o = left_join_dim(o, cust, "customer_id")
        df = df.join(o, "order_id", "left")
    if "product_category_en" in need:
        df = left_join_dim(df, dim_products().select("product_id", "product_category_en"),
                           "product_id")
    if need & {"seller_city", "seller_state"}:
        df = left_join_dim(df, dim_sellers().select("seller_id", "seller_city", "seller_state"),
                           "seller_id")
    if "payment_value_total" in need:
        df = df.join(payments_agg().select("order_id", "payment_value_total"), "order_id", "left")
    if "review_score_avg" in need:
        df = df.join(reviews_agg().select("order_id", "review_score_avg"), "order_id", "left")
    derived = {}
    if "order_purchase_date" in need:
        derived["order_purchase_date"] = purchase_date("order_purchase_ts")
    if "item_gmv" in need:
        derived["item_gmv"] = F.col("price") + F.col("freight_value")
    return df.withColumns(derived).select(*columns)


def delivered_filter(df: DataFrame) -> DataFrame:
    """Delivered orders with a known purchase date (the sales definition)."""
    return df.where((F.col("order_status") == "delivered")
                    & F.col("order_purchase_date").isNotNull())


def item_sales_facts(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lean item-grain facts for sales aggregates straight from staging.

    Only the order status and purchase time are needed; the delivered filter
    turns the left join into an inner join and is pushed below it.
    """
    o = orders.select("order_id", "order_status", "order_purchase_ts")
    return (items.select("order_id", "price", "freight_value")
            .join(o, "order_id", "left")
            .select("order_id", "order_status",
                    purchase_date("order_purchase_ts").alias("order_purchase_date"),
                    (F.col("price") + F.col("freight_value")).alias("item_gmv")))


def mart_sales_daily(item_facts: DataFrame, series_keys: list[str] | None = None) -> DataFrame:
    """Daily sales of delivered orders: y = Σ item_gmv, distinct orders, item count.

    ``series_keys`` (e.g. ``["customer_state"]``) yields one series per key.
    Only days with sales appear; gaps are not filled.
    """
    keys = list(series_keys or [])
    return (delivered_filter(item_facts)
            .groupBy(*keys, F.col("order_purchase_date").alias("ds"))
            .agg(F.sum("item_gmv").alias("y"),
                 F.count_distinct("order_id").alias("orders"),
                 F.count(F.lit(1)).alias("items")))


def kpi_summary(daily: DataFrame) -> DataFrame:
    """Global KPI row; one all-NULL row on an empty daily mart.

    ``total_orders`` is Σ daily distinct orders, exact because an order has
    one purchase date; ``avg_daily_gmv`` averages days with sales only.
    """
    return daily.agg(
        F.min("ds").alias("min_date"), F.max("ds").alias("max_date"),
        F.sum("y").alias("total_gmv"),
        F.sum("orders").cast("bigint").alias("total_orders"),
        F.sum("items").cast("bigint").alias("total_items"),
        F.avg("y").alias("avg_daily_gmv"))


__all__ = [
    "ORDER_COLUMNS", "ITEM_COLUMNS", "mart_orders", "mart_order_items", "delivered_filter", "item_sales_facts", "mart_sales_daily",
    "kpi_summary", "item_facts", "item_derived", "ITEM_DERIVED",
]
