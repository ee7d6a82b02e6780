"""Warehouse queries: staging projections, dimensions, order aggregates, marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import is_late, to_numeric
from martwright.operators import dimensions, marts
from martwright.plans.context import Context
from martwright.plans.registry import register

GEO = 6  # decimals kept for averaged coordinates
MONEY = 2

# ---------------------------------------------------------------- staging


@register("stg_orders", "SELECT * FROM stg_orders")
def stg_orders(ctx: Context):
    """Cast/rename orders; five timestamps through try_cast."""
    return ctx.stg("orders")


@register("stg_order_items", "SELECT * FROM stg_order_items")
def stg_order_items(ctx: Context):
    """Item ids INT, money DOUBLE, shipping limit through try_cast."""
    return ctx.stg("order_items")


@register("stg_payments", "SELECT * FROM stg_payments")
def stg_payments(ctx: Context):
    """Sequential / instalments INT, value DOUBLE."""
    return ctx.stg("payments")


@register("stg_reviews", "SELECT * FROM stg_reviews")
def stg_reviews(ctx: Context):
    """Score INT, two try_cast timestamps; comment text projected away."""
    return ctx.stg("reviews")


@register("stg_customers", "SELECT * FROM stg_customers")
def stg_customers(ctx: Context):
    """Zip prefix STRING → INT (leading zeros dropped)."""
    return ctx.stg("customers")


@register("stg_products", "SELECT * FROM stg_products")
def stg_products(ctx: Context):
    """Misspelled length headers renamed; integer counts tolerate '58.0'."""
    return ctx.stg("products")


@register("stg_sellers", "SELECT * FROM stg_sellers")
def stg_sellers(ctx: Context):
    """Zip prefix INT."""
    return ctx.stg("sellers")


@register("stg_geolocation", "SELECT * FROM stg_geolocation", rounding={"lat": GEO, "lng": GEO})
def stg_geolocation(ctx: Context):
    """Points aggregated per zip prefix."""
    return ctx.stg("geolocation")


@register("stg_category_translation", "SELECT * FROM stg_category_translation")
def stg_category_translation(ctx: Context):
    """Category → English name (two strings)."""
    return ctx.stg("category_translation")


# ------------------------------------------------------------- dimensions


@register("dim_customers", "SELECT * FROM dim_customers",
          rounding={"customer_lat": GEO, "customer_lng": GEO})
def dim_customers(ctx: Context):
    """Customers ⟕ geolocation on zip prefix (coordinates)."""
    return ctx.mart("dim_customers")


@register("dim_sellers", "SELECT * FROM dim_sellers",
          rounding={"seller_lat": GEO, "seller_lng": GEO})
def dim_sellers(ctx: Context):
    """Sellers ⟕ geolocation on zip prefix (coordinates)."""
    return ctx.mart("dim_sellers")


@register("dim_products", "SELECT * FROM dim_products")
def dim_products(ctx: Context):
    """Products ⟕ category names, English name with fallback."""
    return ctx.mart("dim_products")


@register("coalesce_category",
          "SELECT product_id, product_category_name, product_category_en FROM dim_products")
def coalesce_category(ctx: Context):
    """English category, else original, else NULL."""
    return ctx.mart("dim_products").select("product_id", "product_category_name",
                                           "product_category_en")


@register("dim_products_untranslated", """
    SELECT product_id, product_category_name,
           CASE WHEN ascii(product_category_name) % 2 = 0 THEN lower(product_category_name) || '_en'
                ELSE product_category_name END AS product_category_en FROM stg_products""")
def dim_products_untranslated(ctx: Context):
    """Products against a translation table that lacks categories: those keep their own name."""
    known = ctx.stg("category_translation").where(F.ascii("product_category_name") % 2 == 0)
    return dimensions.dim_products(ctx.stg("products"), known).select(
        "product_id", "product_category_name", "product_category_en")


_LAT = "(SELECT avg({c} / {n}) FROM customer WHERE c_nationkey = {zip} AND c_nationkey % 3 <> 0)"


@register("dim_unmatched_zips", f"""
    SELECT 'customer' AS kind, customer_id AS id, {_LAT.format(c="c_acctbal", n=100, zip="customer_zip_prefix")} AS lat,
           {_LAT.format(c="-c_acctbal", n=200, zip="customer_zip_prefix")} AS lng FROM stg_customers
    UNION ALL
    SELECT 'seller', seller_id, {_LAT.format(c="c_acctbal", n=100, zip="seller_zip_prefix")},
           {_LAT.format(c="-c_acctbal", n=200, zip="seller_zip_prefix")} FROM stg_sellers""",
          rounding={"lat": 6, "lng": 6})
def dim_unmatched_zips(ctx: Context):
    """Customers and sellers against locations that lack zip prefixes: no row is lost, they get NULL."""
    known = ctx.stg("geolocation").where(F.col("zip_prefix") % 3 != 0)
    customers = dimensions.dim_customers(ctx.stg("customers"), known)
    sellers = dimensions.dim_sellers(ctx.stg("sellers"), known)
    return customers.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"),
                            F.col("customer_lat").alias("lat"), F.col("customer_lng").alias("lng")).unionByName(
        sellers.select(F.lit("seller").alias("kind"), F.col("seller_id").alias("id"),
                       F.col("seller_lat").alias("lat"), F.col("seller_lng").alias("lng")))


@register("to_numeric", """
    SELECT l_orderkey AS order_id, l_linenumber AS item,
           CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(l_extendedprice AS DOUBLE) END AS y
    FROM lineitem""", rounding={"y": 2})
def to_numeric_q(ctx: Context):
    """Prices as texts, some of them no numbers: those become NULL, the others numbers."""
    text = F.col("l_extendedprice").cast("string")
    odd = (F.when(F.col("l_linenumber") == 3, F.concat(text, F.lit(" BRL")))
           .when(F.col("l_linenumber") == 5, F.lit("n/a"))
           .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), text, F.lit(" "))).otherwise(text))
    return ctx.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item"),
                                        to_numeric(odd).alias("y"))


# ------------------------------------------------------- order aggregates


@register("order_payments", "SELECT * FROM order_payments",
          rounding={"payment_value_total": MONEY})
def order_payments(ctx: Context):
    """Per order: Σ value, max instalments, sorted distinct types."""
    return ctx.mart("order_payments")


@register("order_reviews", "SELECT * FROM order_reviews")
def order_reviews(ctx: Context):
    """Per order: mean score, first review time."""
    return ctx.mart("order_reviews")


# ------------------------------------------------------------------ marts


@register("mart_orders", "SELECT * FROM mart_orders", rounding={"payment_value_total": MONEY})
def mart_orders(ctx: Context):
    """Order mart: orders ⟕ customers ⟕ payments ⟕ reviews + delivery metrics."""
    return ctx.mart("mart_orders")


@register("mart_order_items", "SELECT * FROM mart_order_items",
          rounding={"payment_value_total": MONEY})
def mart_order_items(ctx: Context):
    """Item mart: items ⟕ order side ⟕ products ⟕ sellers, item GMV."""
    return ctx.mart("mart_order_items")


@register("case_is_late",
          """SELECT order_id,
                    CAST(order_delivered_customer_ts > order_estimated_delivery_ts AS INTEGER) AS is_late
             FROM stg_orders""")
def case_is_late(ctx: Context):
    """Three-valued lateness flag on the staged orders."""
    return ctx.stg("orders").select(
        "order_id", is_late("order_delivered_customer_ts", "order_estimated_delivery_ts")
        .alias("is_late"))


@register("derive_item_gmv",
          "SELECT order_id, order_item_id, price + freight_value AS item_gmv FROM stg_order_items")
def derive_item_gmv(ctx: Context):
    """price + freight_value per item (NULL-propagating)."""
    return ctx.stg("order_items").select(
        "order_id", "order_item_id", (F.col("price") + F.col("freight_value")).alias("item_gmv"))


@register("mart_sales_daily", "SELECT * FROM mart_sales_daily", rounding={"y": MONEY})
def mart_sales_daily(ctx: Context):
    """Daily GMV, distinct orders and items of delivered orders."""
    return ctx.mart("mart_sales_daily")


@register("mart_sales_daily_from_items", "SELECT * FROM mart_sales_daily", rounding={"y": MONEY})
def mart_sales_daily_from_items(ctx: Context):
    """The daily mart computed from the full item mart (the stored-pipeline path)."""
    return marts.mart_sales_daily(ctx.mart("mart_order_items"))


@register("kpi_summary", "SELECT * FROM kpi_summary",
          rounding={"total_gmv": MONEY, "avg_daily_gmv": 6})
def kpi_summary(ctx: Context):
    """Global KPI row over the daily mart."""
    return ctx.mart("kpi_summary")


@register("filter_delivered",
          """SELECT order_id, order_status, order_purchase_date, item_gmv FROM mart_order_items
             WHERE order_status = 'delivered'""")
def filter_delivered(ctx: Context):
    """Equality filter on status over the item mart."""
    return (ctx.items("order_id", "order_status", "order_purchase_date", "item_gmv")
            .where(F.col("order_status") == "delivered"))


@register("scan_delivered_items", "SELECT * FROM delivered_items")
def scan_delivered_items(ctx: Context):
    """Training extract: 4 columns, delivered, customer and date not NULL."""
    return ctx.delivered_items()


@register("filter_not_null",
          """SELECT order_id, customer_unique_id, order_purchase_date FROM mart_order_items
             WHERE customer_unique_id IS NOT NULL AND order_purchase_date IS NOT NULL""")
def filter_not_null(ctx: Context):
    """IS NOT NULL predicates on the customer and the purchase date."""
    return (ctx.items("order_id", "customer_unique_id", "order_purchase_date")
            .where(F.col("customer_unique_id").isNotNull()
                   & F.col("order_purchase_date").isNotNull()))


@register("membership_filter",
          """SELECT * FROM stg_reviews
             WHERE order_id IN (SELECT order_id FROM stg_orders WHERE order_status = 'delivered')""")
def membership_filter(ctx: Context):
    """Child rows whose key is in a set: reviews of delivered orders (left semi join)."""
    from martwright.operators.joins import semi_join
    keys = ctx.stg("orders").where(F.col("order_status") == "delivered").select("order_id")
    return semi_join(ctx.stg("reviews"), keys, "order_id")
