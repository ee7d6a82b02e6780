"""Dimension tables: customers and sellers with coordinates, products with English category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import maybe_broadcast


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """stg.customers ⟕ geolocation on zip prefix; geolocation is one row per prefix."""
    g = maybe_broadcast(geolocation.select(
        F.col("zip_prefix"), F.col("lat").alias("customer_lat"), F.col("lng").alias("customer_lng")))
    return (customers.join(g, customers.customer_zip_prefix == g.zip_prefix, "left")
            .select(*[customers[c] for c in customers.columns], "customer_lat", "customer_lng"))


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    g = maybe_broadcast(geolocation.select(
        F.col("zip_prefix"), F.col("lat").alias("seller_lat"), F.col("lng").alias("seller_lng")))
    return (sellers.join(g, sellers.seller_zip_prefix == g.zip_prefix, "left")
            .select(*[sellers[c] for c in sellers.columns], "seller_lat", "seller_lng"))


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category when known, else the original name, else NULL."""
    t = maybe_broadcast(translation.select(
        F.col("product_category_name").alias("_cat"), "product_category_name_english"))
    return (products.join(t, products.product_category_name == t._cat, "left")
            .select(*[products[c] for c in products.columns],
                    F.coalesce("product_category_name_english", products.product_category_name)
                    .alias("product_category_en")))
