"""Staging layer: cast and rename each raw input into its typed contract.

Two cast modes, as in the source system: strict ``cast`` (under ANSI mode a
bad value fails the load) and ``try_cast`` for timestamps (bad text → NULL).
All projections are narrow ``select``s, so they fuse into the scan's
whole-stage-codegen span and only the referenced raw columns are read.
The one aggregation here (geolocation by zip prefix) combines map-side
before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS = "timestamp_ntz"


def _cast(name: str, to: str) -> Column:
    return F.col(name).cast(to)


def _try_ts(name: str) -> Column:
    return F.col(name).try_cast(TS)


def _whole(name: str) -> Column:
    """Integer column that may arrive as '58.0' text: read as double, round half to even, then INT."""
    return F.bround(F.col(name).cast("double")).cast("int")


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        _cast("order_id", "string").alias("order_id"),
        _cast("customer_id", "string").alias("customer_id"),
        _cast("order_status", "string").alias("order_status"),
        _try_ts("order_purchase_timestamp").alias("order_purchase_ts"),
        _try_ts("order_approved_at").alias("order_approved_ts"),
        _try_ts("order_delivered_carrier_date").alias("order_delivered_carrier_ts"),
        _try_ts("order_delivered_customer_date").alias("order_delivered_customer_ts"),
        _try_ts("order_estimated_delivery_date").alias("order_estimated_delivery_ts"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _cast("order_id", "string").alias("order_id"),
        _cast("order_item_id", "int").alias("order_item_id"),
        _cast("product_id", "string").alias("product_id"),
        _cast("seller_id", "string").alias("seller_id"),
        _try_ts("shipping_limit_date").alias("shipping_limit_ts"),
        _cast("price", "double").alias("price"),
        _cast("freight_value", "double").alias("freight_value"),
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _cast("order_id", "string").alias("order_id"),
        _cast("payment_sequential", "int").alias("payment_sequential"),
        _cast("payment_type", "string").alias("payment_type"),
        _cast("payment_installments", "int").alias("payment_installments"),
        _cast("payment_value", "double").alias("payment_value"),
    )


def stage_reviews(raw: DataFrame) -> DataFrame:
    """Free-text comment columns are projected away."""
    return raw.select(
        _cast("review_id", "string").alias("review_id"),
        _cast("order_id", "string").alias("order_id"),
        _cast("review_score", "int").alias("review_score"),
        _try_ts("review_creation_date").alias("review_creation_ts"),
        _try_ts("review_answer_timestamp").alias("review_answer_ts"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    """Zip prefix becomes INT ('01037' → 1037, as in the source system)."""
    return raw.select(
        _cast("customer_id", "string").alias("customer_id"),
        _cast("customer_unique_id", "string").alias("customer_unique_id"),
        _cast("customer_zip_code_prefix", "int").alias("customer_zip_prefix"),
        _cast("customer_city", "string").alias("customer_city"),
        _cast("customer_state", "string").alias("customer_state"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    """Fixes the misspelled ``*_lenght`` headers; integer counts tolerate '58.0'."""
    return raw.select(
        _cast("product_id", "string").alias("product_id"),
        _cast("product_category_name", "string").alias("product_category_name"),
        _whole("product_name_lenght").alias("product_name_length"),
        _whole("product_description_lenght").alias("product_description_length"),
        _whole("product_photos_qty").alias("product_photos_qty"),
        _cast("product_weight_g", "double").alias("product_weight_g"),
        _cast("product_length_cm", "double").alias("product_length_cm"),
        _cast("product_height_cm", "double").alias("product_height_cm"),
        _cast("product_width_cm", "double").alias("product_width_cm"),
    )


def stage_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _cast("seller_id", "string").alias("seller_id"),
        _cast("seller_zip_code_prefix", "int").alias("seller_zip_prefix"),
        _cast("seller_city", "string").alias("seller_city"),
        _cast("seller_state", "string").alias("seller_state"),
    )


def stage_geolocation(raw: DataFrame) -> DataFrame:
    """Many points per zip prefix → one row per prefix.

    City and state take a deterministic non-null representative (the
    minimum); coordinates are averaged. Partial aggregation runs before the
    shuffle, so a prefix holding a third of all points costs one row per
    map task, not a third of the data in one reducer.
    """
    return (raw.groupBy(_cast("geolocation_zip_code_prefix", "int").alias("zip_prefix"))
            .agg(F.min(_cast("geolocation_city", "string")).alias("city"),
                 F.min(_cast("geolocation_state", "string")).alias("state"),
                 F.avg(_cast("geolocation_lat", "double")).alias("lat"),
                 F.avg(_cast("geolocation_lng", "double")).alias("lng")))


def stage_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        _cast("product_category_name", "string").alias("product_category_name"),
        _cast("product_category_name_english", "string").alias("product_category_name_english"),
    )


STAGERS = {
    "orders": stage_orders,
    "order_items": stage_order_items,
    "payments": stage_payments,
    "reviews": stage_reviews,
    "customers": stage_customers,
    "products": stage_products,
    "sellers": stage_sellers,
    "geolocation": stage_geolocation,
    "category_translation": stage_category_translation,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGERS[name](df) for name, df in raw.items()}
