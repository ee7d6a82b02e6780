"""Input manifest and the typed contracts of the staging layer."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the nine raw input files the warehouse build requires ---
REQUIRED_FILES = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}

# --- fixed values: raw columns each input must provide (header names, read as text) ---
RAW_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type",
                 "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_creation_date",
                "review_answer_timestamp"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state",
                    "geolocation_lat", "geolocation_lng"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}

# Inputs whose free-text columns may hold quoted line breaks.
MULTILINE_INPUTS = {"reviews"}

S, I, D, TS, DT, L = (T.StringType(), T.IntegerType(), T.DoubleType(),
                      T.TimestampNTZType(), T.DateType(), T.LongType())


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: staged table contracts (column names and types) ---
STAGED = {
    "orders": struct(("order_id", S), ("customer_id", S), ("order_status", S),
                     ("order_purchase_ts", TS), ("order_approved_ts", TS),
                     ("order_delivered_carrier_ts", TS), ("order_delivered_customer_ts", TS),
                     ("order_estimated_delivery_ts", TS)),
    "order_items": struct(("order_id", S), ("order_item_id", I), ("product_id", S),
                          ("seller_id", S), ("shipping_limit_ts", TS), ("price", D),
                          ("freight_value", D)),
    "payments": struct(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                       ("payment_installments", I), ("payment_value", D)),
    "reviews": struct(("review_id", S), ("order_id", S), ("review_score", I),
                      ("review_creation_ts", TS), ("review_answer_ts", TS)),
    "customers": struct(("customer_id", S), ("customer_unique_id", S),
                        ("customer_zip_prefix", I), ("customer_city", S), ("customer_state", S)),
    "products": struct(("product_id", S), ("product_category_name", S),
                       ("product_name_length", I), ("product_description_length", I),
                       ("product_photos_qty", I), ("product_weight_g", D),
                       ("product_length_cm", D), ("product_height_cm", D),
                       ("product_width_cm", D)),
    "sellers": struct(("seller_id", S), ("seller_zip_prefix", I), ("seller_city", S),
                      ("seller_state", S)),
    "geolocation": struct(("zip_prefix", I), ("city", S), ("state", S), ("lat", D), ("lng", D)),
    "category_translation": struct(("product_category_name", S),
                                   ("product_category_name_english", S)),
}

DAILY = struct(("ds", DT), ("y", D), ("orders", L), ("items", L))

# Feature order used by the tree forecaster (model input contract).
GBT_FEATURES = ["dow", "week", "month", "year", "day", "is_weekend",
                "lag_1", "lag_7", "lag_14", "lag_28", "roll_7", "roll_14"]
