"""Order-grain aggregates of payments and reviews.

Both group by ``order_id``; their output is hash-partitioned on that key, so
the order-level joins that follow reuse the partitioning instead of
shuffling the aggregate again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Types that fit a BIGINT's bits.
MAX_TYPE_BITS = 62


def payment_types(payments: DataFrame) -> list[str] | None:
    """The payment types, sorted, or None if there are more than ``MAX_TYPE_BITS``. Reads that column alone."""
    found = (payments.select("payment_type").where(F.col("payment_type").isNotNull())
             .distinct().limit(MAX_TYPE_BITS + 1).collect())
    return sorted(r.payment_type for r in found) if len(found) <= MAX_TYPE_BITS else None


def order_payments(payments: DataFrame, one_shuffle: bool = False, types: list[str] | None = None) -> DataFrame:
    """Per order: total value, max instalments, distinct payment types joined by ', '.

    Payments are first aggregated by (order, type), by plain hash aggregation with a map-side part,
    so an order with any number of payment rows has a handful of rows left; the second step is by
    order over those. Types are sorted so the text is deterministic. No types → NULL.

    ``one_shuffle`` aggregates by order at once: a task sends a row per order with its set of types,
    which is no longer than the text made of it. It moves a third of the bytes, but sorts the payments
    in every task, so it takes more CPU time: the exports use it if there are too many types for the below.

    ``types`` are all types there are (see ``payment_types``): an order's set of them is then a bit
    each of one number, so one hash aggregation with a map-side part does, without lists or a sort.
    """
    if types is not None:
        return _payments_by_bits(payments, types)
    if one_shuffle:
        held = F.array_sort(F.collect_set("payment_type"))
        return _typed_text(payments.groupBy("order_id").agg(
            F.sum("payment_value").alias("payment_value_total"),
            F.max("payment_installments").alias("payment_installments_max"), held.alias("_types")))
    types = (payments.groupBy("order_id", "payment_type")
             .agg(F.sum("payment_value").alias("value"), F.max("payment_installments").alias("installments")))
    held = F.array_sort(F.collect_list("payment_type"))
    return _typed_text(types.groupBy("order_id").agg(
        F.sum("value").alias("payment_value_total"),
        F.max("installments").alias("payment_installments_max"), held.alias("_types")))


def _payments_by_bits(payments: DataFrame, types: list[str]) -> DataFrame:
    bits = {t: 1 << i for i, t in enumerate(types)}
    bit, none = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for t, b in reversed(bits.items()):
        bit = F.when(F.col("payment_type") == t, F.lit(b).cast("bigint")).otherwise(bit)
    held = F.col("_types")
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value_total"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.bit_or(bit).alias("_types")).select(
        "order_id", "payment_value_total", "payment_installments_max",
        F.when(held != none, F.concat_ws(", ", *[
            F.when(held.bitwiseAND(F.lit(b).cast("bigint")) != none, F.lit(t)) for t, b in bits.items()]))
        .alias("payment_types"))


def _typed_text(df: DataFrame) -> DataFrame:
    return df.select("order_id", "payment_value_total", "payment_installments_max",
                     F.when(F.size("_types") > 0, F.array_join("_types", ", ")).alias("payment_types"))


def order_reviews(reviews: DataFrame) -> DataFrame:
    """Per order: mean score (DOUBLE) and first review time."""
    return (reviews.groupBy("order_id")
            .agg(F.avg("review_score").cast("double").alias("review_score_avg"),
                 F.min("review_creation_ts").alias("first_review_ts")))
