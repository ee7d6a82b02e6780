"""Dashboard data queries over the marts (no UI)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: report sizes ---
TOP_CATEGORIES = 15
TOP_STATES = 20


def _delivered(items: DataFrame) -> DataFrame:
    return items.where(F.col("order_status") == "delivered")


def top_categories(items: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Top-n categories by delivered GMV (NULL category kept as its own group).

    Partial sums combine map-side; the top-n is a ``TakeOrderedAndProject``
    over one row per category. Ties break on the name.
    """
    return (_delivered(items).groupBy("product_category_en")
            .agg(F.sum("item_gmv").alias("gmv"))
            .orderBy(F.col("gmv").desc(), F.col("product_category_en").asc_nulls_last())
            .limit(n))


def state_sales(items: DataFrame) -> DataFrame:
    """Delivered GMV and distinct orders per customer state, largest first."""
    return (_delivered(items).groupBy("customer_state")
            .agg(F.sum("item_gmv").alias("gmv"), F.count_distinct("order_id").alias("orders"))
            .orderBy(F.col("gmv").desc(), F.col("customer_state").asc_nulls_last()))


def state_sales_top(items: DataFrame, n: int = TOP_STATES) -> DataFrame:
    return state_sales(items).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(t, rows)`` per named table, as a union of one-row counts."""
    parts = [df.select(F.lit(name).alias("t"), F.count(F.lit(1)).alias("rows"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kpi_card_values(kpi: DataFrame) -> DataFrame:
    """The four KPI card numbers with their display types (float, int, int, float)."""
    return kpi.select(F.col("total_gmv").cast("double").alias("total_gmv"),
                      F.col("total_orders").cast("bigint").alias("total_orders"),
                      F.col("total_items").cast("bigint").alias("total_items"),
                      F.col("avg_daily_gmv").cast("double").alias("avg_daily_gmv"))


def daily_sorted(daily: DataFrame) -> DataFrame:
    """Read the daily mart in day order (stored row order is not a contract)."""
    return daily.select("ds", "y", "orders", "items").orderBy("ds")
