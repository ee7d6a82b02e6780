"""Per-query build context over the driver tables.

Each registered query gets a fresh ``Context``; layer tables are built lazily
(and memoised within that one query) so a query only plans what it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.operators import dimensions, marts, order_aggregates, staging
from martwright.session import ensure_checkpoint_dir
from martwright.sources import driver_tables


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}
        ensure_checkpoint_dir(spark)

    def _get(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def table(self, name: str) -> DataFrame:
        return self._get(f"table.{name}",
                         lambda: driver_tables.read_table(self.spark, self.sf_dir, name))

    def raw(self, name: str) -> DataFrame:
        return self._get(f"raw.{name}",
                         lambda: driver_tables.RAW_BUILDERS[name](self.spark, self.sf_dir))

    def stg(self, name: str) -> DataFrame:
        return self._get(f"stg.{name}", lambda: staging.STAGERS[name](self.raw(name)))

    def mart(self, name: str) -> DataFrame:
        builders = {
            "dim_customers": lambda: dimensions.dim_customers(self.stg("customers"),
                                                              self.stg("geolocation")),
            "dim_sellers": lambda: dimensions.dim_sellers(self.stg("sellers"),
                                                          self.stg("geolocation")),
            "dim_products": lambda: dimensions.dim_products(self.stg("products"),
                                                            self.stg("category_translation")),
            "order_payments": lambda: order_aggregates.order_payments(self.stg("payments")),
            "order_reviews": lambda: order_aggregates.order_reviews(self.stg("reviews")),
            "mart_orders": lambda: marts.mart_orders(self.stg("orders"), self.mart("dim_customers"),
                                                     self.mart("order_payments"),
                                                     self.mart("order_reviews")),
            "mart_order_items": lambda: marts.mart_order_items(
                self.stg("order_items"), self.stg("orders"), self.mart("dim_customers"),
                self.mart("order_payments"), self.mart("order_reviews"),
                self.mart("dim_products"), self.mart("dim_sellers")),
            "item_sales_facts": lambda: marts.item_sales_facts(self.stg("order_items"),
                                                               self.stg("orders")),
            "mart_sales_daily": lambda: marts.mart_sales_daily(self.mart("item_sales_facts")),
            "kpi_summary": lambda: marts.kpi_summary(self.mart("mart_sales_daily")),
        }
        return self._get(f"mart.{name}", builders[name])

    def items(self, *columns: str) -> DataFrame:
        """Item-mart columns with only the joins they need (see ``marts.item_facts``)."""
        return self._get("items." + ",".join(columns), lambda: marts.item_facts(
            list(columns), self.stg("order_items"), self.stg("orders"),
            dim_customers=lambda: self.mart("dim_customers"),
            dim_products=lambda: self.mart("dim_products"),
            dim_sellers=lambda: self.mart("dim_sellers"),
            payments_agg=lambda: self.mart("order_payments"),
            reviews_agg=lambda: self.mart("order_reviews")))

    def delivered_items(self) -> DataFrame:
        """Training extract: (customer_unique_id, order_id, order_purchase_date, item_gmv)."""
        from pyspark.sql import functions as F
        it = self.items("customer_unique_id", "order_id", "order_purchase_date", "item_gmv",
                        "order_status")
        return (it.where((F.col("order_status") == "delivered")
                         & F.col("customer_unique_id").isNotNull()
                         & F.col("order_purchase_date").isNotNull())
                .drop("order_status"))
