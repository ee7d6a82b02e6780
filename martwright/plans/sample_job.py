"""Referentially consistent sample of the raw inputs.

Orders are sampled (exact size, deterministic); items, payments and reviews
follow their order, customers follow the sampled orders, products and
sellers follow the *sampled items*; the category translation is copied
whole and geolocation is sampled on its own. Each table is written as CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.operators.sampling import sample_by_keys, sample_children, sample_exact_n
from martwright.schemas import REQUIRED_FILES
from martwright.session import checkpoint
from martwright.sinks.exports import write_csv_file

# --- fixed values: default sample sizes and seed ---
SAMPLE_ORDERS = 15000
SAMPLE_GEOLOCATION = 50000
SEED = 42


def sample_tables(raw: dict[str, DataFrame], n_orders: int = SAMPLE_ORDERS,
                  n_geo: int = SAMPLE_GEOLOCATION, seed: int = SEED) -> dict[str, DataFrame]:
    # The sample (≤ n rows) feeds six consumers; materialise it once instead of
    # re-running the hash top-n for each. Same for the sampled items, which key
    # the product and seller samples.
    orders = checkpoint(sample_exact_n(raw["orders"], n_orders, ["order_id"], seed))
    out = {"orders": orders}
    out.update(sample_children({k: raw[k] for k in ("order_items", "payments", "reviews")},
                               orders, "order_id"))
    out["order_items"] = checkpoint(out["order_items"])
    out["customers"] = sample_by_keys(raw["customers"], orders, "customer_id", "customer_id")
    out["products"] = sample_by_keys(raw["products"], out["order_items"], "product_id",
                                     "product_id")
    out["sellers"] = sample_by_keys(raw["sellers"], out["order_items"], "seller_id", "seller_id")
    out["category_translation"] = raw["category_translation"]
    out["geolocation"] = sample_exact_n(raw["geolocation"], n_geo,
                                        list(raw["geolocation"].columns), seed)
    return out


def make_sample(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str,
                n_orders: int = SAMPLE_ORDERS, n_geo: int = SAMPLE_GEOLOCATION,
                seed: int = SEED) -> dict[str, str]:
    """Write the sampled tables under ``out_dir`` with the required input file names."""
    tables = sample_tables(raw, n_orders, n_geo, seed)
    written = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{REQUIRED_FILES[name]}"
        written[name] = write_csv_file(df, path)
    return written
