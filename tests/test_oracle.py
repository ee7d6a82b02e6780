"""Every query with an oracle matches DuckDB on the small driver tables.

Same comparison as the correctness gate: column names, a coarse type class
per column, row count and the order-insensitive multiset of values.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from scripts.oracle_check import compare, duck_rows, spark_rows

# Composite jobs that write many tables are covered once in test_pipelines.
SLOW = {"run_pipeline", "export_all", "make_sample", "ensure_built", "model_checks"}
KEYS = sorted(k for k in entry.oracle_sql() if k not in SLOW and not k.startswith("op"))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, sf_small, key):
    got = spark_rows(spark, entry.queries()[key], sf_small)
    want = duck_rows(duck, entry.oracle_sql()[key])
    assert compare(got, want) is None


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["min_date", "max_date", "total_gmv", "total_orders", "total_items",
                          "avg_daily_gmv"]
