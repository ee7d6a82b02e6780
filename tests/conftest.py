from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# These tests need the shipped daily series; they are collected only when its path is given.
collect_ignore = [] if os.environ.get("MARTWRIGHT_GOLDEN_DAILY") else ["test_golden_series.py"]

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martwright.session import build_session
    s = build_session(os.environ.get("MARTWRIGHT_TEST_MASTER", "local[4]"), shuffle_partitions=8, app_name="martwright-tests",
                      extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL


@pytest.fixture(scope="session")
def duck(sf_small):
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con
