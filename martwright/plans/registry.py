"""Registry of checked queries: Spark builder + DuckDB oracle per key.

A query is registered with the DOUBLE columns that get rounded before the
order-insensitive value comparison (floating sums differ in the last bits
between engines; fixture money is whole cents, so 2 dp is exact for sums).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans.context import Context
from martwright.plans.oracle_sql import full_sql

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def apply_rounding(df: DataFrame, rounding: dict[str, int] | None) -> DataFrame:
    if not rounding:
        return df
    return df.select(*[F.round(c, rounding[c]).alias(c) if c in rounding else F.col(c)
                       for c in df.columns])


def register(key: str, sql: str | None = None, rounding: dict[str, int] | None = None):
    """Decorator: ``fn(ctx) -> DataFrame`` becomes ``queries()[key]``."""

    def deco(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return apply_rounding(fn(Context(spark, sf_dir)), rounding)

        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = run
        if sql is not None:
            _ORACLE[key] = full_sql(sql, rounding)
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # Importing the catalogue modules registers their queries.
    from martwright.plans import catalog  # noqa: F401
