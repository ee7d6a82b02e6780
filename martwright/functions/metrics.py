"""Forecast error expressions (aggregated with ``avg`` by the callers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: floor of the MAPE denominator (applied to the signed actual) ---
MAPE_FLOOR = 1e-9


def abs_error(y: str, yhat: str) -> Column:
    return F.abs(F.col(y) - F.col(yhat))


def squared_error(y: str, yhat: str) -> Column:
    return F.pow(F.col(y) - F.col(yhat), 2)


def pct_error(y: str, yhat: str) -> Column:
    """|y - ŷ| / max(1e-9, y): the floor is taken on the signed actual."""
    return F.abs((F.col(y) - F.col(yhat)) / F.greatest(F.lit(MAPE_FLOOR), F.col(y)))
