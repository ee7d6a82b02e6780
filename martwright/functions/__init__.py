"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from martwright.functions.coercion import to_numeric
from martwright.functions.dates import (
    calendar_columns, day_boundaries_between, purchase_date, weekday_name,
)
from martwright.functions.flags import is_late
from martwright.functions.metrics import abs_error, pct_error, squared_error

__all__ = [
    "calendar_columns", "day_boundaries_between", "purchase_date", "weekday_name",
    "to_numeric", "is_late", "abs_error", "pct_error", "squared_error",
]
