"""Date and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def purchase_date(ts: str | Column) -> Column:
    """Calendar date of a zone-less timestamp (truncation, not rounding)."""
    return F.to_date(ts)


def day_boundaries_between(start: str | Column, end: str | Column) -> Column:
    """Day boundaries crossed going from ``start`` to ``end`` (may be negative).

    23:30 → 00:30 next day counts 1, unlike a 24-hour difference. BIGINT.
    """
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def weekday_name(ds: str | Column) -> Column:
    """Full English weekday name ('Monday'); ``dayname`` would give 'Mon'."""
    return F.date_format(ds, "EEEE")


def calendar_columns(ds: str = "ds") -> dict[str, Column]:
    """The six calendar features: Monday=0 weekday, ISO week, month, year, day, weekend flag."""
    d = F.col(ds)
    dow = F.weekday(d)
    return {
        "dow": dow,
        "week": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
        "day": F.dayofmonth(d),
        "is_weekend": (dow >= 5).cast("int"),
    }
