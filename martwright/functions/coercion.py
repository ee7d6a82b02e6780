"""Lenient conversions: what is no value of the type becomes NULL, where a strict cast fails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(value: str | Column) -> Column:
    """DOUBLE of a number or a text that is one (blanks around it don't matter); other text → NULL.

    Texts of infinity and not-a-number are no numbers here: NULL.
    """
    c = F.col(value) if isinstance(value, str) else value
    number = c.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
