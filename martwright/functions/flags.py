"""Conditional projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_late(delivered: str | Column, estimated: str | Column) -> Column:
    """Three-valued lateness flag.

    NULL when either timestamp is missing, 1 when delivery is strictly after
    the estimate (full timestamp compare), otherwise 0.
    """
    d, e = F.col(delivered) if isinstance(delivered, str) else delivered, \
        F.col(estimated) if isinstance(estimated, str) else estimated
    return (F.when(d.isNull() | e.isNull(), F.lit(None).cast("int"))
            .when(d > e, F.lit(1))
            .otherwise(F.lit(0)))
