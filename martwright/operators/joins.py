"""Join helpers: broadcast only behind a size check, otherwise let AQE decide.

An explicit ``broadcast()`` hint overrides Spark's own threshold, so it is
added only when the optimizer's size estimate of the small side is under a
limit. Catalyst's estimate of an un-materialised aggregate is its input size,
an upper bound, so the check errs towards not broadcasting. Above the limit
the join is planned as a shuffle join and AQE may still switch it to a
broadcast after measuring the real shuffle output
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), or split a skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Catalyst's estimate is file-size based (compressed); in memory a side can be a
# few times larger, so the hint limit is kept well under Spark's broadcast cap.
DEFAULT_BROADCAST_LIMIT = 32 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (None when not available, e.g. Spark Connect)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # noqa: BLE001 - estimate is advisory only
        return None


def checked_small(df: DataFrame, limit: int | None = None) -> bool:
    limit = DEFAULT_BROADCAST_LIMIT if limit is None else limit
    size = estimated_size_bytes(df)
    return size is not None and size <= limit


def maybe_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    return F.broadcast(df) if checked_small(df, limit) else df


def left_join_dim(fact: DataFrame, dim: DataFrame, on: str | list[str],
                  limit: int | None = None) -> DataFrame:
    """``fact`` ⟕ ``dim`` on equal key columns; dim broadcast only if checked small."""
    return fact.join(maybe_broadcast(dim, limit), on=on, how="left")


def semi_join(child: DataFrame, keys: DataFrame, on: str | list[str],
              limit: int | None = None) -> DataFrame:
    """Rows of ``child`` whose key occurs in ``keys`` (NULL keys never match)."""
    return child.join(maybe_broadcast(keys, limit), on=on, how="left_semi")
