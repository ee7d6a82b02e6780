"""Exact-size, order-independent sampling and referential semi joins.

``sample_exact_n`` keeps the ``n`` rows with the smallest
``md5('<seed>:' || key)`` — exact size (Bernoulli ``sample`` is not),
identical on every engine and re-run. One pass counts the rows of each of
65,536 hash ranges; all rows of the ranges below the one where the count
reaches n are taken as they are, and only the hashes of that one range (a
65,536th of the input), with the number of their rows, are ordered to fill
the sample up. A table without a key is sampled by the hash of its whole rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.joins import maybe_broadcast, semi_join

# Leading hex digits of the md5: the hash ranges.
_PREFIX_DIGITS = 4


def sample_hash(key_cols: list[str], seed: int = 42) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    # several columns: each with its length, so that different rows have different keys
    key = parts[0] if len(parts) == 1 else F.concat_ws("|", *[
        x for p in parts for x in (F.length(p).cast("string"), p)])
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def sample_exact_n(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows chosen uniformly without replacement, deterministic.

    Rows of one hash range are ordered only in the range that the n-th row falls into, and there
    equal rows are counted, not listed: the order is over distinct hashes with their multiplicity.
    A key that holds a third of the table is one row of that order.
    """
    h = sample_hash(key_cols, seed)
    hashed = df.withColumn("_h", h)
    prefix = F.substring("_h", 1, _PREFIX_DIGITS)
    ranges = hashed.groupBy(prefix.alias("p")).agg(F.count("*").alias("rows"))
    upto = ranges.withColumn("upto", F.sum("rows").over(Window.orderBy("p")))  # at most 65,536 rows
    edge = upto.where(F.col("upto") >= n).orderBy("p").limit(1).collect()
    if not edge:
        return df
    p, missing = edge[0]["p"], n - (edge[0]["upto"] - edge[0]["rows"])
    inside = hashed.where(prefix == p)
    # hashes of the range with their counts, at most ``missing`` of them matter
    counts = inside.groupBy("_h").agg(F.count("*").alias("rows")).orderBy("_h").limit(missing)
    upto = counts.withColumn("upto", F.sum("rows").over(Window.orderBy("_h")))
    last = upto.where(F.col("upto") >= missing).orderBy("_h").limit(1).collect()
    cut, left = last[0]["_h"], missing - (last[0]["upto"] - last[0]["rows"])
    whole = hashed.where((prefix < p) | ((prefix == p) & (F.col("_h") < cut))).drop("_h")
    # rows of the hash at the edge: ``left`` of them, the same ones where the key is the whole row
    return whole.unionByName(inside.where(F.col("_h") == cut).drop("_h").limit(left))


def sample_children(children: dict[str, DataFrame], sampled: DataFrame,
                    key: str) -> dict[str, DataFrame]:
    """Each child ⋉ sampled parents on ``key``. The key set is bounded by the sample size."""
    keys = sampled.select(key).distinct()
    return {name: semi_join(df, keys, key) for name, df in children.items()}


def sample_by_keys(df: DataFrame, key_source: DataFrame, src_key: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs as ``src_key`` in ``key_source``."""
    keys = maybe_broadcast(key_source.select(F.col(src_key).alias(key)).distinct())
    return df.join(keys, key, "left_semi")
