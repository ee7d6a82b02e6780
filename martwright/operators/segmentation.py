"""RFM customer features, z-scaling, KMeans segments and segment profiles.

RFM is a ``groupBy(customer)``: an exact ``count(DISTINCT order_id)`` plans
as a two-level aggregate keyed first on ``(customer, order)``, so one
customer holding a third of all rows still spreads over many tasks. The
as-of date and the scaling statistics are scalar subqueries (one tiny job
each), not cross joins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import checkpoint

RFM_COLUMNS = ["recency", "frequency", "monetary"]


def rfm(items: DataFrame, as_of: dt.date | str | None = None,
        customer: str = "customer_unique_id", materialise=None) -> DataFrame:
    """recency (days from last purchase to as-of), frequency (distinct orders), monetary (Σ gmv).

    ``as_of`` defaults to the latest purchase date of the whole input + 1 day;
    NULL customers then drop out; an all-NULL spend is 0.0. The default as-of is a scalar
    subquery over the per-customer aggregate; ``materialise`` (e.g.
    ``session.checkpoint``) stores that aggregate first so the subquery and
    the final projection both read the small per-customer table instead of
    running the item joins twice.
    """
    # The NULL customer forms its own group here: it still counts for the
    # default as-of date (the latest purchase of the whole input) and is
    # dropped from the output below.
    g = items.groupBy(customer).agg(
        F.max("order_purchase_date").alias("_last"),
        F.count_distinct("order_id").alias("frequency"),
        F.coalesce(F.sum("item_gmv"), F.lit(0.0)).alias("monetary"))
    if materialise is not None:
        g = materialise(g)
    if as_of is None:
        # Latest purchase = max of the per-customer last purchases.
        as_of_col: Column = F.date_add(g.select(F.max("_last")).scalar(), 1)
    else:
        as_of_col = F.lit(as_of).cast("date")
    return g.where(F.col(customer).isNotNull()).select(
        customer, F.datediff(as_of_col, F.col("_last")).cast("bigint").alias("recency"),
        "frequency", "monetary")


def scaling_stats(scored: DataFrame, cols: list[str] = RFM_COLUMNS) -> DataFrame:
    """One row: mean and population std of each RFM column (the fitted scaler)."""
    return scored.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols],
                      *[F.stddev_pop(c).alias(f"{c}_std") for c in cols])


def rfm_scale(scored: DataFrame, cols: list[str] = RFM_COLUMNS,
              stats: DataFrame | None = None) -> DataFrame:
    """Adds ``<c>_z`` = (c − mean) / population std; a zero-variance column scales to 0.

    ``stats`` (from ``scaling_stats``, e.g. a stored scaler) scales new customers
    with the statistics of the training population.
    """
    stats = scaling_stats(scored, cols) if stats is None else stats
    # one scalar with all statistics: the scored rows are aggregated once
    s = stats.select(F.struct("*").alias("s")).scalar()
    return scored.withColumns({
        f"{c}_z": F.when(s[f"{c}_std"] > 0, (F.col(c) - s[f"{c}_mean"]) / s[f"{c}_std"])
        .otherwise(F.lit(0.0)) for c in cols})


# Points are whole millionths of z-scores: their sums are exact in any order, so every engine that
# takes the same steps gets the same centres and labels.
UNIT = 1_000_000
START_ROWS = 1024  # customers among which the first centres are chosen


def _units(c: str) -> Column:
    return F.floor(F.col(f"{c}_z") * F.lit(float(UNIT)) + F.lit(0.5)).cast("bigint").alias(c)


def _distance(centre: Sequence[float], cols: list[str]) -> Column:
    out = None
    for c, x in zip(cols, centre, strict=True):
        d = F.col(c).cast("double") - F.lit(float(x))
        out = d * d if out is None else out + d * d
    return out


def _nearest(centres: list[list[float]], cols: list[str]) -> Column:
    """Number of the nearest centre; of equally near ones the first."""
    return F.least(*[F.struct(_distance(x, cols).alias("d"), F.lit(k).alias("k"))
                     for k, x in enumerate(centres)])["k"]


def start_centres(points: DataFrame, k: int, seed: int, customer: str, cols: list[str]) -> list[list[float]]:
    """Farthest-first centres among the ``START_ROWS`` customers whose md5 is least.

    The first one is the least md5 itself; each next one is the customer farthest from the nearest
    centre so far (the least md5 of equally far ones). The sample is of a fixed, documented size;
    all customers take part in the steps that follow.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(customer).cast("string")))
    sample = checkpoint(points.select(*cols, customer, h.alias("_h")).orderBy("_h", customer).limit(START_ROWS))
    centres: list[list[float]] = []
    for _ in range(k):
        far = F.least(*[_distance(x, cols) for x in centres], F.lit(float("inf"))) if centres else F.lit(0.0)
        row = sample.orderBy(far.desc(), "_h", customer).select(*cols).first()
        if row is None:
            return []
        centres.append([float(row[c]) for c in cols])
    return centres


def fit_kmeans(scaled: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 300,
               cols: list[str] = RFM_COLUMNS, customer: str = "customer_unique_id") -> DataFrame:
    """KMeans centres of the z-scaled RFM columns: (cluster, <column> in millionths).

    Lloyd's steps until no centre moves. A step is one aggregation over all customers; k rows come
    back. A centre that loses all its customers stays where it is.
    """
    points = checkpoint(scaled.select(customer, *[_units(c) for c in cols]))
    centres = start_centres(points, k, seed, customer, cols)
    for _ in range(max_iter if centres else 0):
        sums = points.groupBy(_nearest(centres, cols).alias("k")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in cols]).collect()
        moved = list(centres)
        for r in sums:
            moved[r["k"]] = [float(r[c]) / r["n"] for c in cols]
        if moved == centres:
            break
        centres = moved
    schema = "cluster int, " + ", ".join(f"{c} double" for c in cols)
    return scaled.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(centres)], schema)


def predict_cluster(centres: DataFrame, scaled: DataFrame, cols: list[str] = RFM_COLUMNS) -> DataFrame:
    """``scaled`` with ``_cluster``, the number of the nearest centre (k rows are read)."""
    found = [[r[c] for c in cols] for r in centres.orderBy("cluster").collect()]
    held = scaled.withColumn("_p", F.struct(*[_units(c) for c in cols]))
    if not found:
        return held.withColumn("_cluster", F.lit(None).cast("int")).drop("_p")
    near = F.least(*[F.struct(_distance(x, [f"_p.{c}" for c in cols]).alias("d"), F.lit(k).alias("k"))
                     for k, x in enumerate(found)])["k"]
    return held.withColumn("_cluster", near).drop("_p")


def assign_segments(model: DataFrame, scaled: DataFrame,
                    customer: str = "customer_unique_id") -> DataFrame:
    """Cluster label per customer, renumbered by mean monetary (0 = highest) so ids are stable.

    The renumbering table has one row per cluster (k rows), so it is broadcast.
    """
    pred = predict_cluster(model, scaled)
    order = (pred.groupBy("_cluster").agg(F.avg("monetary").alias("_m"))
             .select("_cluster", F.row_number().over(
                 Window.orderBy(F.col("_m").desc(), F.col("_cluster"))).alias("_rank")))
    return (pred.join(F.broadcast(order), "_cluster", "left")
            .select(customer, *RFM_COLUMNS, (F.col("_rank") - 1).cast("int").alias("segment")))


def segment_customers(items: DataFrame, k: int = 4, seed: int = 42,
                      as_of: dt.date | str | None = None):
    """RFM → scale → KMeans → labelled customers. Returns (centres, scored DataFrame).

    The per-customer aggregate is checkpointed (written to the shared
    checkpoint folder) first: the as-of subquery, KMeans' passes and
    the labelling all read it, and none of them re-runs the item joins.
    """
    r = rfm(items, as_of, materialise=checkpoint)
    scaled = checkpoint(rfm_scale(r))
    model = fit_kmeans(scaled, k=k, seed=seed)
    return model, assign_segments(model, scaled)


def segment_profile(scored: DataFrame) -> DataFrame:
    """Mean recency / frequency / monetary per segment, highest monetary first."""
    return (scored.groupBy("segment")
            .agg(*[F.avg(c).alias(c) for c in RFM_COLUMNS], F.count(F.lit(1)).alias("customers"))
            .orderBy(F.col("monetary").desc()))
