"""Seasonal regression with a piecewise-linear trend, one closed-form fit per series.

The terms of a day are its place u in the training span (0 to 1), a hinge max(0, u - c) for each
change point c, Fourier terms of the year and the week, and u times each Fourier term (seasonality
that grows with the trend; Taylor and Letham 2018). One ``groupBy`` sums the products of all pairs
of (1, terms, y): these Gram sums are all that a least-squares fit needs, a few hundred numbers a
series whatever its length, and they combine map-side. The ridge solution of each series is then
solved from its sums, in standardized terms with one penalty for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.boosting import series_name
from martwright.operators.features import time_split
from martwright.session import ship_package

# --- fixed values: seasonal regression settings ---
YEARLY_PERIOD = 365.25
WEEKLY_PERIOD = 7.0
YEARLY_ORDER = 2
WEEKLY_ORDER = 3
CHANGE_POINTS = 10
CHANGE_RANGE = 0.8  # change points lie in this first part of the training span
PENALTY = 0.08  # of squared standardized coefficients, against the mean squared error in variances of y


def terms(ds: str = "ds", origin: str = "origin", span: str = "span", points: int = CHANGE_POINTS) -> list[Column]:
    """The terms of a day: trend, hinges, Fourier terms, trend times Fourier terms."""
    days = F.datediff(F.col(ds), F.col(origin)).cast("double")
    u = days / F.col(span).cast("double")
    hinges = [F.greatest(F.lit(0.0), u - F.lit(CHANGE_RANGE * j / (points + 1))) for j in range(1, points + 1)]
    fourier = []
    for period, order in ((YEARLY_PERIOD, YEARLY_ORDER), (WEEKLY_PERIOD, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = days * F.lit(2.0 * math.pi * k / period)
            fourier += [F.sin(angle), F.cos(angle)]
    return [u, *hinges, *fourier, *[u * f for f in fourier]]


def frame(daily: DataFrame, test_days: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., ds, y, split, origin, span): all raw rows, with the first training day and the span."""
    keys = list(keys)
    split = time_split(daily.select(*keys, "ds", "y"), test_days, keys)
    train = F.when(F.col("split") == "train", F.col("ds"))
    series = Window.partitionBy(*keys)
    return split.withColumn("origin", F.min(train).over(series)).withColumn(
        "span", F.greatest(F.datediff(F.max(train).over(series), F.col("origin")), F.lit(1)))


def gram_sums(rows: DataFrame, keys: Sequence[str] = (), points: int = CHANGE_POINTS) -> DataFrame:
    """(keys..., origin, span, i, j, total): sums over rows of v_i v_j, v = (1, terms, y), i <= j."""
    v = F.array(F.lit(1.0), *terms(points=points), F.col("y").cast("double"))
    pairs = F.flatten(F.transform("v", lambda a, i: F.transform(
        F.slice("v", i + 1, F.size("v") - i),
        lambda b, j: F.struct(i.alias("i"), (i + j).alias("j"), (a * b).alias("product")))))
    each = rows.select(*keys, "origin", "span", v.alias("v")).select(*keys, "origin", "span", F.inline(pairs))
    return each.groupBy(*keys, "origin", "span", "i", "j").agg(F.sum("product").alias("total"))


def solve(gram: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) of the ridge regression from the sums of products."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    cov = gram[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 0.0))
    flat = scale <= 1e-9 * (1.0 + np.abs(mean))
    scale[flat] = 1.0
    cov[flat], cov[:, flat] = 0.0, 0.0
    corr = cov / np.outer(scale, scale)
    p = len(mean) - 1
    if flat[p]:  # y is constant
        return float(mean[p]), np.zeros(p)
    b, *_ = np.linalg.lstsq(corr[:p, :p] + penalty * np.eye(p), corr[:p, p], rcond=None)
    coef = b * scale[p] / scale[:p]
    coef[flat[:p]] = 0.0
    return float(mean[p] - coef @ mean[:p]), coef


def fit(rows: DataFrame, keys: Sequence[str] = (), penalty: float = PENALTY, points: int = CHANGE_POINTS) -> DataFrame:
    """One model per series from its training rows: (keys..., origin, span, intercept, coef)."""
    ship_package(rows.sparkSession)
    keys = list(keys)
    sums = gram_sums(rows.where("split = 'train' AND y IS NOT NULL"), keys, points)
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("origin", T.DateType()),
                           T.StructField("span", T.IntegerType()), T.StructField("intercept", T.DoubleType()),
                           T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def task(part: pd.DataFrame) -> pd.DataFrame:
        size = int(part["j"].max()) + 1
        gram = np.zeros((size, size))
        i, j = part["i"].to_numpy(), part["j"].to_numpy()
        gram[i, j] = gram[j, i] = part["total"].to_numpy()
        intercept, coef = solve(gram, penalty)
        head = {k: [part[k].iloc[0]] for k in [*keys, "origin", "span"]}
        return pd.DataFrame(head | {"intercept": [intercept], "coef": [coef.tolist()]})

    return sums.withColumn("_series", series_name(keys)).groupBy("_series").applyInPandas(task, schema)


def score(models: DataFrame, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``rows`` (keys..., ds, ...) and ``yhat`` by each series' own model (NULL without one)."""
    keys = list(keys)
    name = series_name(keys).alias("_series")
    points = F.size("coef") - 1 - 4 * (YEARLY_ORDER + WEEKLY_ORDER)
    held = models.select(name, F.col("origin").alias("_origin"), F.col("span").alias("_span"),
                         F.col("intercept").alias("_intercept"), F.col("coef").alias("_coef"))
    n = models.select(F.max(points)).first()[0]  # the same for all models of a fit
    if n is None:
        return rows.withColumn("yhat", F.lit(None).cast("double"))
    x = F.array(*terms(origin="_origin", span="_span", points=n))
    dot = F.aggregate(F.zip_with(x, "_coef", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return (rows.withColumn("_series", series_name(keys)).join(held, "_series", "left")
            .withColumn("yhat", F.col("_intercept") + dot)
            .drop("_series", "_origin", "_span", "_intercept", "_coef"))
