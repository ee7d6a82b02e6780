"""Gradient-boosted regression trees, one ensemble per series.

A series has at most one row a day, so its trees are grown inside one task (histograms in numpy),
and thousands of series are fitted side by side by ``groupBy(series).applyInPandas``. An ensemble
is one row of flat node arrays: a node has a feature (-1: a leaf), a threshold, the place of its
left child (the right one follows it) and, as a leaf, a value. Scoring walks all trees of all rows
at once over these arrays.

Each tree is grown level by level on the gradient of the squared loss, on a random part of the rows
and features, with the regularized gain G^2 / (H + lambda) (Chen and Guestrin 2016). A feature has at
most 256 bins, so a series of up to 256 different values a feature is split exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.session import ship_package

# --- fixed values: tree-model settings, as in the source system ---
TREES = 800
STEP = 0.03
DEPTH = 6
SUBSAMPLE = 0.9
FEATURE_SHARE = 0.9
SEED = 42
# --- fixed values: regularization defaults of that kind of model ---
LAMBDA = 1.0
LEAST_WEIGHT = 1.0
BINS = 256
LEAST_GAIN = 1e-6

_INTS, _DOUBLES = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())
NODES = [T.StructField("base", T.DoubleType()), T.StructField("root", _INTS), T.StructField("feature", _INTS),
         T.StructField("threshold", _DOUBLES), T.StructField("child", _INTS), T.StructField("value", _DOUBLES)]
_SERIES = "_series"


@dataclass(frozen=True)
class Settings:
    trees: int = TREES
    step: float = STEP
    depth: int = DEPTH
    subsample: float = SUBSAMPLE
    feature_share: float = FEATURE_SHARE
    seed: int = SEED


class Ensemble:
    """Flat node arrays of all trees."""

    def __init__(self, base, root, feature, threshold, child, value):
        self.base = float(base)
        self.root, self.feature, self.child = (np.asarray(x, np.int64) for x in (root, feature, child))
        self.threshold, self.value = (np.asarray(x, np.float64) for x in (threshold, value))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows; all trees take a step down at a time."""
        at = np.broadcast_to(self.root, (len(x), len(self.root)))
        row = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.base + self.value[at].sum(1)
            right = x[row, np.maximum(feature, 0)] >= self.threshold[at]
            at = np.where(inner, self.child[at] + right, at)


def _binned(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each value, numbered over all features; first bin of each feature; thresholds above bins)."""
    codes, first, above = np.empty(x.shape, np.int64), [0], []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > BINS:
            values = np.unique(np.quantile(values, np.linspace(0, 1, BINS), method="lower"))
        cuts = (values[1:] + values[:-1]) / 2
        codes[:, f] = first[-1] + np.searchsorted(cuts, x[:, f], "right")
        above.append(np.append(cuts, np.inf))
        first.append(first[-1] + len(values))
    return codes, np.array(first), np.concatenate(above)


def fit(x: np.ndarray, y: np.ndarray, s: Settings, seed: int) -> Ensemble:
    """Boosted trees on all rows; the same rows, settings and seed give the same trees."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    codes, first, above = _binned(x)
    total = int(first[-1])
    of_bin = np.repeat(np.arange(width), np.diff(first))
    # the last bin of a feature can't be split off
    splits = np.ones(total, bool)
    splits[first[1:] - 1] = False
    base = float(y.mean())
    pred = np.full(n, base)
    root, feature, threshold, child, value = [], [], [], [], []
    chosen = max(1, int(width * s.feature_share))
    for _ in range(s.trees):
        weight = (rng.random(n) < s.subsample).astype(np.float64)
        usable = splits.copy()
        usable[~np.isin(of_bin, rng.permutation(width)[:chosen])] = False
        gradient = (y - pred) * weight
        root.append(len(feature))
        nodes = np.array([len(feature)])  # of this level
        _grow(1, feature, threshold, child, value)
        at, place = np.zeros(n, np.int64), np.full(n, root[-1])
        sums = np.array([gradient.sum()]), np.array([weight.sum()])
        alive = np.arange(n)  # rows whose node may be split
        for level in range(s.depth + 1):
            for k, node in enumerate(nodes.tolist()):
                value[node] = s.step * float(sums[0][k] / (sums[1][k] + LAMBDA))
            if level == s.depth or not len(alive):
                break
            key = (at[alive, None] * total + codes[alive]).ravel()
            size = len(nodes) * total
            g = np.bincount(key, np.repeat(gradient[alive], width), size).reshape(-1, total)
            h = np.bincount(key, np.repeat(weight[alive], width), size).reshape(-1, total)
            left_g, left_h = _before(g, first, of_bin), _before(h, first, of_bin)
            all_g, all_h = sums[0][:, None], sums[1][:, None]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = (left_g ** 2 / (left_h + LAMBDA) + right_g ** 2 / (right_h + LAMBDA)
                    - all_g ** 2 / (all_h + LAMBDA))
            gain[~(usable & (left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT))] = 0.0
            best = gain.argmax(1)
            split = gain[np.arange(len(nodes)), best] > LEAST_GAIN
            if not split.any():
                break
            new = len(feature) + 2 * np.cumsum(split) - 2
            _grow(2 * int(split.sum()), feature, threshold, child, value)
            for k in np.flatnonzero(split).tolist():
                node, b = int(nodes[k]), int(best[k])
                feature[node], threshold[node], child[node] = int(of_bin[b]), float(above[b]), int(new[k])
            alive = alive[split[at[alive]]]
            was = at[alive]
            right = codes[alive, of_bin[best[was]]] > best[was]
            place[alive] = new[was] + right
            order = 2 * (np.cumsum(split) - 1)
            at[alive] = order[was] + right
            k = np.flatnonzero(split)
            nodes = np.stack([new[k], new[k] + 1], 1).ravel()
            sums = (np.stack([left_g[k, best[k]], right_g[k, best[k]]], 1).ravel(),
                    np.stack([left_h[k, best[k]], right_h[k, best[k]]], 1).ravel())
        pred += np.array(value[root[-1]:])[place - root[-1]]
    return Ensemble(base, root, feature, threshold, child, value)


def _grow(k: int, feature: list, threshold: list, child: list, value: list) -> None:
    feature += [-1] * k
    threshold += [0.0] * k
    child += [-1] * k
    value += [0.0] * k


def _before(h: np.ndarray, first: np.ndarray, of_bin: np.ndarray) -> np.ndarray:
    """Sums over the bins of the same feature up to each bin."""
    up = np.cumsum(h, 1)
    start = np.concatenate([np.zeros((len(h), 1)), up], 1)[:, first[:-1]]
    return up - start[:, of_bin]


# ------------------------------------------------------------- Spark side


def series_name(keys: Sequence[str]) -> Column:
    """A non-null name of a series, so that a series with a NULL key is one like any other."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("all")


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in names]


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt by series over several tasks a core.

    A fixed number of partitions: series are small in bytes but dear in time, so they must not be
    put together by size.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, _SERIES)


def fit_series(train: DataFrame, features: Sequence[str], keys: Sequence[str] = (), y: str = "y",
               settings: Settings = Settings()) -> DataFrame:
    """One ensemble per series: (keys..., base, root, feature, threshold, child, value)."""
    ship_package(train.sparkSession)
    keys, features = list(keys), list(features)
    schema = T.StructType(_fields(train, keys) + NODES)

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        name = rows[_SERIES].iloc[0]
        rows = rows.sort_values("ds")  # the sample of a tree follows the order of rows
        e = fit(rows[features].to_numpy(np.float64), rows[y].to_numpy(np.float64), settings,
                settings.seed ^ zlib.crc32(name.encode()))
        out = {k: [rows[k].iloc[0]] for k in keys}
        out |= {"base": [e.base], "root": [e.root.tolist()], "feature": [e.feature.tolist()],
                "threshold": [e.threshold.tolist()], "child": [e.child.tolist()], "value": [e.value.tolist()]}
        return pd.DataFrame(out)

    rows = train.select(*keys, "ds", y, *features, series_name(keys).alias(_SERIES))
    rows = _spread(rows) if keys else rows
    return rows.groupBy(_SERIES).applyInPandas(task, schema)


def _ensemble(models: pd.DataFrame) -> Ensemble | None:
    if not len(models):
        return None
    m = models.iloc[0]
    return Ensemble(*(m[f.name] for f in NODES))


def _with_models(rows: DataFrame, models: DataFrame, keys: list[str], task, schema: T.StructType) -> DataFrame:
    """``task(rows of a series, its ensemble or none)`` for all series."""
    ship_package(rows.sparkSession)

    def both(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({f.name: [] for f in schema.fields})
        return task(left, _ensemble(right))

    left, right = (df.withColumn(_SERIES, series_name(keys)) for df in (rows, models))
    if keys:
        left, right = _spread(left), _spread(right)
    return left.groupBy(_SERIES).cogroup(right.groupBy(_SERIES)).applyInPandas(both, schema)


def score(models: DataFrame, rows: DataFrame, features: Sequence[str], keys: Sequence[str] = (),
          out: str = "yhat") -> DataFrame:
    """All columns of ``rows`` and the prediction of each series' own ensemble (NULL without one)."""
    features, keys = list(features), list(keys)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])

    def task(part: pd.DataFrame, e: Ensemble | None) -> pd.DataFrame:
        part = part.drop(columns=_SERIES)
        part[out] = None if e is None else e.predict(part[features].to_numpy(np.float64))
        return part

    return _with_models(rows, models, keys, task, schema)


def recursive(models: DataFrame, state: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Predict a day, put the prediction behind the history, go on: all days of a series in one task.

    ``state`` has a row per series: ``hist`` (last values, oldest first), ``fallback``, and
    ``days``: an array of structs of the date ``ds`` and the features known beforehand; the others
    are ``lag_k`` (k values back) and ``roll_k`` (the mean of the last k). A day whose features
    reach behind the history, or whose series has no ensemble, gets the fallback.
    """
    features, keys = list(features), list(keys)
    schema = T.StructType([*_fields(state, keys), T.StructField("ds", T.DateType()), T.StructField("yhat", T.DoubleType())])
    back = {c: int(c.split("_")[1]) for c in features if c.startswith(("lag_", "roll_"))}
    deepest = max(back.values(), default=0)

    def task(part: pd.DataFrame, e: Ensemble | None) -> pd.DataFrame:
        frames = []
        for _, row in part.iterrows():
            hist, days, yhat = [float(v) for v in row["hist"]], row["days"], []
            for day in days:
                value = row["fallback"]
                if e is not None and len(hist) >= deepest:
                    x = [hist[-back[c]] if c.startswith("lag_") else sum(hist[-back[c]:]) / back[c]
                         if c in back else day[c] for c in features]
                    value = float(e.predict(np.array([x], np.float64))[0])
                hist.append(value)
                yhat.append(value)
            frames.append(pd.DataFrame({k: [row[k]] * len(yhat) for k in keys}
                                       | {"ds": [d["ds"] for d in days], "yhat": yhat}))
        return pd.concat(frames)

    return _with_models(state, models, keys, task, schema)
