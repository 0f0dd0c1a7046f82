"""Extremely random trees.

All trees grow level by level. A level takes two passes over the rows, whatever the number
of trees: the first adds up, per tree and open node, the rows, the target and the range of
every feature; a threshold is then drawn for each candidate feature between its ends by a
hash of (seed, tree, node, feature); the second adds up rows and target left of each
threshold, which gives the gain in variance of every candidate. A partition holds numbers
by tree, node and feature only, partial sums meet map-side, and the driver sees numbers of
the model's own size. Every tree sees all rows; what differs are the draws.

Rows with a null or NaN in a feature or the target play no part in a fit and get no forecast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MASK = (1 << 64) - 1


def draw(seed: int, tree, node, feature, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) by hash, elementwise."""
    with np.errstate(over="ignore"):
        x = np.asarray(tree, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(node, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) \
            + np.asarray(feature, np.uint64) * np.uint64(0x165667B19E3779F9) + np.uint64((seed * 0x27D4EB2F165667C5 + salt * 0x85EBCA77C2B2AE63) & _MASK)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


@dataclass
class Forest:
    """Per tree and node (the children of node i are 2i + 1 and 2i + 2): the split's feature
    (-1 at a leaf), its threshold (``x <= threshold`` goes left) and the mean of the rows."""

    features: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def nodes(self, x: np.ndarray, tree: int, levels: int) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(levels):
            f = self.feature[tree, at]
            right = x[rows, np.maximum(f, 0)] > self.threshold[tree, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at

    def forecast(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        return np.mean([self.value[t, self.nodes(x, t, depth)] for t in range(len(self.feature))], axis=0)

    def predict(self, df: DataFrame, name: str = "pred") -> DataFrame:
        """``df`` with the mean of the trees' leaves."""
        forest, schema = self, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

        def score(batches):
            for pdf in batches:
                x = pdf[forest.features].to_numpy(float)
                ok = ~np.isnan(x).any(axis=1)
                out = np.full(len(x), np.nan)
                if ok.any():
                    out[ok] = forest.forecast(x[ok])
                yield pdf.assign(**{name: pd.array(out, "Float64")})

        return df.mapInPandas(score, schema).withColumn(name, F.when(~F.isnan(name), F.col(name)))


def candidates(low: np.ndarray, high: np.ndarray, tree, node, max_features: int, seed: int) -> np.ndarray:
    """Which features a node tries: ``max_features`` of those that vary in it, by smallest draw."""
    d = low.shape[1]
    order = draw(seed, np.asarray(tree)[:, None], np.asarray(node)[:, None], np.arange(d)[None, :], 1)
    order = np.where(high > low, order, 2.0)
    place = np.argsort(np.argsort(order, axis=1, kind="stable"), axis=1, kind="stable")
    return (place < max_features) & (high > low)


def thresholds(low, high, tree, node, seed: int) -> np.ndarray:
    d = low.shape[1]
    u = draw(seed, np.asarray(tree)[:, None], np.asarray(node)[:, None], np.arange(d)[None, :], 2)
    cut = low + u * (high - low)
    return np.where(cut < high, cut, low)                        # rounding must leave something on the right


def fit_extra_trees(df: DataFrame, features: list[str], label: str, trees: int = 100, depth: int = 8, max_features: int | None = None,
                    min_leaf: int = 3, seed: int = 42) -> Forest:
    """``trees`` trees of at most ``depth`` levels of splits. A split leaves ``min_leaf`` rows or
    more on both sides; of the tried features the largest gain wins (ties: the first)."""
    d = len(features)
    max_features = max_features or d
    size = 2 ** (depth + 1) - 1
    forest = Forest(list(features), np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size)))
    used = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate([*features, label])])

    def batches_of(it):
        for pdf in it:
            x = pdf.to_numpy(float)
            x = x[~np.isnan(x).any(axis=1)]
            if len(x):
                yield np.ascontiguousarray(x[:, :d]), x[:, d]

    def ranges(level: int, own: Forest, open_: np.ndarray):
        first, width = 2 ** level - 1, 2 ** level

        def partial(it):
            n, s = np.zeros((trees, width)), np.zeros((trees, width))
            low, high = np.full((trees, width, d), np.inf), np.full((trees, width, d), -np.inf)
            for x, y in batches_of(it):
                for t in range(trees):
                    at = own.nodes(x, t, level) - first
                    here = (at >= 0) & open_[t, np.maximum(at, 0)]
                    if not here.any():
                        continue
                    by = np.argsort(at[here], kind="stable")
                    k, xs = at[here][by], x[here][by]
                    edge = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
                    g = k[edge]
                    n[t] += np.bincount(k, minlength=width)
                    s[t] += np.bincount(k, y[here][by], minlength=width)
                    low[t, g] = np.minimum(low[t, g], np.minimum.reduceat(xs, edge))
                    high[t, g] = np.maximum(high[t, g], np.maximum.reduceat(xs, edge))
            t, g = np.nonzero(n)
            yield pd.DataFrame({"t": np.repeat(t, d), "g": np.repeat(g, d), "f": np.tile(np.arange(d), len(t)), "n": np.repeat(n[t, g], d),
                                "s": np.repeat(s[t, g], d), "lo": low[t, g].ravel(), "hi": high[t, g].ravel()})

        got = used.mapInPandas(partial, "t int, g int, f int, n double, s double, lo double, hi double").groupBy("t", "g", "f") \
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toPandas()
        return got.sort_values(["t", "g", "f"])

    def lefts(level: int, own: Forest, cut: np.ndarray):
        """``cut``: threshold by tree, node and feature (NaN: not tried)."""
        first, width = 2 ** level - 1, 2 ** level

        def partial(it):
            n, s = np.zeros((trees, width, d)), np.zeros((trees, width, d))
            for x, y in batches_of(it):
                for t in range(trees):
                    at = own.nodes(x, t, level) - first
                    here = at >= 0
                    k, xs, ys = at[here], x[here], y[here]
                    left = xs <= cut[t, k]                        # NaN compares false
                    for f in range(d):
                        m = left[:, f]
                        n[t, :, f] += np.bincount(k[m], minlength=width)
                        s[t, :, f] += np.bincount(k[m], ys[m], minlength=width)
            t, g, f = np.nonzero(n)
            yield pd.DataFrame({"t": t, "g": g, "f": f, "n": n[t, g, f], "s": s[t, g, f]})

        return used.mapInPandas(partial, "t int, g int, f int, n double, s double").groupBy("t", "g", "f") \
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()

    open_ = np.ones((trees, 1), bool)
    for level in range(depth + 1):
        first, width = 2 ** level - 1, 2 ** level
        got = ranges(level, forest, open_)
        if got.empty:
            break
        t, g = (got[c].to_numpy().reshape(-1, d)[:, 0] for c in ("t", "g"))
        n, s = (got[c].to_numpy().reshape(-1, d)[:, 0] for c in ("n", "s"))
        low, high = (got[c].to_numpy().reshape(-1, d) for c in ("lo", "hi"))
        forest.value[t, first + g] = s / n
        tried = candidates(low, high, t, first + g, max_features, seed) & (n >= 2 * min_leaf)[:, None]
        if level == depth or not tried.any():
            break
        cut = np.full((trees, width, d), np.nan)
        cut[t, g] = np.where(tried, thresholds(low, high, t, first + g, seed), np.nan)
        part = lefts(level, forest, cut)
        nl, sl = np.zeros((trees, width, d)), np.zeros((trees, width, d))
        nl[part["t"], part["g"], part["f"]], sl[part["t"], part["g"], part["f"]] = part["n"], part["s"]
        nl, sl = nl[t, g], sl[t, g]
        nr, sr = n[:, None] - nl, s[:, None] - sl
        fits = tried & (nl >= min_leaf) & (nr >= min_leaf)
        gain = np.where(fits, np.divide(sl * sl, nl, out=np.zeros_like(sl), where=nl > 0) + np.divide(sr * sr, nr, out=np.zeros_like(sr), where=nr > 0)
                        - (s * s / n)[:, None], -np.inf)
        best = gain.argmax(axis=1)
        split = gain[np.arange(len(t)), best] > 1e-12 * np.maximum(1.0, s * s / n)
        forest.feature[t[split], first + g[split]] = best[split]
        forest.threshold[t[split], first + g[split]] = cut[t, g][np.arange(len(t)), best][split]
        open_ = np.zeros((trees, 2 * width), bool)
        for side in (0, 1):
            open_[t[split], 2 * g[split] + side] = True
    return forest
