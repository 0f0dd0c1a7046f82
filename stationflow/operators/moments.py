"""Least squares and feature selection from mergeable moments (SURVEY M12-M14,
M22, M23, M25, M26, M40, X1, X16-X19, X21, X22).

A moment is ``(n, mean, comoment)`` of a few columns: the weight, the means and the
matrix of centred cross products. Two moments of disjoint rows merge exactly, so each
partition reduces its rows to one moment per key and only those travel. Whatever a linear
model or a correlation needs comes from them: fits for any subset of the columns, any
ridge penalty and any standardisation, and the squared error on other rows. Rows are
read once however many folds, subsets and penalties are tried.

Expanding folds share work too: all cut positions of the (nested) folds split the rows into
blocks, a train set is a merge of the first blocks, a test set a merge of a range.

Rows with a null or NaN in any of the columns play no part; a model without rows predicts
zero; a column without variance gets no weight.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..util import cut_lineage
from .splits import global_position

MOMENT = "n double, mean array<double>, comoment array<double>"
FLUSH_KEYS = 4096       # keys a partition holds before it sends them on
MERGE_FAN = 64          # partial moments of a key meet in this many groups before the last merge


@dataclass
class Moment:
    """Weight, means and centred cross products of the columns ``names``."""

    n: float
    mean: np.ndarray
    comoment: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Moment:
        return cls(0.0, np.zeros(d), np.zeros((d, d)))

    @classmethod
    def of(cls, x: np.ndarray, weight: np.ndarray | None = None) -> Moment:
        if not len(x):
            return cls.empty(x.shape[1])
        w = np.ones(len(x)) if weight is None else weight
        n = float(w.sum())
        if n == 0:
            return cls.empty(x.shape[1])
        mean = w @ x / n
        z = x - mean
        return cls(n, mean, (z * w[:, None]).T @ z)

    @classmethod
    def read(cls, row) -> Moment:
        mean = np.asarray(row["mean"], float)
        return cls(float(row["n"]), mean, np.asarray(row["comoment"], float).reshape(len(mean), len(mean)))

    def merge(self, other: Moment) -> Moment:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moment(n, self.mean + gap * (other.n / n), self.comoment + other.comoment + np.outer(gap, gap) * (self.n * other.n / n))

    def std(self) -> np.ndarray:
        """Standard deviations (ddof 0); one where there is no variance."""
        v = np.clip(np.diag(self.comoment), 0, None) / max(self.n, 1e-300)
        return np.where(v > 1e-24 * np.maximum(self.mean ** 2, 1e-300), np.sqrt(v), 1.0)

    def correlations(self, target: int) -> np.ndarray:
        """Pearson correlation of every column with one; zero without variance."""
        s = np.sqrt(np.clip(np.diag(self.comoment), 0, None))
        return np.divide(self.comoment[:, target], s * s[target], out=np.zeros(len(s)), where=s * s[target] > 0)

    def row(self) -> list:
        return [self.n, self.mean.tolist(), self.comoment.ravel().tolist()]


def merged(moments, d: int) -> Moment:
    out = Moment.empty(d)
    for m in moments:
        out = out.merge(m)
    return out


@dataclass
class LinearFit:
    """Intercept and coefficients of the raw columns ``at`` (positions in a moment)."""

    at: list[int]
    coef: np.ndarray
    intercept: float
    scaled: np.ndarray = field(default_factory=lambda: np.zeros(0))       # coefficients of the standardised columns

    def full(self, d: int) -> np.ndarray:
        out = np.zeros(d)
        out[self.at] = self.coef
        return out

    def sums(self, m: Moment, target: int) -> tuple[float, float, float, float, float]:
        """``(sse, mean of prediction, its centred square sum, cross with y, y's)`` on other rows."""
        c = self.coef
        x = m.comoment[np.ix_(self.at, self.at)]
        cross = float(c @ m.comoment[self.at, target])
        pp, yy = float(c @ x @ c), float(m.comoment[target, target])
        pred = self.intercept + float(c @ m.mean[self.at])
        gap = float(m.mean[target]) - pred
        return yy - 2 * cross + pp + m.n * gap * gap, pred, pp, cross, yy

    def r2(self, m: Moment, target: int, zero_variance: float = 0.0) -> float:
        sse, _, _, _, yy = self.sums(m, target)
        return 1.0 - sse / yy if yy > 0 else zero_variance

    def rmse(self, m: Moment, target: int) -> float:
        return float(np.sqrt(max(self.sums(m, target)[0], 0.0) / m.n)) if m.n else float("nan")


def solve(m: Moment, at: list[int], target: int, alpha: float = 0.0, scale: np.ndarray | None = None) -> LinearFit:
    """Least squares (``alpha`` 0) or ridge of column ``target`` on the columns ``at``: columns
    are divided by ``scale`` (default: their own standard deviation), ``alpha`` is added to the
    diagonal of the centred Gram matrix, the intercept is not penalised."""
    at = list(at)
    s = (m.std() if scale is None else scale)[at]
    if not m.n or not at:
        return LinearFit(at, np.zeros(len(at)), float(m.mean[target]) if m.n else 0.0, np.zeros(len(at)))
    gram = m.comoment[np.ix_(at, at)] / np.outer(s, s)
    rhs = m.comoment[at, target] / s
    w = np.linalg.solve(gram + alpha * np.eye(len(at)), rhs) if alpha > 0 else np.linalg.lstsq(gram, rhs, rcond=1e-12)[0]
    coef = w / s
    return LinearFit(at, coef, float(m.mean[target] - coef @ m.mean[at]), w)


# moments of a table --------------------------------------------------------------------
def moments(df: DataFrame, cols: list[str], keys: list[str] = (), weight: str | None = None) -> DataFrame:
    """One row per ``keys`` (a null key is a key): ``n, mean, comoment`` of ``cols``."""
    keys = list(keys)
    d = len(cols)
    used = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(cols)],
                     *([F.col(weight).cast("double").alias("_w")] if weight else []))
    types = {f.name: f.dataType.simpleString() for f in used.schema.fields}
    head = "".join(f"`{k}` {types[k]}, " for k in keys)

    def rows_of(state: dict):
        frame = pd.DataFrame([[*k, *m.row()] for k, m in state.items()], columns=[*keys, "n", "mean", "comoment"])
        return frame

    def partial(batches):
        state: dict = {}
        for pdf in batches:
            x = pdf[[f"_x{i}" for i in range(d)]].to_numpy(float)
            w = pdf["_w"].to_numpy(float) if weight else None
            ok = ~np.isnan(x).any(axis=1)
            if w is not None:
                ok &= ~np.isnan(w)
            if keys:
                names = pdf[keys].astype(object).where(pdf[keys].notna(), None)
                groups = names[ok].groupby(keys, dropna=False, sort=False).indices if ok.any() else {}
                here = np.flatnonzero(ok)
                for k, at in groups.items():
                    k = k if isinstance(k, tuple) else (k,)
                    k = tuple(None if pd.isna(v) else v for v in k)
                    rows = here[at]
                    m = Moment.of(x[rows], None if w is None else w[rows])
                    state[k] = state[k].merge(m) if k in state else m
            else:
                m = Moment.of(x[ok], None if w is None else w[ok])
                state[()] = state[()].merge(m) if () in state else m
            if len(state) > FLUSH_KEYS:
                yield rows_of(state)
                state = {}
        if state:
            yield rows_of(state)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        m = merged((Moment.read(r) for r in pdf.to_dict("records")), d)
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), *m.row()]], columns=[*keys, "n", "mean", "comoment"])

    def merge_some(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return merge(pdf)

    parts = used.mapInPandas(partial, head + MOMENT).withColumn("_part", F.spark_partition_id() % MERGE_FAN)
    some = parts.groupBy(*keys, "_part").applyInPandas(merge_some, head + MOMENT)
    return some.groupBy(*keys).applyInPandas(merge_some, head + MOMENT)


def read_moments(df: DataFrame, keys: list[str] = ()) -> dict:
    """The moments of few keys (folds, blocks: never stations) on the driver."""
    return {tuple(r[k] for k in keys): Moment.read(r) for r in df.collect()}


# M12 / M13 / M26 -----------------------------------------------------------------------
def least_squares(df: DataFrame, features: list[str], label: str, alpha: float = 0.0, keys: list[str] = (),
                  weight: str | None = None) -> DataFrame:
    """One model per ``keys``: ``n, intercept, coef`` (array in the order of ``features``).
    ``alpha`` > 0 is the standardised ridge with unpenalised intercept. The moments of each
    key are solved where they are; rows of a key are never brought together."""
    keys = list(keys)
    m = moments(df, [*features, label], keys, weight)
    types = {f.name: f.dataType.simpleString() for f in m.schema.fields}
    d = len(features)

    def fit(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                own = Moment.read(r)
                f = solve(own, list(range(d)), d, alpha)
                out.append([*(r[k] for k in keys), own.n, f.intercept, f.coef.tolist()])
            yield pd.DataFrame(out, columns=[*keys, "n", "intercept", "coef"])

    return m.mapInPandas(fit, "".join(f"`{k}` {types[k]}, " for k in keys) + "n double, intercept double, coef array<double>")


def linear_prediction(df: DataFrame, models: DataFrame, features: list[str], keys: list[str] = (), name: str = "pred") -> DataFrame:
    """``df`` with the prediction of its key's model (null where a feature is null)."""
    own = models.select(*keys, F.col("intercept").alias("_b0"), F.col("coef").alias("_b"))
    if keys:
        out = df.join(own, list(keys))
    else:
        r = own.first()
        out = df.withColumns({"_b0": F.lit(r["_b0"]), "_b": F.array(*[F.lit(float(c)) for c in r["_b"]])})
    total = F.col("_b0")
    for i, c in enumerate(features):
        total = total + F.col("_b")[i] * F.col(f"`{c}`").cast("double")
    return out.withColumn(name, total).drop("_b0", "_b")


def _station_blocks(k: int):
    """Train and test blocks of the expanding folds over blocks 0..k of a station's train rows
    (block 0 also holds the remainder)."""
    return [(list(range(j + 1)), j + 1) for j in range(k)]


def group_search(df: DataFrame, group: str, time_col: str, split_col: str, features: list[str], label: str, alphas: list[float],
                 k: int = 3) -> DataFrame:
    """The same ridge, grid and folds for every group apart and for all groups pooled.

    ``split_col`` says train, valid or test. The grid's penalty with the best mean R2 over ``k``
    expanding folds of the train rows is refitted on them. Pooled, a group is a one-hot column
    as well. One pass over the rows gives a moment per (group, block); the pooled model's
    one-hot block is diagonal, so it is eliminated group by group and only a matrix of the
    features' size is left to solve. Returns ``group, scope (individual or pooled), alpha,
    split, n, r2, rmse`` and, pooled over all groups, rows with a null group."""
    d = len(features)
    at = list(range(d))
    rows = time_blocks(df.filter(F.col(split_col) == "train"), group, time_col, k) \
        .unionByName(df.filter(F.col(split_col) != "train").withColumn("_block", F.when(F.col(split_col) == "valid", F.lit(k + 1)).otherwise(F.lit(k + 2))))
    cells = cut_lineage(moments(rows, [*features, label], [group, "_block"]))
    gtype = cells.schema[group].dataType.simpleString()
    out_schema = f"`{group}` {gtype}, scope string, alpha double, split string, n double, r2 double, rmse double"
    splits = (("train", list(range(k + 1))), ("valid", [k + 1]), ("test", [k + 2]))

    def blocks_of(pdf: pd.DataFrame) -> dict[int, Moment]:
        return {int(r["_block"]): Moment.read(r) for r in pdf.to_dict("records")}

    def pick(by: dict[int, Moment], which) -> Moment:
        return merged((by[b] for b in which if b in by), d + 1)

    def own_model(key, pdf: pd.DataFrame) -> pd.DataFrame:
        by = blocks_of(pdf)
        folds = [(pick(by, train), pick(by, [test])) for train, test in _station_blocks(k)]
        folds = [(a, b) for a, b in folds if a.n and b.n]
        score = [np.mean([solve(a, at, d, alpha).r2(b, d) for a, b in folds]) if folds else 0.0 for alpha in alphas]
        alpha = alphas[int(np.argmax(score))]
        f = solve(pick(by, range(k + 1)), at, d, alpha)
        out = []
        for name, which in splits:
            m = pick(by, which)
            out.append([key[0], "individual", alpha, name, m.n, f.r2(m, d) if m.n else None, f.rmse(m, d) if m.n else None])
        return pd.DataFrame(out, columns=[group, "scope", "alpha", "split", "n", "r2", "rmse"])

    individual = cells.groupBy(group).applyInPandas(own_model, out_schema)

    # pooled: a set of train blocks and a penalty make a model
    train_sets = [tuple(t) for t, _ in _station_blocks(k)] + [tuple(range(k + 1))]
    pooled = PooledRidge(cells, group, d, train_sets)
    models = pooled.fits([(t, a) for t in train_sets for a in alphas])
    tested = pooled.errors([(t, a, [b], models[t, a]) for t, b in zip(train_sets, [b for _, b in _station_blocks(k)]) for a in alphas])
    mean_r2 = {a: np.mean([r2 for (_, b, _), (_, r2, _) in tested.items() if b == a]) for a in alphas}
    alpha = max(alphas, key=lambda a: (mean_r2[a], -alphas.index(a)))
    final = train_sets[-1]
    rows_of = pooled.group_errors(models[final, alpha], final, alpha, splits, out_schema, "pooled")
    total = pooled.errors([(final, alpha, which, models[final, alpha]) for _, which in splits])
    spark = df.sparkSession
    overall = spark.createDataFrame([(None, "pooled", float(alpha), name, *map(float, total[final, alpha, tuple(which)]))
                                     for name, which in splits], out_schema)
    return individual.unionByName(rows_of).unionByName(overall)


def time_blocks(df: DataFrame, group: str, time_col: str, k: int) -> DataFrame:
    """``_block`` of each row in its group's time order: test fold ``j`` of ``k`` expanding folds is
    block ``j + 1``, what is before the first test fold is block 0."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    x = group_position(df, group, time_col).join(n, group)
    size = F.floor(F.col("_n") / (k + 1))
    first = F.col("_n") - k * size
    return x.withColumn("_block", F.when((size == 0) | (F.col("_pos") < first), F.lit(0))
                        .otherwise(F.floor(F.try_divide(F.col("_pos") - first, size)) + 1).cast("int")).drop("_pos", "_n")


def group_position(df: DataFrame, group: str, time_col: str) -> DataFrame:
    """0-based position ``_pos`` of a row in its group's time order, day by day with the days'
    counts beside it, so a group of any length is spread over tasks."""
    day = F.to_date(time_col).alias("_day")
    counts = df.groupBy(group, day).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(group).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    inner = Window.partitionBy(group, "_day").orderBy(time_col)
    return df.withColumn("_day", F.to_date(time_col)).join(counts, [group, "_day"]) \
        .withColumn("_pos", F.col("_before") + F.row_number().over(inner) - 1).drop("_day", "_before")


def _penalty(m: Moment, total: float, alpha: float) -> float:
    """Of a group's offset; infinite where its one-hot column is constant."""
    p = m.n / total if total else 0.0
    return alpha * p * (1 - p) if 0 < p < 1 else float("inf")


def _offset(m: Moment, model, total: float, alpha: float) -> float:
    coef, intercept = model
    pull = _penalty(m, total, alpha)
    return m.n * float(m.mean[-1] - intercept - coef @ m.mean[:-1]) / (m.n + pull) if np.isfinite(pull) else 0.0


class PooledRidge:
    """Ridge on standardised features and standardised one-hot columns of a group, from the
    moments of each (group, block).

    With ``p`` the group's share of the rows, its one-hot column has standard deviation
    ``sqrt(p (1 - p))``. Centring makes the one-hot block of the Gram matrix diagonal minus a
    rank-one part that only moves the (free) intercept, so the model is solved as: group
    offsets with penalty ``alpha p (1 - p)`` on each and a free intercept. Offsets are
    eliminated: what a group adds to the features' matrix is a matrix of that size. A group
    that the train rows lack (or that is alone in them) has no offset."""

    def __init__(self, cells: DataFrame, group: str, d: int, train_sets: list[tuple[int, ...]]):
        self.cells, self.group, self.d = cells, group, d
        self.totals: dict[tuple, Moment] = {}
        by = read_moments(moments_union(cells, ["_block"], d + 1), ["_block"])
        for t in train_sets:
            self.totals[t] = merged((by[b,] for b in t if (b,) in by), d + 1)

    def fits(self, wanted: list[tuple[tuple[int, ...], float]]) -> dict:
        """``(coef, intercept)`` for every (train blocks, alpha), in one pass over the moments."""
        d, group = self.d, self.group
        spec = [(set(t), self.totals[t].n, self.totals[t].mean, a) for t, a in wanted]

        def reduce(batches):
            # second moments of (1, features, y) about the overall means less what the offset takes up
            own: dict = {}
            for pdf in batches:
                for r in pdf.to_dict("records"):
                    own.setdefault(r[group], {})[int(r["_block"])] = Moment.read(r)
            for i, (train, total, centre, alpha) in enumerate(spec):
                acc = np.zeros((d + 2, d + 2))
                for by in own.values():
                    m = merged((by[b] for b in train if b in by), d + 1)
                    v = np.concatenate([[1.0], m.mean - centre])
                    raw = m.n * np.outer(v, v)
                    raw[1:, 1:] += m.comoment
                    pull = _penalty(m, total, alpha)
                    acc += raw - (np.outer(m.n * v, m.n * v) / (m.n + pull) if np.isfinite(pull) else 0)
                yield pd.DataFrame({"job": [i], "cells": [acc.ravel().tolist()]})

        by_group = self.cells.repartition(group)        # the blocks of a group in one task: k + 3 small rows each
        sums = by_group.mapInPandas(reduce, "job int, cells array<double>").select("job", F.posexplode("cells").alias("i", "v")) \
            .groupBy("job", "i").agg(F.sum("v").alias("v"))
        flat = np.zeros((len(wanted), (d + 2) ** 2))
        for r in sums.collect():
            flat[r["job"], r["i"]] = r["v"]
        out = {}
        for (t, alpha), cells in zip(wanted, flat):
            total = self.totals[t]
            a = cells.reshape(d + 2, d + 2)
            left = a[:-1, :-1].copy()
            left[1:, 1:] += alpha * np.diag(total.std()[:d] ** 2)
            w = np.linalg.lstsq(left, a[:-1, -1], rcond=1e-13)[0]
            out[t, alpha] = (w[1:], float(total.mean[d] + w[0] - w[1:] @ total.mean[:d]))
        return out

    def _group_sums(self, jobs):
        """Per group and job: ``(n, sum y, sum y^2 about the overall mean, sse)`` on the test blocks."""
        group, d = self.group, self.d
        spec = [(set(t), self.totals[t].n, a, set(which), model) for t, a, which, model in jobs]
        y0 = self.totals[jobs[-1][0]].mean[d]

        def score(batches):
            own: dict = {}
            for pdf in batches:
                for r in pdf.to_dict("records"):
                    own.setdefault(r[group], {})[int(r["_block"])] = Moment.read(r)
            out = []
            for g, by in own.items():
                for i, (train, total, alpha, test, model) in enumerate(spec):
                    m = merged((by[b] for b in test if b in by), d + 1)
                    if not m.n:
                        continue
                    home = merged((by[b] for b in train if b in by), d + 1)
                    f = LinearFit(list(range(d)), model[0], model[1] + _offset(home, model, total, alpha))
                    sse, *_, yy = f.sums(m, d)
                    gap = m.mean[d] - y0
                    out.append([g, i, m.n, m.n * gap, yy + m.n * gap * gap, sse, yy])
            yield pd.DataFrame(out, columns=[group, "job", "n", "s1", "s2", "sse", "yy"])

        gtype = self.cells.schema[group].dataType.simpleString()
        return self.cells.repartition(group).mapInPandas(score, f"`{group}` {gtype}, job int, n double, s1 double, s2 double, sse double, yy double")

    def errors(self, jobs) -> dict:
        """``(train blocks, alpha, test blocks) -> (n, r2, rmse)`` over all groups; one pass for all jobs."""
        got = self._group_sums(jobs).groupBy("job").agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2", "sse")]).collect()
        out = {(t, a, tuple(which)): (0.0, 0.0, float("nan")) for t, a, which, _ in jobs}
        for r in got:
            t, a, which, _ = jobs[r["job"]]
            yy = r["s2"] - r["s1"] ** 2 / r["n"]
            out[t, a, tuple(which)] = (r["n"], 1 - r["sse"] / yy if yy > 0 else 0.0, float(np.sqrt(max(r["sse"], 0) / r["n"])))
        return out

    def group_errors(self, model, train, alpha, splits, schema: str, scope: str) -> DataFrame:
        names = [name for name, _ in splits]
        got = self._group_sums([(train, alpha, which, model) for _, which in splits])
        r2 = F.when(F.col("yy") > 0, 1 - F.col("sse") / F.col("yy")).otherwise(F.lit(0.0))
        return got.select(self.group, F.lit(scope).alias("scope"), F.lit(float(alpha)).alias("alpha"),
                          F.element_at(F.array(*[F.lit(x) for x in names]), F.col("job") + 1).alias("split"), "n", r2.alias("r2"),
                          F.sqrt(F.greatest("sse", F.lit(0.0)) / F.col("n")).alias("rmse"))


def moments_union(cells: DataFrame, keys: list[str], d: int) -> DataFrame:
    """Moments merged over all other keys."""
    types = {f.name: f.dataType.simpleString() for f in cells.schema.fields}
    head = "".join(f"`{k}` {types[k]}, " for k in keys)

    def merge_some(key, pdf: pd.DataFrame) -> pd.DataFrame:
        m = merged((Moment.read(r) for r in pdf.to_dict("records")), d)
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), *m.row()]], columns=[*keys, "n", "mean", "comoment"])

    salted = cells.withColumn("_part", F.spark_partition_id() % MERGE_FAN).groupBy(*keys, "_part").applyInPandas(merge_some, head + MOMENT)
    return salted.groupBy(*keys).applyInPandas(merge_some, head + MOMENT)


# X16 / X17 / X18 / X19 / X21 -----------------------------------------------------------
def expanding_folds(n: int, k: int) -> list[tuple[int, int, int]]:
    """``(train end, test start, test end)`` of ``TimeSeriesSplit(k)`` over n rows."""
    size = n // (k + 1)
    return [(n - (k - i) * size,) * 2 + (n - (k - i - 1) * size,) for i in range(k)] if size else []


class FoldMoments:
    """Moments of every block between the cut positions of nested expanding folds."""

    def __init__(self, positioned: DataFrame, features: list[str], label: str, outer: int, inner: int):
        self.features, self.label, self.d = list(features), label, len(features)
        self.n = positioned.select("_n").first()
        self.n = self.n[0] if self.n else 0
        self.outer = expanding_folds(self.n, outer)
        ends = [self.n, *(train for train, _, _ in self.outer)]
        self.inner = {end: expanding_folds(end, inner) for end in ends}
        self.cuts = sorted({0, self.n, *(c for f in self.outer for c in f), *(c for fs in self.inner.values() for f in fs for c in f)})
        if len(self.cuts) < 2:
            self.cuts = [0, 1]
        block = F.size(F.filter(F.array(*[F.lit(c) for c in self.cuts[1:-1]]).cast("array<long>"), lambda c: c <= F.col("_pos"))) if len(self.cuts) > 2 \
            else F.lit(0)
        self.rows = positioned.withColumn("_block", block)
        by = read_moments(moments(self.rows, [*features, label], ["_block"]), ["_block"])
        self.blocks = [by.get((b,), Moment.empty(self.d + 1)) for b in range(len(self.cuts) - 1)]
        self.prefix = [Moment.empty(self.d + 1)]
        for m in self.blocks:
            self.prefix.append(self.prefix[-1].merge(m))

    def before(self, position: int) -> Moment:
        return self.prefix[self.cuts.index(position)]

    def between(self, a: int, b: int) -> Moment:
        return merged(self.blocks[self.cuts.index(a):self.cuts.index(b)], self.d + 1)

    def absolute_errors(self, jobs: list[tuple[LinearFit, int, int]]) -> list[float]:
        """Mean absolute error of each ``(model, from, to)`` on the rows of its positions: one
        pass over the rows, all models of a block at once."""
        d, cols = self.d, [*self.features, self.label]
        at = {}
        for j, (_, a, b) in enumerate(jobs):
            for block in range(self.cuts.index(a), self.cuts.index(b)):
                at.setdefault(block, []).append(j)
        coef = {b: np.array([jobs[j][0].full(d) for j in js]).T for b, js in at.items()}
        base = {b: np.array([jobs[j][0].intercept for j in js]) for b, js in at.items()}
        n_jobs = len(jobs)

        def partial(batches):
            total = np.zeros(n_jobs)
            for pdf in batches:
                x = pdf[[f"_x{i}" for i in range(d + 1)]].to_numpy(float)
                ok = ~np.isnan(x).any(axis=1)
                x, block = x[ok], pdf["_block"].to_numpy()[ok]
                for b in np.unique(block):
                    if b in at:
                        own = x[block == b]
                        total[at[b]] += np.abs(own[:, d:] - base[b] - own[:, :d] @ coef[b]).sum(axis=0)
            yield pd.DataFrame({"job": np.arange(n_jobs, dtype=np.int32), "v": total})

        used = self.rows.select("_block", *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
        sums = used.mapInPandas(partial, "job int, v double").groupBy("job").agg(F.sum("v").alias("v")).collect()
        out = [float("nan")] * n_jobs
        for r in sums:
            n = self.between(*jobs[r["job"]][1:]).n
            out[r["job"]] = r["v"] / n if n else float("nan")
        return out


def k_best(m: Moment, d: int, k: int) -> list[int]:
    """The k features of the largest F statistic of a simple regression (ties: first ones)."""
    r2 = np.clip(m.correlations(d)[:d] ** 2, 0, 1)
    f = np.where(r2 < 1, r2 / np.maximum(1 - r2, 1e-300) * max(m.n - 2, 0), np.inf)
    return sorted(np.argsort(-f, kind="stable")[:k].tolist())


def from_model(m: Moment, d: int, k: int, alpha: float, scale: np.ndarray) -> list[int]:
    """The k features of the largest ridge coefficients (of the scaled columns)."""
    w = np.abs(solve(m, list(range(d)), d, alpha, scale).scaled)
    return sorted(np.argsort(-w, kind="stable")[:k].tolist())


def elimination(m: Moment, d: int, alpha: float, scale: np.ndarray) -> list[list[int]]:
    """Recursive elimination: the features kept at each size, from all down to one."""
    kept, out = list(range(d)), []
    while kept:
        out.append(list(kept))
        w = np.abs(solve(m, kept, d, alpha, scale).scaled)
        kept.pop(int(np.argmin(w)))
    return out


SELECTORS = ("select_k_best", "select_from_model", "rfecv")


class Selection:
    """The three selectors with their inner tuning on one train range, all from moments.

    Columns are standardised by the train range; every subset of an inner fold is a ridge
    fitted on the fold's merged blocks. Sizes are ranked by mean R2, then (for the first two)
    mean absolute error, absolute out-of-fold correlation (rounded to 4 digits) and size."""

    def __init__(self, folds: FoldMoments, end: int, alpha: float):
        self.folds, self.end, self.alpha, self.d = folds, end, alpha, folds.d
        self.train = folds.before(end)
        self.scale = self.train.std()
        self.candidates: dict[tuple[str, int], list[tuple[LinearFit, int, int]]] = {}
        d = self.d
        for train_end, a, b in folds.inner[end]:
            m = folds.before(train_end)
            path = elimination(m, d, alpha, self.scale)
            for k in range(1, d + 1):
                for name, at in ((SELECTORS[0], k_best(m, d, k)), (SELECTORS[1], from_model(m, d, k, alpha, self.scale)), (SELECTORS[2], path[d - k])):
                    self.candidates.setdefault((name, k), []).append((solve(m, at, d, alpha, self.scale), a, b))

    def jobs(self) -> list[tuple[LinearFit, int, int]]:
        return [j for c in self.candidates.values() for j in c]

    def tune(self, mae: list[float]) -> None:
        """``mae`` in the order of :meth:`jobs`."""
        self.tuning, at, d = [], 0, self.d
        for (name, k), jobs in self.candidates.items():
            errors, at = mae[at:at + len(jobs)], at + len(jobs)
            tests = [self.folds.between(a, b) for _, a, b in jobs]
            r2 = [f.r2(m, d) for (f, _, _), m in zip(jobs, tests)]
            self.tuning.append({"selector": name, "n_features": k, "cv_r2": float(np.mean(r2)), "cv_mae": float(np.mean(errors)),
                                "oof_corr": pooled_correlation([f for f, _, _ in jobs], tests, d)})
        self.best = {}
        for name in SELECTORS:
            own = [t for t in self.tuning if t["selector"] == name]
            if not own:
                self.best[name] = d
            elif name == "rfecv":
                self.best[name] = max(own, key=lambda t: (t["cv_r2"], -t["n_features"]))["n_features"]
            else:
                self.best[name] = min(own, key=lambda t: (-round(t["cv_r2"], 4), round(t["cv_mae"], 4), -round(abs(t["oof_corr"]), 4),
                                                          t["n_features"]))["n_features"]

    def selected(self, name: str) -> list[int]:
        k, d = self.best[name], self.d
        if name == "select_k_best":
            return k_best(self.train, d, k)
        if name == "select_from_model":
            return from_model(self.train, d, k, self.alpha, self.scale)
        return elimination(self.train, d, self.alpha, self.scale)[d - k]

    def model(self, name: str) -> LinearFit:
        return solve(self.train, self.selected(name), self.d, self.alpha, self.scale)


def pooled_correlation(fits: list[LinearFit], tests: list[Moment], target: int) -> float:
    """Correlation of out-of-fold predictions with the target over all folds together."""
    both = Moment.empty(2)
    for f, m in zip(fits, tests):
        if m.n:
            _, pred, pp, cross, yy = f.sums(m, target)
            both = both.merge(Moment(m.n, np.array([pred, m.mean[target]]), np.array([[pp, cross], [cross, yy]])))
    s = np.sqrt(np.clip(np.diag(both.comoment), 0, None))
    return float(both.comoment[0, 1] / (s[0] * s[1])) if s.all() else 0.0


def selection_study(df: DataFrame, features: list[str], label: str, order: list[str], outer: int = 4, inner: int = 3,
                    alpha: float = 1.0) -> dict[str, DataFrame]:
    """The three selectors tuned inside each outer fold and on all rows.

    Rows with a null in any feature or the target are left out before folds are cut. Returns
    ``tuning`` (per selector and size, on all rows), ``outer`` (per selector and outer fold:
    size, test R2 and MAE), ``frequency`` (how often each feature is selected over the outer
    folds, and whether on all rows). Three passes over the rows."""
    spark = df.sparkSession
    whole = df.select(*order, *[c for c in [*features, label] if c not in order]).na.drop(subset=[*features, label])
    folds = FoldMoments(cut_lineage(global_position(whole, order)), features, label, outer, inner)
    ends = [folds.n, *(train for train, _, _ in folds.outer)]
    studies = {end: Selection(folds, end, alpha) for end in dict.fromkeys(ends)}
    jobs = [s.jobs() for s in studies.values()]
    errors = folds.absolute_errors([j for js in jobs for j in js]) if any(jobs) else []
    at = 0
    for s, js in zip(studies.values(), jobs):
        s.tune(errors[at:at + len(js)])
        at += len(js)
    tests = [(name, i, end, a, b) for name in SELECTORS for i, (end, a, b) in enumerate(folds.outer)]
    finals = [(studies[end].model(name), a, b) for name, _, end, a, b in tests]
    mae = folds.absolute_errors(finals) if finals else []
    full = studies[folds.n]
    outer_rows, chosen = [], {}
    for (name, i, end, a, b), (f, _, _), e in zip(tests, finals, mae):
        outer_rows.append((name, i, studies[end].best[name], ",".join(features[c] for c in f.at), f.r2(folds.between(a, b), folds.d), e))
        for c in f.at:
            chosen[name, c] = chosen.get((name, c), 0) + 1
    tuning = [(t["selector"], t["n_features"], t["cv_r2"], t["cv_mae"], t["oof_corr"], full.best[t["selector"]] == t["n_features"]) for t in full.tuning]
    last = {name: full.selected(name) for name in SELECTORS}
    frequency = [(name, f, chosen.get((name, c), 0), c in last[name]) for name in SELECTORS for c, f in enumerate(features)]
    return {"tuning": spark.createDataFrame(tuning, "selector string, n_features int, cv_r2 double, cv_mae double, oof_corr double, chosen boolean"),
            "outer": spark.createDataFrame(outer_rows, "selector string, fold int, n_features int, features string, test_r2 double, test_mae double"),
            "frequency": spark.createDataFrame(frequency, "selector string, feature string, times_selected int, on_all_rows boolean")}


def drop_one(train: DataFrame, valid: DataFrame, test: DataFrame, features: list[str], label: str, alpha: float = 1.0,
             r2_tolerance: float = 0.01, rmse_tolerance: float = 0.05) -> DataFrame:
    """Refit on the train rows without each feature; changes of R2 and RMSE on the valid and
    the test rows. By the test rows: ``remove`` where neither gets worse, ``consider`` where R2
    falls by less than ``r2_tolerance`` and RMSE grows by less than ``rmse_tolerance``, else
    ``keep``. One pass over each table."""
    d = len(features)
    own, *seen = (read_moments(moments(x, [*features, label])).get((), Moment.empty(d + 1)) for x in (train, valid, test))
    base = solve(own, list(range(d)), d, alpha)
    rows = []
    for i, f in enumerate(features):
        less = solve(own, [c for c in range(d) if c != i], d, alpha)
        (vr, ve), (tr, te) = ((less.r2(m, d) - base.r2(m, d), less.rmse(m, d) - base.rmse(m, d)) for m in seen)
        verdict = "remove" if tr >= 0 and te <= 0 else "consider" if tr > -r2_tolerance and te < rmse_tolerance else "keep"
        rows.append((f, d - 1, vr, tr, ve, te, verdict))
    return train.sparkSession.createDataFrame(
        rows, "feature string, remaining int, valid_r2_delta double, test_r2_delta double, valid_rmse_delta double, test_rmse_delta double, verdict string")


# M40 / X22 -----------------------------------------------------------------------------
def mean_absolute_errors(df: DataFrame, cols: list[str], label: str, fits: list[LinearFit]) -> list[float]:
    """Mean absolute error of every model on the rows of ``df`` (nulls left out): one pass."""
    d, n_fits = len(cols), len(fits)
    coef = np.array([f.full(d) for f in fits]).T
    base = np.array([f.intercept for f in fits])

    def partial(batches):
        total, n = np.zeros(n_fits), 0
        for pdf in batches:
            x = pdf.to_numpy(float)
            x = x[~np.isnan(x).any(axis=1)]
            total += np.abs(x[:, d:] - base - x[:, :d] @ coef).sum(axis=0)
            n += len(x)
        yield pd.DataFrame({"job": np.arange(n_fits, dtype=np.int32), "v": total, "n": float(n)})

    used = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate([*cols, label])])
    out = [float("nan")] * n_fits
    for r in used.mapInPandas(partial, "job int, v double, n double").groupBy("job").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect():
        out[r["job"]] = r["v"] / r["n"] if r["n"] else float("nan")
    return out


def compare_feature_sets(train: DataFrame, tests: dict[str, DataFrame], sets: dict[str, list[str]], label: str, alpha: float = 0.0) -> DataFrame:
    """One linear model per named feature set, scored on every table of ``tests``:
    ``feature_set, feature_count`` and per table ``R2, RMSE, MAE, RMSE_over_std, MAE_over_mean``.
    Rows with a null in any feature of any set are left out, so all sets see the same rows;
    two passes over each table, whatever the number of sets."""
    cols = list(dict.fromkeys(f for s in sets.values() for f in s))
    d = len(cols)
    own = read_moments(moments(train, [*cols, label])).get((), Moment.empty(d + 1))
    fits = [solve(own, [cols.index(f) for f in s], d, alpha) for s in sets.values()]
    rows = [[name, len(s)] for name, s in sets.items()]
    schema = "feature_set string, feature_count int"
    for part, df in tests.items():
        m = read_moments(moments(df, [*cols, label])).get((), Moment.empty(d + 1))
        std = float(np.sqrt(m.comoment[d, d] / (m.n - 1))) if m.n > 1 else 0.0
        mean = float(m.mean[d])
        for row, f, mae in zip(rows, fits, mean_absolute_errors(df, cols, label, fits)):
            rmse = f.rmse(m, d)
            row += [f.r2(m, d) if m.n else None, rmse, mae, rmse / std if std else None, mae / mean if mean else None]
        schema += "".join(f", {part}_{c} double" for c in ("R2", "RMSE", "MAE", "RMSE_over_std", "MAE_over_mean"))
    return train.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def compare_axes(train: DataFrame, valid: DataFrame, axes: dict[str, dict[str, list[str]]], features: list[str], label: str,
                 alpha: float = 0.0) -> DataFrame:
    """For each axis (a group of related features) every variant replaces the axis's
    features while all others stay; ``best`` marks the least RMSE of an axis. One comparison
    for all axes, so the tables are read as often as for one."""
    sets = {}
    for axis, variants in axes.items():
        of_axis = {f for v in variants.values() for f in v}
        for name, chosen in variants.items():
            sets[f"{axis}|{name}"] = [f for f in features if f not in of_axis] + list(chosen)
    got = compare_feature_sets(train, {"valid": valid}, sets, label, alpha)
    parts = F.split("feature_set", r"\|", 2)
    least = Window.partitionBy("axis").orderBy("rmse", "mae", "variant")
    return got.select(parts[0].alias("axis"), parts[1].alias("variant"), "feature_count", F.col("valid_MAE").alias("mae"),
                      F.col("valid_RMSE").alias("rmse"), F.col("valid_R2").alias("r2")).withColumn("best", F.row_number().over(least) == 1)


# X1 / X2 / X10 / X12 / X16 ---------------------------------------------------------------
@dataclass
class PairMoments:
    """Moments of every pair of columns over the rows that have both: at [i, j] the number
    of rows, the mean and the centred square sum of column i, and the cross product."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> PairMoments:
        """``x`` with NaN where a value is missing."""
        has = ~np.isnan(x)
        some = has.any(axis=0)
        shift = np.where(some, np.nansum(np.where(has, x, 0.0), axis=0) / np.maximum(has.sum(axis=0), 1), 0.0)
        z, p = np.where(has, x - shift, 0.0), has.astype(float)
        n, s = p.T @ p, z.T @ p
        m = np.divide(s, n, out=np.zeros_like(s), where=n > 0)
        return cls(n, np.where(n > 0, m + shift[:, None], 0.0), (z * z).T @ p - s * m, z.T @ z - s * m.T)

    @classmethod
    def read(cls, cells, d: int) -> PairMoments:
        return cls(*np.asarray(cells, float).reshape(4, d, d))

    def cells(self) -> list[float]:
        return np.stack([self.n, self.mean, self.square, self.cross]).ravel().tolist()

    def merge(self, other: PairMoments) -> PairMoments:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        gap = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        both = self.n * share
        mean = np.where(self.n > 0, self.mean + gap * share, other.mean)
        return PairMoments(n, mean, self.square + other.square + gap * gap * both, self.cross + other.cross + gap * gap.T * both)

    def correlation(self) -> np.ndarray:
        """Pearson's r; NaN where a column has no variance on the pair's rows."""
        flat = self.square <= self.n * (1e-13 * np.abs(self.mean)) ** 2
        s = np.sqrt(np.where(flat, 0.0, self.square))
        den = s * s.T
        return np.where(den > 0, np.clip(np.divide(self.cross, den, out=np.zeros_like(den), where=den > 0), -1, 1), np.nan)


def pair_correlations(df: DataFrame, pairs: list[tuple[str, str]], names=("variable_1", "variable_2")) -> DataFrame:
    """Pearson correlation of column pairs on the rows that have both: ``(name1, name2,
    correlation, n)``. A partition's rows become one matrix of pair moments, so the work is a
    few matrix products, the rows are read once and what is shuffled depends on the number of
    columns alone. Null where a column has no variance; NaN counts as missing."""
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    d = len(cols)
    used = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])

    def partial(batches):
        own = PairMoments.of(np.empty((0, d)))
        for pdf in batches:
            own = own.merge(PairMoments.of(pdf.to_numpy(float)))
        yield pd.DataFrame({"cells": [own.cells()]})

    def merge_some(key, pdf: pd.DataFrame) -> pd.DataFrame:
        own = PairMoments.of(np.empty((0, d)))
        for cells in pdf["cells"]:
            own = own.merge(PairMoments.read(cells, d))
        return pd.DataFrame({"cells": [own.cells()]})

    def to_pairs(batches):
        for pdf in batches:
            for cells in pdf["cells"]:
                own = PairMoments.read(cells, d)
                r = own.correlation()
                at = [(cols.index(a), cols.index(b)) for a, b in pairs]
                yield pd.DataFrame({names[0]: [a for a, _ in pairs], names[1]: [b for _, b in pairs],
                                    "correlation": pd.array([r[i, j] for i, j in at], "Float64"), "n": [int(own.n[i, j]) for i, j in at]})

    some = used.mapInPandas(partial, "cells array<double>").groupBy((F.spark_partition_id() % MERGE_FAN).alias("_part")) \
        .applyInPandas(merge_some, "cells array<double>")
    none = df.sparkSession.createDataFrame([(PairMoments.of(np.empty((0, d))).cells(),)], "cells array<double>")   # so that no rows give a row a pair
    whole = some.unionByName(none).groupBy(F.lit(0).alias("_all")).applyInPandas(merge_some, "cells array<double>")      # MERGE_FAN small matrices
    found = whole.mapInPandas(to_pairs, f"`{names[0]}` string, `{names[1]}` string, correlation double, n long")
    return found.withColumn("correlation", F.when(~F.isnan("correlation"), F.col("correlation")))


# M14 / M22 / M23 / M25 -------------------------------------------------------------------
def elastic_net(m: Moment, at: list[int], target: int, alpha: float, l1_ratio: float, scale: np.ndarray | None = None,
                tolerance: float = 1e-11, rounds: int = 20_000) -> LinearFit:
    """Minimum of ``sum w (y - xb)^2 / (2 sum w) + alpha (l1_ratio |b| + (1 - l1_ratio) b^2 / 2)`` on
    columns divided by ``scale``, by cyclic coordinate descent on the moment alone."""
    at = list(at)
    s = (m.std() if scale is None else scale)[at]
    if not m.n or not at:
        return LinearFit(at, np.zeros(len(at)), float(m.mean[target]) if m.n else 0.0, np.zeros(len(at)))
    gram = m.comoment[np.ix_(at, at)] / np.outer(s, s) / m.n
    rhs = m.comoment[at, target] / s / m.n
    w = np.zeros(len(at))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(at)):
            pull = rhs[j] - gram[j] @ w + gram[j, j] * w[j]
            den = gram[j, j] + alpha * (1 - l1_ratio)
            new = np.sign(pull) * max(abs(pull) - alpha * l1_ratio, 0.0) / den if den > 0 else 0.0
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved < tolerance:
            break
    coef = w / s
    return LinearFit(at, coef, float(m.mean[target] - coef @ m.mean[at]), w)


# The penalties and shares of the grids.
PENALTIES = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
L1_SHARES = (0.2, 0.5, 0.8)
MODEL_SPACE = {"linear": [{}], "ridge": [{"alpha": a} for a in PENALTIES], "lasso": [{"alpha": a, "l1_ratio": 1.0} for a in PENALTIES],
               "elasticnet": [{"alpha": a, "l1_ratio": r} for a in PENALTIES for r in L1_SHARES]}


def fit_linear(model: str, params: dict, m: Moment, at: list[int], target: int, scale: np.ndarray) -> LinearFit:
    if model in ("linear", "ridge"):
        return solve(m, at, target, params.get("alpha", 0.0), scale)
    return elastic_net(m, at, target, params["alpha"], params["l1_ratio"], scale)


def model_space_search(df: DataFrame, features: list[str], targets: list[str], split_col: str, order: list[str], weight: str | None = None,
                       k: int = 3, space: dict[str, list[dict]] | None = None) -> DataFrame:
    """Grid search over a space of linear models with sample weights, for every target.

    ``split_col`` says train, valid or test. For each model the grid point of the best mean R2
    over ``k`` expanding folds of the train rows (in ``order``) is fitted on all train rows and
    scored on the three parts (``stage`` ``search``, with the gaps train - test and valid -
    test). The best model of a target by valid R2 is then fitted again on train and valid rows
    and scored once on the test rows (``stage`` ``sealed``). Fits are weighted, scales and
    scores are not. Rows with a null in a feature, target or weight play no part.

    The folds' moments, weighted and not, hold all that any grid point needs, so the rows are
    read four times (positions, both moments, absolute errors) for the whole space."""
    space = space or MODEL_SPACE
    cols = [*features, *targets]
    d = len(features)
    at = list(range(d))
    used = df.select(*dict.fromkeys([*order, split_col, *cols, *([weight] if weight else [])])).na.drop(subset=[*cols, *([weight] if weight else [])])
    placed = global_position(used.filter(F.col(split_col) == "train"), order)
    size = F.floor(F.col("_n") / (k + 1))
    first = F.col("_n") - k * size
    block = F.when((size == 0) | (F.col("_pos") < first), F.lit(0)).otherwise(F.floor(F.try_divide(F.col("_pos") - first, size)) + 1)
    rows = cut_lineage(placed.withColumn("_block", block.cast("int")).drop("_pos", "_n").unionByName(
        used.filter(F.col(split_col).isin("valid", "test")).withColumn("_block", F.when(F.col(split_col) == "valid", F.lit(k + 1)).otherwise(F.lit(k + 2)))))
    plain = read_moments(moments(rows, cols, ["_block"]), ["_block"])
    heavy = read_moments(moments(rows, cols, ["_block"], weight), ["_block"]) if weight else plain

    def pick(of: dict, which) -> Moment:
        return merged((of[b,] for b in which if (b,) in of), len(cols))

    parts = {"train": range(k + 1), "valid": [k + 1], "test": [k + 2]}
    folds = [(pick(heavy, range(j + 1)), pick(plain, range(j + 1)).std(), pick(plain, [j + 1])) for j in range(k)]
    folds = [f for f in folds if f[0].n and f[2].n]
    chosen, scores = [], {name: pick(plain, which) for name, which in parts.items()}
    own, scale = pick(heavy, parts["train"]), scores["train"].std()
    for t, target in enumerate(targets):
        for model, grid in space.items():
            cv = [float(np.mean([fit_linear(model, p, m, at, d + t, s).r2(test, d + t) for m, s, test in folds])) if folds else 0.0 for p in grid]
            best = int(np.argmax(cv))
            chosen.append(("search", t, model, grid[best], cv[best], fit_linear(model, grid[best], own, at, d + t, scale)))
    both = [*parts["train"], *parts["valid"]]
    for t in range(len(targets)):
        top = max((c for c in chosen if c[0] == "search" and c[1] == t), key=lambda c: c[5].r2(scores["valid"], d + t))
        chosen.append(("sealed", t, top[2], top[3], top[4], fit_linear(top[2], top[3], pick(heavy, both), at, d + t, pick(plain, both).std())))
    mae = {}
    for name, which in parts.items():
        of_part = rows.filter(F.col("_block").isin(list(which)))
        for t, target in enumerate(targets):
            fits = [(i, c[5]) for i, c in enumerate(chosen) if c[1] == t and (c[0] == "search" or name == "test")]
            for (i, _), e in zip(fits, mean_absolute_errors(of_part, features, target, [f for _, f in fits])):
                mae[i, name] = e
    out, schema = [], "stage string, target string, model string, params string, cv_r2 double"
    for name in parts:
        schema += f", {name}_R2 double, {name}_RMSE double, {name}_MAE double"
    schema += ", train_test_gap double, valid_test_gap double"
    for i, (stage, t, model, params, cv, f) in enumerate(chosen):
        row, r2 = [stage, targets[t], model, json.dumps(params, sort_keys=True), cv], {}
        for name, m in scores.items():
            if stage == "sealed" and name != "test":
                row += [None] * 3
                continue
            r2[name] = f.r2(m, d + t) if m.n else None
            row += [r2[name], f.rmse(m, d + t) if m.n else None, mae[i, name]]
        gaps = [None if stage == "sealed" or r2[a] is None or r2["test"] is None else r2[a] - r2["test"] for a in ("train", "valid")]
        out.append((*row, *gaps))
    return df.sparkSession.createDataFrame(out, schema)
