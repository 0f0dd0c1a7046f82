"""Model fitting, search and model-based selection on ``pyspark.ml`` (SURVEY M10-M28,
M37, M39-M42, I12, X10, X17-X23).

Every fit is a distributed Spark job; driver code only loops over parameter sets,
folds or feature subsets (small, fixed lists) and reads back metric rows. Fold
membership is computed once as a row position (``splits.global_position``) and
checkpointed, so each fold is a range filter rather than an exploded copy.
"""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..util import cut_lineage
from . import evaluate as ev
from .moments import least_squares
from .prepare import FILLED, ExactPrepare
from .splits import global_position, permute_column, shuffled_columns

FEATURES_COL = "features"


# M10 / M11 -------------------------------------------------------------------
def prepare_model(train: DataFrame, numeric: list[str], categorical: list[str] = (), scale: bool = True) -> PipelineModel:
    """Preparation fitted on ``train``: exact medians (and standardisation) of the numeric
    columns, modes and one-hot columns of the category columns, one feature vector. Other
    frames are filled and aligned the same way."""
    exact = ExactPrepare(numeric=list(numeric), categorical=list(categorical)).fit(train)
    filled, hot = exact.outputs()
    stages: list = [exact]
    if scale and filled:
        stages += [VectorAssembler(inputCols=filled, outputCol="_num"),
                   StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True)]
        filled = ["_num_s"]
    stages.append(VectorAssembler(inputCols=[*filled, *hot], outputCol=FEATURES_COL))
    return Pipeline(stages=stages).fit(train)


# M12-M20 ---------------------------------------------------------------------
def estimator(kind: str, label: str = "label", weight: str | None = None, seed: int = 42, **params):
    """Estimator by name."""
    common = {"featuresCol": FEATURES_COL, "labelCol": label, "predictionCol": "pred"}
    if weight:
        common["weightCol"] = weight
    if kind in ("linear", "ridge", "lasso", "elasticnet"):
        p = {"linear": {"regParam": 0.0, "elasticNetParam": 0.0, "solver": "normal"},
             "ridge": {"elasticNetParam": 0.0, "solver": "normal"},
             "lasso": {"elasticNetParam": 1.0}, "elasticnet": {"elasticNetParam": 0.5}}[kind]
        p.update(params)
        return LinearRegression(**common, **p)
    if kind == "poisson":
        return GeneralizedLinearRegression(**common, family="poisson", link="log", **params)
    if kind == "tweedie":
        params.setdefault("variancePower", 1.5)
        params.setdefault("linkPower", 0.0)
        return GeneralizedLinearRegression(**common, family="tweedie", **params)
    if kind == "rf":
        return RandomForestRegressor(**common, seed=seed, **params)
    if kind == "gbt":
        return GBTRegressor(**common, seed=seed, **params)
    common.pop("predictionCol")
    cls = {"logistic": LogisticRegression, "rf_classifier": RandomForestClassifier,
           "gbt_classifier": GBTClassifier}[kind]
    extra = {} if kind == "logistic" else {"seed": seed}
    return cls(**common, predictionCol="pred_label", **extra, **params)


def ridge_reg_param(df: DataFrame, label: str, alpha: float) -> float:
    """SURVEY 2.X.23: Spark's ``regParam`` that reproduces a standardised ridge with
    penalty ``alpha`` on the Gram diagonal is ``alpha / n * stddev_pop(label)``."""
    n, sd = df.agg(F.count(F.col(label)), F.stddev_pop(label)).first()
    return float(alpha) / n * float(sd or 0.0)


def fit(train: DataFrame, numeric: list[str], label: str, kind: str, categorical: list[str] = (),
        log_target: bool = False, weight: str | None = None, scale: bool = True, prepare_on: DataFrame | None = None, **params) -> PipelineModel:
    """Fit preparation + estimator. With ``log_target`` the model learns ``log1p(label)``
    (M21). ``prepare_on`` are the rows the preparation may see (default: ``train``); rows that
    only stop the training early must not be among them (M18)."""
    lab = label
    if log_target:
        train = train.withColumn("_log_label", F.log1p(F.col(label)))
        lab = "_log_label"
    if kind == "ridge" and "alpha" in params:
        params["regParam"] = ridge_reg_param(train, lab, params.pop("alpha"))
    prepared = prepare_model(train if prepare_on is None else prepare_on, numeric, categorical, scale)
    return PipelineModel([*prepared.stages, estimator(kind, lab, weight, **params).fit(prepared.transform(train))])


def predict(model: PipelineModel, df: DataFrame, log_target: bool = False, cap: str | None = None) -> DataFrame:
    """Predictions in ``pred``; log-target models are mapped back with
    ``max(0, expm1)`` (M21); ``cap`` clips to a per-row capacity (M42)."""
    out = model.transform(df)
    if log_target:
        out = out.withColumn("pred", F.greatest(F.expm1("pred"), F.lit(0.0)))
    if cap:
        out = out.withColumn("pred", F.least(F.greatest("pred", F.lit(0.0)), F.col(cap).cast("double")))
    drop = [c for c in out.columns if c.endswith((FILLED, "__oh")) or c in
            ("_num", "_num_s", FEATURES_COL, "rawPrediction", "_log_label")]
    return out.drop(*drop)


# M6 / M23 / M24 / M25 / M37 ------------------------------------------------------
def with_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """Row positions in time order (the ordered rows are written once for all folds)."""
    return global_position(df, order)


def fold_frames(pos_df: DataFrame, k: int, gap: int = 0):
    """Expanding ``TimeSeriesSplit`` folds as (train, test) range filters."""
    n = pos_df.select("_n").first()[0]
    size = n // (k + 1)
    for i in range(k):
        start = n - (k - i) * size
        yield (i, pos_df.filter(F.col("_pos") < start - gap),
               pos_df.filter((F.col("_pos") >= start) & (F.col("_pos") < start + size)))


def ts_search(df: DataFrame, numeric: list[str], label: str, kind: str, grid: list[dict], order: list[str], k: int = 3, gap: int = 0, metric: str = "r2", log_target: bool = False,
              oof: bool = False):
    """Grid (or sampled) search over expanding folds; returns per-(params, fold)
    scores, and the pooled out-of-fold predictions when ``oof`` (M37)."""
    spark = df.sparkSession
    pos = with_positions(df, order)
    rows, preds = [], []
    for gi, params in enumerate(grid):
        for fold, tr, te in fold_frames(pos, k, gap):
            m = fit(tr, numeric, label, kind, log_target=log_target, **dict(params))
            p = predict(m, te, log_target).withColumn("y", F.col(label).cast("double"))
            s = ev.regression_metrics(p, "y", "pred").first()
            rows.append((gi, json.dumps(params, sort_keys=True), fold, float(s["mae"]), float(s["rmse"]),
                         float(s["r2"])))
            if oof:
                preds.append(p.select(*order, "y", "pred", F.lit(gi).alias("grid_id"), F.lit(fold).alias("fold")))
    res = spark.createDataFrame(rows, "grid_id int, params string, fold int, mae double, rmse double, r2 double")
    if oof:
        allp = preds[0]
        for p in preds[1:]:
            allp = allp.unionByName(p)
        return res, allp
    return res


def grid(**axes) -> list[dict]:
    """``ParamGridBuilder``-style cartesian product of small parameter lists."""
    keys = list(axes)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[axes[k] for k in keys])]


def random_grid(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Seeded random search: ``n`` draws from lists (uniform choice) or (lo, hi)
    float ranges (log-uniform when ``lo > 0``)."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        d = {}
        for k, v in space.items():
            if isinstance(v, tuple):
                lo, hi = v
                d[k] = float(math.exp(rng.uniform(math.log(lo), math.log(hi)))) if lo > 0 else float(rng.uniform(lo, hi))
            else:
                d[k] = v[int(rng.integers(len(v)))]
        out.append(d)
    return out


def best_params(scores: DataFrame, metric: str = "r2", larger_is_better: bool = True) -> dict:
    """Parameter set with the best mean fold score (ties: first in the grid)."""
    agg = scores.groupBy("grid_id", "params").agg(F.avg(metric).alias("m"))
    r = agg.orderBy(F.desc("m") if larger_is_better else F.asc("m"), "grid_id").first()
    return json.loads(r["params"])


def refit_sealed(train: DataFrame, valid: DataFrame, test: DataFrame, numeric: list[str], label: str, kind: str,
                 params: dict, log_target: bool = False) -> DataFrame:
    """Refit the chosen setting on train + valid and score the sealed test once."""
    m = fit(train.unionByName(valid), numeric, label, kind, log_target=log_target, **params)
    p = predict(m, test, log_target).withColumn("y", F.col(label).cast("double"))
    return ev.regression_metrics(p, "y", "pred")


# M26 -------------------------------------------------------------------------
def per_group_ridge(df: DataFrame, group: str, numeric: list[str], label: str, alpha: float = 1.0) -> DataFrame:
    """One closed-form ridge per group (see ``moments.least_squares``): a coefficient row per
    group; its rows meet only as moments."""
    return least_squares(df, numeric, label, alpha, [group])


def score_per_group(df: DataFrame, coefs: DataFrame, group: str, numeric: list[str]) -> DataFrame:
    """Predictions from per-group coefficients (one broadcastable row per group)."""
    j = df.join(coefs.select(group, "intercept", "coef"), group)
    pred = F.col("intercept")
    for i, c in enumerate(numeric):
        pred = pred + F.col("coef")[i] * F.col(c)
    return j.withColumn("pred", pred).drop("intercept", "coef")


# X17 / X20 / X21 / M39 -----------------------------------------------------------
def importances(model: PipelineModel, numeric: list[str]) -> list[tuple[str, float]]:
    """Tree importances or absolute linear coefficients, by input feature."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray()
    else:
        vals = np.abs(last.coefficients.toArray())
    return list(zip(numeric, [float(v) for v in vals[:len(numeric)]]))


def select_from_model(imps: list[tuple[str, float]]) -> list[str]:
    """Features whose importance is at least the median importance."""
    med = float(np.median([v for _, v in imps])) if imps else 0.0
    return [f for f, v in imps if v >= med]


def permutation_importance(model: PipelineModel, df: DataFrame, numeric: list[str], label: str,
                           key: list[str], repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean and deviation of the drop of R2 over ``repeats`` shuffles of one feature column.

    All features and repeats in one job: the shuffles come from one sort, every row is
    scored once as it is and once per (feature, repeat) with that value exchanged, and the
    scores are aggregated in the same pass."""
    y = F.col(label).cast("double")
    x = shuffled_columns(df.select(*dict.fromkeys([*key, label, *numeric])), numeric, key, repeats, seed)
    variants = [(None, 0), *((f, r) for f in numeric for r in range(1, repeats + 1))]
    made = [F.struct(F.lit(f).cast("string").alias("feature"), F.lit(r).alias("repeat"), y.alias("y"),
                     *[F.col(f"`{c}__shuffled{r}`" if c == f else f"`{c}`").alias(c) for c in numeric]) for f, r in variants]
    scored = predict(model, x.select(F.inline(F.array(*made))))
    r2 = ev.regression_metrics(scored, "y", "pred", ["feature", "repeat"]).select("feature", "repeat", "r2")
    drops = r2.withColumn("base", F.max(F.when(F.col("repeat") == 0, F.col("r2"))).over(Window.partitionBy())).filter("repeat > 0")     # a row per variant
    return drops.groupBy("feature").agg(F.avg(F.col("base") - F.col("r2")).alias("importance_mean"),
                                        F.stddev_pop(F.col("base") - F.col("r2")).alias("importance_std"))


# I12 -------------------------------------------------------------------------
def recursive_projection(model: PipelineModel, history: DataFrame, start_ts, steps: int, station: str,
                         time_col: str, target: str, lags: list[int], make_features,
                         stations: DataFrame | None = None):
    """Live projection: each step predicts the next hour for all stations at once;
    the prediction becomes history so later lags use it. ``make_features(frame)``
    adds calendar / lag columns to a (station, ts, target) frame. ``stations`` (default:
    all of ``history``) are projected, also those without recent rows."""
    max_lag = max(lags)
    start = F.lit(start_ts).cast("timestamp_ntz")
    # only the last max_lag hours of history can feed a lag: keep that window, written once
    recent = cut_lineage(history.filter(F.col(time_col) >= start - F.make_dt_interval(hours=F.lit(max_lag + 1)))
                         .select(station, time_col, F.col(target).cast("double").alias(target)))
    stations = cut_lineage((history if stations is None else stations).select(station).distinct())
    out = []
    for s in range(steps):
        t = start + F.make_dt_interval(hours=F.lit(s))
        nxt = stations.withColumn(time_col, t).withColumn(target, F.lit(None).cast("double"))
        lo = start + F.make_dt_interval(hours=F.lit(s - max_lag - 1))
        frame = recent.filter(F.col(time_col) >= lo).unionByName(nxt)
        feats = make_features(frame).filter(F.col(time_col) == t)
        # one row per station and step; writing it keeps every later step's plan shallow
        p = cut_lineage(predict(model, feats).select(station, time_col,
                                                     F.greatest("pred", F.lit(0.0)).alias(target)))
        out.append(p.withColumn("step", F.lit(s + 1)))
        recent = recent.unionByName(p)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


# X23 -------------------------------------------------------------------------
def leak_checks(train: DataFrame, test: DataFrame, numeric: list[str], label: str, kind: str, key: list[str],
                prev_col: str | None = None, seed: int = 42, **params) -> DataFrame:
    """Scores of: the real model, a model fitted on a shuffled target (should be
    near 0), a model without the previous-cycle feature, a mean dummy and the naive
    previous-value forecast."""
    spark = train.sparkSession

    def score(p):
        p = p.withColumn("y", F.col(label).cast("double"))
        return float(ev.regression_metrics(p, "y", "pred").first()["r2"])

    rows = [("model", score(predict(fit(train, numeric, label, kind, **params), test)))]
    shuf = permute_column(train, label, key, seed)
    rows.append(("shuffled_target", score(predict(fit(shuf, numeric, label, kind, **params), test))))
    if prev_col and prev_col in numeric:
        rest = [c for c in numeric if c != prev_col]
        rows.append(("no_previous_cycle", score(predict(fit(train, rest, label, kind, **params), test))))
    mean = train.agg(F.avg(label)).first()[0]
    rows.append(("mean_dummy", score(test.withColumn("pred", F.lit(float(mean))))))
    if prev_col:
        rows.append(("naive_previous", score(test.withColumn("pred", F.col(prev_col).cast("double"))
                                             .na.drop(subset=["pred"]))))
    return spark.createDataFrame(rows, "check string, r2 double")
