"""Moments against plain fits on the rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import moments as mo

D = 5


def table(n=400, stations=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, [1, 2, 0.5, 3, 1], (n, D)) + [0, 10, -3, 1000, 5]
    x[:, 4] = x[:, 0] * 0.7 + rng.normal(0, 0.4, n)
    s = rng.integers(0, stations, n)
    y = 3 + 2 * x[:, 0] - 0.4 * x[:, 1] + 0.02 * (x[:, 3] - 1000) + s * 1.5 + rng.normal(0, 0.5, n)
    return x, s, y


def frame(spark, x, s, y, split=None):
    rows = [(int(g), i, float(t), *map(float, v), split[i] if split else "train") for i, (g, t, v) in enumerate(zip(s, y, x))]
    df = spark.createDataFrame(rows, "station int, i long, y double, " + ", ".join(f"f{j} double" for j in range(D)) + ", split string")
    return df.withColumn("ts", F.timestamp_add("HOUR", F.col("i").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))).repartition(7)


F_ = [f"f{j}" for j in range(D)]


def ridge(x, y, alpha, scale=None, cols=None):
    """Coefficients of the raw columns and intercept, on the rows."""
    cols = list(range(x.shape[1])) if cols is None else list(cols)
    sd = x.std(axis=0) if scale is None else scale
    z = (x - x.mean(axis=0))[:, cols] / sd[cols]
    w = np.linalg.solve(z.T @ z + alpha * np.eye(len(cols)), z.T @ (y - y.mean()))
    c = w / sd[cols]
    return c, y.mean() - c @ x.mean(axis=0)[cols], w


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


@pytest.mark.parametrize("alpha", [0.0, 10.0])
def test_least_squares_per_station_and_all(spark, alpha):
    x, s, y = table()
    df = frame(spark, x, s, y).withColumn("f1", F.when(F.col("i") != 7, F.col("f1")))          # a null row plays no part
    ok = np.arange(400) != 7
    got = mo.least_squares(df, F_, "y", alpha).first()
    c, b, _ = ridge(x[ok], y[ok], alpha)
    assert got.n == 399 and np.allclose(got.coef, c) and np.isclose(got.intercept, b)
    for r in mo.least_squares(df, F_, "y", alpha, ["station"]).collect():
        at = ok & (s == r.station)
        c, b, _ = ridge(x[at], y[at], alpha)
        assert r.n == at.sum() and np.allclose(r.coef, c) and np.isclose(r.intercept, b)


def test_weights_null_keys_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(mo, "FLUSH_KEYS", 2)
    x, s, y = table()
    df = frame(spark, x, s, y).withColumns({"w": F.col("station") + 1.0, "name": F.when(F.col("station") > 0, F.concat(F.lit("s"), F.col("station")))})
    by = mo.read_moments(mo.moments(df, [*F_, "y"], ["name"], "w"), ["name"])
    assert len(by) == 4
    for (name,), m in by.items():
        at = s == (int(name[1:]) if name else 0)
        xy = np.column_stack([x, y])[at]
        assert m.n == at.sum() * (s[at][0] + 1) and np.allclose(m.mean, xy.mean(axis=0))
        assert np.allclose(m.comoment, (xy - xy.mean(axis=0)).T @ (xy - xy.mean(axis=0)) * (s[at][0] + 1))
    assert mo.moments(df.limit(0), F_, ["station"]).collect() == []


def test_prediction_uses_the_keys_model(spark):
    x, s, y = table(60, 2)
    df = frame(spark, x, s, y)
    models = mo.least_squares(df, F_, "y", 0.0, ["station"])
    for r in mo.linear_prediction(df, models, F_, ["station"]).collect():
        at = s == r.station
        c, b, _ = ridge(x[at], y[at], 0.0)
        assert np.isclose(r.pred, x[r.i] @ c + b)
    one = mo.linear_prediction(df, mo.least_squares(df, F_, "y"), F_).orderBy("i").first()
    c, b, _ = ridge(x, y, 0.0)
    assert np.isclose(one.pred, x[0] @ c + b)


def test_same_ridge_individual_and_pooled(spark):
    """Both sides against dense one-hot fits with the same folds and grid."""
    x, s, y = table(600, 3, seed=2)
    split = ["train" if i < 400 else "valid" if i < 500 else "test" for i in range(600)]
    k, alphas = 3, [0.1, 5.0, 200.0]
    df = frame(spark, x, s, y, split)
    got = {(r.station, r.scope, r.split): r for r in mo.group_search(df, "station", "ts", "split", F_, "y", alphas, k).collect()}
    assert len(got) == 3 * 3 * 2 + 3
    part = {name: np.array([v == name for v in split]) for name in ("train", "valid", "test")}
    block = np.full(600, -1)
    for g in range(3):
        at = np.flatnonzero(part["train"] & (s == g))
        size = len(at) // (k + 1)
        for j in range(k):
            block[at[len(at) - (k - j) * size: len(at) - (k - j - 1) * size]] = j + 1
        block[at[:len(at) - k * size]] = 0

    def best(design, rows):
        score = [np.mean([r2(y[rows & (block == j + 1)], design[rows & (block == j + 1)] @ c + b) for j in range(k)
                          for c, b, _ in [ridge(design[rows & (block >= 0) & (block <= j)], y[rows & (block >= 0) & (block <= j)], a)]]) for a in alphas]
        a = alphas[int(np.argmax(score))]
        return a, ridge(design[rows & part["train"]], y[rows & part["train"]], a)

    for g in range(3):
        a, (c, b, _) = best(x, s == g)
        for name, at in part.items():
            at = at & (s == g)
            r = got[g, "individual", name]
            assert r.alpha == a and r.n == at.sum() and np.isclose(r.r2, r2(y[at], x[at] @ c + b))
            assert np.isclose(r.rmse, np.sqrt(((y[at] - x[at] @ c - b) ** 2).mean()))
    hot = np.column_stack([x, *[(s == g).astype(float) for g in range(3)]])
    a, (c, b, _) = best(hot, np.ones(600, bool))
    for name, at in part.items():
        for g in (0, 1, 2, None):
            rows = at if g is None else at & (s == g)
            r = got[g, "pooled", name]
            assert r.alpha == a and r.n == rows.sum() and np.isclose(r.r2, r2(y[rows], hot[rows] @ c + b))


def plain_selection(x, y, order_end, inner, alpha, scale):
    """Tuning of the three selectors by refits on the rows: (selector, k) -> scores."""
    out = {}
    for end, a, b in mo.expanding_folds(order_end, inner):
        tx, ty, vx, vy = x[:end], y[:end], x[a:b], y[a:b]
        r = np.array([np.corrcoef(tx[:, j], ty)[0, 1] for j in range(D)])
        best = np.argsort(-(r * r / (1 - r * r)), kind="stable")
        weight = np.argsort(-np.abs(ridge(tx, ty, alpha, scale)[2]), kind="stable")
        kept, path = list(range(D)), {}
        while kept:
            path[len(kept)] = list(kept)
            kept.pop(int(np.argmin(np.abs(ridge(tx, ty, alpha, scale, kept)[2]))))
        for k in range(1, D + 1):
            for name, cols in (("select_k_best", sorted(best[:k])), ("select_from_model", sorted(weight[:k])), ("rfecv", path[k])):
                c, b0, _ = ridge(tx, ty, alpha, scale, cols)
                out.setdefault((name, k), []).append((vy, vx[:, cols] @ c + b0))
    return {key: (np.mean([r2(t, p) for t, p in v]), np.mean([np.abs(t - p).mean() for t, p in v]),
                  np.corrcoef(np.concatenate([t for t, _ in v]), np.concatenate([p for _, p in v]))[0, 1]) for key, v in out.items()}


def test_selection_equals_plain_refits(spark):
    x, s, y = table(500, 3, seed=5)
    found = mo.selection_study(frame(spark, x, s, y), F_, "y", ["ts", "i"], outer=3, inner=3, alpha=2.0)
    want = plain_selection(x, y, 500, 3, 2.0, x.std(axis=0))
    rows = found["tuning"].collect()
    assert len(rows) == 3 * D
    for r in rows:
        assert np.allclose((r.cv_r2, r.cv_mae, r.oof_corr), want[r.selector, r.n_features])
    assert sum(r.chosen for r in rows) == 3
    counts = {}
    for r in found["outer"].collect():
        end, a, b = mo.expanding_folds(500, 3)[r.fold]
        scale = x[:end].std(axis=0)
        inner = plain_selection(x, y, end, 3, 2.0, scale)
        size = (max(range(1, D + 1), key=lambda k: (inner["rfecv", k][0], -k)) if r.selector == "rfecv" else
                min(range(1, D + 1), key=lambda k: (-round(inner[r.selector, k][0], 4), round(inner[r.selector, k][1], 4),
                                                    -round(abs(inner[r.selector, k][2]), 4), k)))
        cols = [F_.index(f) for f in r.features.split(",")]
        assert r.n_features == size == len(cols)
        c, b0, _ = ridge(x[:end], y[:end], 2.0, scale, cols)
        p = x[a:b][:, cols] @ c + b0
        assert np.isclose(r.test_r2, r2(y[a:b], p)) and np.isclose(r.test_mae, np.abs(y[a:b] - p).mean())
        for f in r.features.split(","):
            counts[r.selector, f] = counts.get((r.selector, f), 0) + 1
    assert {(r.selector, r.feature): r.times_selected for r in found["frequency"].collect() if r.times_selected} == counts
    assert counts["rfecv", "f0"] == 3                                 # the column with the signal


def test_selection_of_few_or_no_rows(spark):
    x, s, y = table(3)
    found = mo.selection_study(frame(spark, x, s, y), F_, "y", ["ts", "i"])
    assert found["outer"].collect() == [] and found["frequency"].count() == 3 * D


def test_drop_one_verdicts(spark):
    x, s, y = table(900, 1, seed=3)
    a, b, c = (frame(spark, x[i:j], s[i:j], y[i:j]) for i, j in ((0, 500), (500, 700), (700, 900)))
    got = {r.feature: r for r in mo.drop_one(a, b, c, F_, "y", alpha=1.0).collect()}
    full, b0, _ = ridge(x[:500], y[:500], 1.0)
    base = y[700:] - x[700:] @ full - b0
    cols = [1, 2, 3, 4]
    w, w0, _ = ridge(x[:500], y[:500], 1.0, cols=cols)
    e = y[700:] - x[700:][:, cols] @ w - w0
    assert np.isclose(got["f0"].test_rmse_delta, np.sqrt((e * e).mean()) - np.sqrt((base * base).mean()))
    assert got["f0"].verdict == "keep" and got["f2"].verdict in ("remove", "consider")


def test_pair_correlations_on_pairwise_complete_rows(spark):
    import pandas as pd
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (300, 4)) + [1e6, 0, -5, 0]
    x[:, 1] += 0.5 * (x[:, 0] - 1e6)
    x[:, 3] = 7.1
    x[rng.random((300, 4)) < 0.2] = np.nan
    x[:290, 2][::2] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd"))
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x] + [(None,) * 4]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("e", F.lit(None).cast("int")).repartition(6)
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("a", "e")]
    got = {(r.variable_1, r.variable_2): r for r in mo.pair_correlations(df, pairs).collect()}
    for a, b in pairs[:3]:
        assert np.isclose(got[a, b].correlation, pdf[a].corr(pdf[b])) and got[a, b].n == pdf[[a, b]].notna().all(axis=1).sum()
    assert got["a", "d"].correlation is None and got["a", "d"].n > 100
    assert got["a", "e"].correlation is None and got["a", "e"].n == 0
    assert [r.correlation for r in mo.pair_correlations(df.limit(0), pairs).collect()] == [None] * 5


def test_elastic_net_meets_its_optimality_conditions():
    x, s, y = table(300)
    m = mo.Moment.of(np.column_stack([x, y]))
    sd = x.std(axis=0)
    z = (x - x.mean(axis=0)) / sd
    for alpha, share in ((0.05, 1.0), (0.5, 0.5), (3.0, 0.2), (1e6, 1.0)):
        f = mo.elastic_net(m, list(range(D)), D, alpha, share)
        w = f.scaled
        slope = z.T @ (y - y.mean() - z @ w) / len(y) - alpha * (1 - share) * w
        on = w != 0
        assert np.allclose(slope[on], alpha * share * np.sign(w[on]), atol=1e-8) and (np.abs(slope[~on]) <= alpha * share + 1e-8).all()
        assert np.isclose(f.intercept, y.mean() - f.coef @ x.mean(axis=0))
    assert not w.any()
    assert np.allclose(mo.elastic_net(m, [0, 1], D, 0.0, 0.5).coef, ridge(x, y, 0.0, cols=[0, 1])[0])


def test_model_space_with_weights_equals_plain_search(spark):
    x, s, y = table(600, 2, seed=9)
    split = ["train" if i < 400 else "valid" if i < 500 else "test" for i in range(600)]
    w = 1.0 + (np.arange(600) % 5)
    df = frame(spark, x, s, y, split).withColumns({"w": F.col("i") % 5 + 1.0, "y2": -F.col("y")})
    got = {(r.stage, r.target, r.model): r for r in mo.model_space_search(df, F_, ["y", "y2"], "split", ["ts", "i"], "w").collect()}
    assert len(got) == 2 * 4 + 2

    def wridge(rows, alpha):
        xs, ys, ws = x[rows], y[rows], w[rows]
        sd, mx, my = xs.std(axis=0), ws @ xs / ws.sum(), ws @ ys / ws.sum()
        z = (xs - mx) / sd
        b = np.linalg.solve((z * ws[:, None]).T @ z + alpha * np.eye(D), (z * ws[:, None]).T @ (ys - my)) / sd
        return b, my - b @ mx

    def score(rows, fit):
        return r2(y[rows], x[rows] @ fit[0] + fit[1])

    cv = {}
    for alpha in mo.PENALTIES:
        cv[alpha] = np.mean([score(np.arange(100 * j + 100, 100 * j + 200), wridge(np.arange(100 * j + 100), alpha)) for j in range(3)])
    alpha = max(cv, key=lambda a: (cv[a], -a))
    r = got["search", "y", "ridge"]
    fit = wridge(np.arange(400), alpha)
    assert r.params == json.dumps({"alpha": alpha}) and np.isclose(r.cv_r2, cv[alpha])
    assert np.isclose(r.train_R2, score(np.arange(400), fit)) and np.isclose(r.test_R2, score(np.arange(500, 600), fit))
    assert np.isclose(r.valid_test_gap, r.valid_R2 - r.test_R2)
    assert np.isclose(r.test_MAE, np.abs(y[500:] - x[500:] @ fit[0] - fit[1]).mean())
    best = max((v for key, v in got.items() if key[0] == "search" and key[1] == "y"), key=lambda v: v.valid_R2)
    sealed = next(v for key, v in got.items() if key[0] == "sealed" and key[1] == "y")
    assert sealed.model == best.model and sealed.valid_R2 is None and sealed.test_R2 > 0.5
    assert np.isclose(got["search", "y2", "ridge"].test_R2, r.test_R2)
