"""Scalar functions (2.X rules), profiles, diagnostics and models on fixtures."""

import datetime as dt
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stationflow.functions import timeparts as tp
from stationflow.operators import diagnose as dg
from stationflow.operators import models as md
from stationflow.operators import profiles as pf


def test_week_label_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 1),), (dt.date(2024, 12, 30),)], "d date")
    r = df.select(tp.week_start_w_mon("d").alias("w"), tp.iso_year_week("d").alias("iso")).collect()
    assert [x.w for x in r] == [dt.date(2024, 1, 2), dt.date(2023, 12, 26), dt.date(2024, 12, 24)]
    assert r[2].iso == "2025-01"


def test_parse_hhmm_and_date(spark):
    df = spark.createDataFrame([(20240105, "1735.0"), (20240105, "5.0"), (20240105, "2599.0"), (None, "1200")],
                               "d long, t string")
    r = df.select(tp.parse_date_hhmm("d", "t").alias("ts")).collect()
    assert r[0].ts == dt.datetime(2024, 1, 5, 17, 35) and r[1].ts == dt.datetime(2024, 1, 5, 0, 5)
    assert r[2].ts is None and r[3].ts is None


def test_departure_shift_equals_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 10), "arr", 25.5), (dt.datetime(2024, 1, 1, 1), "dep", 9.0)],
                               "ts timestamp_ntz, basis string, m double")
    r = df.select(tp.departure_ts("ts", "basis", "m").alias("d"), "ts", "basis", "m").collect()
    assert r[0].d == dt.datetime(2023, 12, 31, 23, 44, 30) and r[1].d == r[1].ts
    assert math.isclose(r[0].m, (r[0].ts - r[0].d).total_seconds() / 60)


def test_end_time_alignment(spark):
    df = spark.createDataFrame([(0, 30.0), (5, 400.0), (23, 0.0)], "h int, m double")
    r = df.select(tp.end_hour("h", "m").alias("eh"), tp.end_day_shift("h", "m").alias("sh")).collect()
    assert [(x.eh, x.sh) for x in r] == [(23, -1), (22, -1), (23, 0)]


def test_extract_dong_and_safe_ratio(spark):
    df = spark.createDataFrame([("서울 마포구 합정동 1", None, 1.0, 0.0), (None, "서교동 3", 2.0, 4.0),
                                ("없음", "없음", None, 1.0)], "a string, b string, x double, y double")
    r = df.select(tp.extract_dong("a", "b").alias("d"), tp.safe_ratio("x", "y").alias("q")).collect()
    assert [x.d for x in r] == ["합정동", "서교동", None] and [x.q for x in r] == [0.0, 0.5, 0.0]


def test_cosine_zero_norm_and_similar_week_greedy(spark):
    rows = [("A", w, s, float(v)) for w, vec in (("w1", [1, 2, 3]), ("w2", [2, 4, 6]), ("w3", [0, 0, 0]),
                                                 ("w4", [3, 2, 1])) for s, v in enumerate(vec)]
    df = spark.createDataFrame(rows, "station_id string, week string, slot int, value double")
    p = {(r.item_a, r.item_b): r.cosine for r in pf.pair_similarity(df, ["station_id"], "week").collect()}
    assert math.isclose(p[("w1", "w2")], 1.0) and p[("w1", "w3")] == 0.0
    drop = pf.similar_weeks_to_drop(pf.pair_similarity(df, ["station_id"], "week"), 0.99).collect()
    assert [(r.removed, r.kept) for r in drop] == [("w2", "w1")]


def test_ward_labels_two_obvious_groups():
    x = np.array([[0.0, 0.0], [0.1, 0.0], [10.0, 10.0], [10.1, 10.0], [0.0, 0.2]])
    assert list(pf.ward_labels(x, 2)) == [1, 1, 2, 2, 1]


def test_silhouette_matches_formula(spark):
    rows = [("S", m, 0, v) for m, v in ((1, 0.0), (2, 1.0), (3, 10.0), (4, 12.0))]
    prof = spark.createDataFrame(rows, "g string, month int, slot int, value double")
    lab = spark.createDataFrame([("S", 1, 1), ("S", 2, 1), ("S", 3, 2), ("S", 4, 2)], "g string, month int, cluster int")
    got = pf.silhouette(prof, lab, ["g"], "month").first().silhouette
    pts = {1: 0.0, 2: 1.0, 3: 10.0, 4: 12.0}
    cl = {1: 1, 2: 1, 3: 2, 4: 2}
    s = []
    for i in pts:
        a = np.mean([abs(pts[i] - pts[j]) for j in pts if j != i and cl[j] == cl[i]])
        b = np.mean([abs(pts[i] - pts[j]) for j in pts if cl[j] != cl[i]])
        s.append((b - a) / max(a, b))
    assert math.isclose(got, float(np.mean(s)), rel_tol=1e-12)


def test_profile_skew_and_spearman(spark):
    rng = np.random.default_rng(0)
    x = rng.exponential(2.0, 200)
    y = x ** 2 + rng.normal(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    prof = dg.feature_profile(df, ["x"], "y").first()
    n = len(x)
    m2, m3 = np.mean((x - x.mean()) ** 2), np.mean((x - x.mean()) ** 3)
    assert math.isclose(prof.skew, m3 / m2 ** 1.5 * math.sqrt(n * (n - 1)) / (n - 2), rel_tol=1e-9)
    sp = dg.spearman(df, ["x"], "y").first().spearman
    rx, ry = x.argsort().argsort(), y.argsort().argsort()
    assert math.isclose(sp, float(np.corrcoef(rx, ry)[0, 1]), rel_tol=1e-9)


def test_ridge_regparam_reproduces_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3)) * [1.0, 5.0, 0.3]
    y = x @ [1.5, -0.4, 2.0] + rng.normal(0, 0.5, 60) + 3.0
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)], "a double, b double, c double, y double")
    alpha = 5.0
    m = md.fit(df, ["a", "b", "c"], "y", "ridge", scale=False, alpha=alpha, standardization=True)
    mu, sd = x.mean(0), x.std(0)
    z = (x - mu) / sd
    w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean())) / sd
    assert np.allclose(m.stages[-1].coefficients.toArray(), w, rtol=1e-5, atol=1e-6)
    coefs = md.per_group_ridge(df.withColumn("g", F.lit("G")), "g", ["a", "b", "c"], "y", alpha).first()
    assert np.allclose(coefs.coef, w, rtol=1e-9)


def test_log_target_and_capacity_clip(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), 3) for i in range(40)], "x double, y double, cap int")
    m = md.fit(df, ["x"], "y", "linear", log_target=True)
    p = md.predict(m, df, log_target=True, cap="cap").collect()
    assert all(0.0 <= r.pred <= 3.0 for r in p)


def test_random_grid_seeded():
    a = md.random_grid({"regParam": (0.001, 1.0), "k": [1, 2]}, 4, seed=3)
    assert a == md.random_grid({"regParam": (0.001, 1.0), "k": [1, 2]}, 4, seed=3)
    assert all(0.001 <= d["regParam"] <= 1.0 for d in a)


def test_recursive_projection_feeds_own_predictions(spark):
    from pyspark.sql import Window
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(hours=h), float(h + 10 * i)) for i, s in enumerate(["A", "B"]) for h in range(48)]
    hist = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, y double")

    def feats(frame):
        return frame.withColumn("lag1", F.lag("y", 1).over(Window.partitionBy("station_id").orderBy("ts")))

    m = md.fit(feats(hist).na.drop(), ["lag1"], "y", "linear", scale=False)
    out = md.recursive_projection(m, hist, "2024-01-03 00:00:00", 3, "station_id", "ts", "y", [1], feats)
    got = {(r.station_id, r.step): round(r.y, 6) for r in out.collect()}
    assert got == {("A", 1): 48.0, ("A", 2): 49.0, ("A", 3): 50.0, ("B", 1): 58.0, ("B", 2): 59.0, ("B", 3): 60.0}


def test_week_weights_formula(spark):
    base = dt.datetime(2024, 1, 1)  # ISO week 1 starts on this Monday
    rows = [("A", base + dt.timedelta(hours=h), 1 if h < 168 else 3) for h in range(336)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, total_flow long")
    w = {r.year_week: r.week_weight for r in pf.week_weights(df, "total_flow").collect()}
    mean = (168 + 504) / 2
    assert math.isclose(w["2024-01"], math.exp(math.log1p(168) - math.log1p(mean)))
    assert math.isclose(w["2024-02"], math.exp(math.log1p(504) - math.log1p(mean)))
    sw = pf.sample_weight(df.limit(1), pf.week_weights(df, "total_flow").filter("year_week = '2024-02'")).first()
    assert sw.week_weight == 1.0 and sw.sample_weight == 1.0  # missing week -> 1


def test_binned_mutual_information_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, 400).astype(float)
    y = (x + rng.integers(0, 2, 400)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    lg = dg.to_long(df, ["x"], "y").filter("transform = 'raw'")
    got = dg.binned_mutual_information(lg, bins=4).first().mi

    def bins(v, q):
        edges = np.unique(np.quantile(v, np.linspace(0, 1, q + 1)))
        return np.minimum((v[:, None] > edges[None, 1:]).sum(1), len(edges) - 2)

    bx, by = bins(x, 4), bins(y, 4)
    mi = 0.0
    for a in np.unique(bx):
        for b in np.unique(by):
            pxy = np.mean((bx == a) & (by == b))
            if pxy > 0:
                mi += pxy * math.log(pxy / (np.mean(bx == a) * np.mean(by == b)))
    assert math.isclose(got, mi, rel_tol=1e-9)


def test_transform_choice_by_folds_matches_least_squares(spark):
    rng = np.random.default_rng(4)
    n = 143
    x = rng.normal(size=n).round(3)
    y = (2 + x - 1.5 * x * x + rng.normal(scale=0.3, size=n)).round(3)
    gone = set(range(5, n, 17))                                  # incomplete rows shift the folds
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=20 * i), None if i in gone else float(x[i]), float(y[i]), 7.0)
            for i in range(n)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, x double, y double, flat double")
    got = {(r.feature, r.transform): r for r in dg.cv_transform_choice(
        dg.feature_blocks(df, ["x", "flat"], "y", ["ts", "id"])).collect()}
    keep = [i for i in range(n) if i not in gone]
    for name, cols in {"raw": lambda v: [v], "log": lambda v: [np.log1p(np.maximum(v, 0))], "poly": lambda v: [v, v * v]}.items():
        v, t = x[keep], y[keep]
        size = len(v) // 6
        r2, mae, every, truth = [], [], [], []
        for k in range(5):
            a = len(v) - (5 - k) * size
            A = np.column_stack([np.ones(len(v)), *cols(v)])
            p = A[a:a + size] @ np.linalg.lstsq(A[:a], t[:a], rcond=None)[0]
            e = t[a:a + size] - p
            r2.append(1 - (e @ e) / ((t[a:a + size] - t[a:a + size].mean()) ** 2).sum())
            mae.append(np.abs(e).mean())
            every += list(p)
            truth += list(t[a:a + size])
        r = got["x", name]
        assert np.allclose([r.r2, r.r2_std, r.mae, r.mae_std, r.oof_corr],
                           [np.mean(r2), np.std(r2), np.mean(mae), np.std(mae), np.corrcoef(every, truth)[0, 1]], atol=1e-9)
    assert got["x", "poly"].rank == 1 and got["flat", "raw"].rank == 1


def test_transform_comparison_skips_log_of_negative_values(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(-3, 3, 400)
    df = spark.createDataFrame([(float(v), float(v * v), abs(float(v)), float(i)) for i, v in enumerate(x)],
                               "bend double, y double, size double, noise double")
    got = {r.feature: r for r in dg.transform_comparison(df, ["bend", "size", "noise"], "y").collect()}
    assert got["bend"].log_mi is None and got["bend"].log_abs_corr is None and got["size"].log_mi is not None
    assert got["bend"].poly_abs_corr > 0.999 and got["bend"].best_transform == "poly"
    few = df.limit(29)
    assert dg.transform_comparison(few, ["bend"], "y").count() == 0


def test_exact_percentiles_equal_numpy(spark):
    from stationflow.operators.splits import exact_percentiles
    rng = np.random.default_rng(8)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [(None, float(v)) for v in rng.integers(0, 4, 50)] \
        + [("one", 3.5), ("gone", None), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.k: r.percentiles for r in exact_percentiles(df, "v", probs, ["k"]).collect()}
    assert set(got) == {"hot", None, "one"}
    for k in got:
        assert np.allclose(got[k], np.quantile([v for a, v in rows if a == k and v is not None], probs))
    all_values = [v for _, v in rows if v is not None]
    assert np.allclose(exact_percentiles(df, "v", probs).first()[0], np.quantile(all_values, probs))
    assert exact_percentiles(df.limit(0), "v", probs).count() == 0


def test_week_removal_equals_the_sequential_rule(spark):
    import random
    rng = random.Random(6)
    for _ in range(3):
        pairs = [(f"S{rng.randint(0, 2)}", a, b, rng.choice([0.9, 0.95, 0.97, rng.random()])) for a in range(14) for b in range(a + 1, 14) for _ in range(2)]
        df = spark.createDataFrame(pairs, "station_id string, item_a int, item_b int, cosine double")
        best = {}
        for s, a, b, c in pairs:
            best[a, b] = max(best.get((a, b), (0, "")), (c, s))
        gone, want = set(), {}
        for (a, b), (c, s) in sorted(best.items(), key=lambda t: (-round(t[1][0], 9), t[0])):
            if c >= 0.85 and not {a, b} & gone:
                gone.add(b)
                want[b] = (a, c, s)
        got = {r.removed: (r.kept, r.sim, r.station_id) for r in pf.similar_weeks_to_drop(df, 0.85).collect()}
        assert got == want


def test_fixed_month_folds_and_a_fold_without_validation(spark):
    from stationflow.operators import splits
    df = spark.sql("SELECT explode(sequence(date'2023-12-01', date'2024-09-30')) AS day")
    got = {(r.fold, r.role): (r.a, r.b) for r in splits.fixed_month_folds(df, "day", 2024).groupBy("fold", "role")
           .agg(F.min(F.month("day")).alias("a"), F.max(F.month("day")).alias("b")).collect()}
    assert got == {(1, "train"): (1, 3), (1, "valid"): (4, 5), (2, "train"): (1, 5), (2, "valid"): (6, 7), (3, "train"): (1, 7), (3, "valid"): (8, 9)}


def counted(df):
    """``df`` through a task that counts its rows, and the count of all its runs."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


def test_kmeans_computes_its_rows_once(spark):
    from stationflow.operators.profiles import kmeans_profiles
    rows = [(i, float(i % 3 * 100 + i % 2), float(i % 3 * 50)) for i in range(30)]
    df, seen = counted(spark.createDataFrame(rows, "id int, a double, b double"))
    got = {r.id: r.cluster for r in kmeans_profiles(df, ["a", "b"], k=3).collect()}
    assert len(set(got.values())) == 3 and all(got[i] == got[i % 3] for i in got)
    assert seen.value == 30


def test_od_daily_shuffles_line_items_once(spark, tmp_path, monkeypatch):
    from stationflow.sources import adapter
    od_daily = adapter.od_daily
    day = dt.datetime(2024, 1, 5)
    spark.createDataFrame([(1, 7, 1, 2.0, 10.0, 0.5, day), (1, 7, 2, 3.0, 11.0, 0.5, day), (2, 8, 1, 4.0, 12.0, 0.5, day), (None, 7, 1, 5.0, 13.0, 0.5, day),
                           (3, 7, 1, 6.0, 14.0, 0.5, day), (1, None, 3, 7.0, 15.0, 0.5, day), (4, 9, 1, 8.0, 16.0, 0.5, day)],
                          "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, 6), (2, 5), (3, None), (4, 5), (None, 5)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5, 20), (6, 21), (6, 22), (None, 1)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(7, 3), (8, 4), (None, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    small = sorted(tuple(r) for r in od_daily(spark, str(tmp_path)).select("order_id", "line", "start_id", "end_id", "cnt").collect())
    monkeypatch.setattr(adapter, "FEW_ORDERS", 2)
    try:
        df = od_daily(spark, str(tmp_path)).select("order_id", "line", "start_id", "end_id", "cnt")
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == small == [(1, 1, "ST-3", "ST-20", 2.0), (1, 2, "ST-3", "ST-20", 3.0), (2, 1, "ST-4", "ST-20", 4.0), (2, 1, "ST-4", "ST-21", 4.0), (2, 1, "ST-4", "ST-22", 4.0)]
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)
    assert sorted(shuffles) == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]


def test_describe_computes_its_rows_once(spark):
    from stationflow.operators.flow import describe
    rng = np.random.default_rng(4)
    x = rng.normal(size=2000)
    df, seen = counted(spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)] + [(0, None), (None, 1.5)], "k int, v double"))
    got = {r.k: r for r in describe(df, "v", keys=["k"]).collect()}
    assert seen.value == 2002 and set(got) == {0, 1, None}
    for k in (0, 1):
        assert got[k]["count"] == 1000 and got[k].min == x[k::2].min() and got[k].max == x[k::2].max()
        assert np.allclose([got[k][c] for c in ("p50", "p90", "p95", "p99")], np.quantile(x[k::2], [0.5, 0.9, 0.95, 0.99]))


def test_percentiles_shuffle_only_values_near_them(spark, monkeypatch):
    from stationflow.operators import splits
    from stationflow.util import cut_lineage
    x = np.random.default_rng(5).permutation(200_000) / 7.0
    df = cut_lineage(spark.createDataFrame(pd.DataFrame({"v": x})))
    probs = [0.0, 0.25, 0.5, 1.0]
    near, calls = splits._values_near, []

    def kept(*args):
        calls.append(near(*args))
        return calls[-1]

    monkeypatch.setattr(splits, "_values_near", kept)
    got = splits.exact_percentiles(df, "v", probs, written=True).first()[0]
    assert np.allclose(got, np.quantile(x, probs), rtol=1e-15)
    assert len(calls) == 1 and calls[0][1].count() < 4 * 6 / splits.SKETCH * 200_000


def test_percentiles_hold_where_the_sketch_misleads(spark, monkeypatch):
    from stationflow.operators import splits
    near, margins = splits._values_near, []

    def misled(rows, probs, keys, margin):
        margins.append(margin)
        return near(rows, probs if margin is None else [0.9] * len(probs), keys, margin)

    monkeypatch.setattr(splits, "_values_near", misled)
    nan, inf = float("nan"), float("inf")
    rows = [("a", float(i)) for i in range(3001)] + [("b", -inf), ("b", 2.0), ("b", nan), ("c", nan), (None, inf)]
    got = {r.k: r.p for r in splits.exact_percentiles(spark.createDataFrame(rows, "k string, v double"), "v", [0.0, 0.5, 1.0], ["k"], "p").collect()}
    assert len(margins) == 2 and margins[1] is None
    assert got["a"] == [0.0, 1500.0, 3000.0] and got["b"][:2] == [-inf, 2.0] and np.isnan(got["b"][2])
    assert np.isnan(got["c"]).all() and got[None] == [inf] * 3


def test_quantile_bins_compute_their_rows_once(spark):
    from stationflow.operators.windows import quantile_bins
    x = np.random.default_rng(6).normal(size=1000)
    df, seen = counted(spark.createDataFrame([(float(v), float(i % 9)) for i, v in enumerate(x)] + [(None, 4.0)], "v double, w double"))
    got = {r.bin: r for r in quantile_bins(df, "v", 4, value="w").collect()}
    assert seen.value == 1001 and set(got) == {0, 1, 2, 3, None}
    bins = pd.qcut(x, 4, labels=False)
    for b in range(4):
        w = (np.arange(1000) % 9)[bins == b]
        assert got[b].n == len(w) and got[b].median == np.median(w) and np.isclose(got[b]["mean"], w.mean())
    assert (got[None].n, got[None].median) == (1, 4.0)


def test_percentiles_by_counted_cells(spark, monkeypatch):
    """Where values spread, no pass feeds a sketch, and rows meet their group's bounds by a hash."""
    from stationflow.operators import splits
    from stationflow.util import cut_lineage
    x = np.random.default_rng(6).uniform(900, 100_000, 30_000)
    df = cut_lineage(spark.createDataFrame(pd.DataFrame({"k": [f"ST-{i % 3}" for i in range(len(x))], "_v": x})))
    plans = []

    def kept(d):
        plans.append(d._jdf.queryExecution().optimizedPlan().toString())
        return cut_lineage(d)

    monkeypatch.setattr(splits, "cut_lineage", kept)
    bounds, near = splits._values_near(df, [0.5, 0.99], ["k"], 3 / splits.SKETCH)
    assert plans and not any("percentile_approx" in p or "<=>" in p for p in plans)
    assert near.count() < 2 * 3 * 2 * 3 / splits.CELLS * 10_000 and bounds.count() == 3
    monkeypatch.undo()
    got = {r.k: r.p for r in splits.exact_percentiles(df, "_v", [0.5, 0.99], ["k"], "p").collect()}
    assert all(np.allclose(got[f"ST-{i}"], np.quantile(x[i::3], [0.5, 0.99]), rtol=1e-15) for i in range(3))


def test_percentiles_of_odd_groups(spark):
    from stationflow.operators import splits
    rng = np.random.default_rng(8)
    groups = {("a", None): np.exp(rng.normal(size=4000) * 20), (None, "a"): np.array([1e308, -1e308, 0.0, 5e-324, -0.0, 7.0]),
              (None, None): np.array([3.25] * 50 + [4.0]), ("b", "c"): np.array([-5.0]), ("c", "b"): 1.7e9 + rng.random(3000)}
    probs = [0.9, 0.0, 0.333, 1.0]
    df = spark.createDataFrame([(*k, float(v)) for k, x in groups.items() for v in x] + [("d", "d", None)], "a string, b string, v double")
    got = {(r.a, r.b): r.p for r in splits.exact_percentiles(df, "v", probs, ["a", "b"], "p").collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        at, s = np.array(probs) * (len(x) - 1), np.sort(x)
        lo, hi = s[np.floor(at).astype(int)], s[np.ceil(at).astype(int)]
        want = np.where(lo == hi, lo, (np.ceil(at) - at) * lo + (at - np.floor(at)) * hi)
        assert np.allclose(got[k], want, rtol=1e-12, atol=0)
    rows = df.filter("a = 'a' AND b IS NULL").select(F.col("v").alias("_v"))
    assert splits._bounds_by_cells(rows, probs, []) is None          # nearly all values in one cell
