"""Spatial joins vs brute force; splits are disjoint, complete and time-ordered;
metrics vs direct formulas."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from stationflow.operators import evaluate as ev
from stationflow.operators import spatial, splits


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(x))


def _points(spark, n, seed, prefix, spread):
    rng = random.Random(seed)
    rows = [(f"{prefix}{i}", 37.5 + rng.uniform(-spread, spread), 127.0 + rng.uniform(-spread, spread))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, lat double, lon double")


def test_within_radius_equals_brute_force(spark):
    L, ldf = _points(spark, 80, 1, "s", 0.02)
    R, rdf = _points(spark, 60, 2, "p", 0.02)
    got = {(r.id, r.pid) for r in spatial.within_radius(
        ldf, rdf.withColumnRenamed("id", "pid"), 500.0, "id", "pid").collect()}
    want = {(a[0], b[0]) for a in L for b in R if hav(a[1], a[2], b[1], b[2]) <= 500.0}
    assert got == want and len(want) > 0


def test_within_radius_holds_on_the_whole_globe(spark):
    """Near the poles, on both sides of longitude 180, at band edges and with wide radii."""
    rng = random.Random(8)
    base = [(80.0, 20.0), (89.9995, 10.0), (-89.9995, -170.0), (90.0, 0.0), (0.0, 180.0), (60.0, -179.9999),
            (-45.0, 179.9999), (0.0, 0.0), (71.0, 5.0)]

    def near(prefix):
        out = []
        for k, (la, lo) in enumerate(base):
            for i in range(8):
                d = rng.uniform(-0.002, 0.002)
                la2 = max(-90.0, min(90.0, la + d))
                lo2 = lo + rng.uniform(-0.003, 0.003) / max(math.cos(math.radians(la2)), 0.01)
                out.append((f"{prefix}{k}-{i}", la2, (lo2 + 180) % 360 - 180))
        return out
    L, R = near("s") + [("e", 0.0, 179.9999)], near("p") + [("f", 0.0, -179.9999), ("g", 0.0, 180.0)]
    ldf = spark.createDataFrame(L, "id string, lat double, lon double")
    rdf = spark.createDataFrame(R, "pid string, lat double, lon double")
    for radius in (25.0, 200.0, 3_000_000.0, 25_000_000.0):
        rows = spatial.within_radius(ldf, rdf, radius, "id", "pid").select("id", "pid").collect()
        want = {(a[0], b[0]) for a in L for b in R if hav(a[1], a[2], b[1], b[2]) <= radius}
        assert len(rows) == len(want) and {tuple(r) for r in rows} == want


def test_nearest_equals_brute_force_including_far_points(spark):
    L, ldf = _points(spark, 30, 3, "s", 0.5)
    R = [("p0", 37.5, 127.0), ("p1", 35.1, 129.0), ("p2", -33.9, 151.2)]  # one far away, one on another continent
    rdf = spark.createDataFrame(R, "pid string, lat double, lon double")
    got = {r.id: r.pid for r in spatial.nearest(ldf, rdf, "id", "pid").collect()}
    want = {a[0]: min(R, key=lambda b: (hav(a[1], a[2], b[1], b[2]), b[0]))[0] for a in L}
    assert got == want
    lone = spark.createDataFrame([("x", -33.0, 150.0)], "id string, lat double, lon double")
    assert spatial.nearest(lone, rdf.filter("pid != 'p2'"), "id", "pid").first().pid == "p1"


def test_convex_hull_square(spark):
    pts = [(1, 0.0, 0.0), (1, 0.0, 1.0), (1, 1.0, 0.0), (1, 1.0, 1.0), (1, 0.5, 0.5), (2, 0.0, 0.0), (2, 1.0, 1.0)]
    df = spark.createDataFrame(pts, "cluster int, lat double, lon double")
    h = spatial.convex_hulls(df).collect()
    assert sum(1 for r in h if r.cluster == 1) == 4 and {r.kind for r in h if r.cluster == 2} == {"line"}


def test_substring_match_first_registry_hit(spark):
    left = spark.createDataFrame([("a", "합정동"), ("b", "ST-48")], "k string, txt string")
    reg = spark.createDataFrame([(2, "마포구 합정동 1"), (1, "서울 합정동"), (3, "ST-481 x"), (4, "ST-48 y")],
                                "ord int, rtxt string")
    got = {r.k: r.ord for r in spatial.substring_match(left, reg, "txt", "rtxt", "ord").collect()}
    assert got == {"a": 1, "b": 3}


def _times(spark, n=500):
    rng = random.Random(11)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 10))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, ts timestamp_ntz")


def test_global_position_equals_sorted_index(spark):
    rows, df = _times(spark)
    got = {r.id: r._pos for r in splits.global_position(df, ["ts", "id"]).collect()}
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == want


def test_ratio_split_disjoint_complete_ordered(spark):
    rows, df = _times(spark)
    s = splits.split_by_ratio(df, ["ts", "id"], (0.7, 0.15), ("train", "valid", "test")).collect()
    assert len(s) == len(rows)
    by = {}
    for r in s:
        by.setdefault(r.split, []).append(r.ts)
    assert len(by["train"]) == int(500 * 0.7) and len(by["valid"]) == int(500 * 0.85) - int(500 * 0.7)
    assert max(by["train"]) <= min(by["valid"]) and max(by["valid"]) <= min(by["test"])


def test_ts_folds_match_timeseriessplit_rule(spark):
    rows, df = _times(spark, 100)
    f = splits.ts_fold_labels(df, ["ts", "id"], k=4, gap=3).collect()
    order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
    pos = {i: p for p, i in enumerate(order)}
    size = 100 // 5
    for k in range(4):
        start = 100 - (4 - k) * size
        test = {r.id for r in f if r.fold == k and r.role == "test"}
        train = {r.id for r in f if r.fold == k and r.role == "train"}
        assert test == {i for i in pos if start <= pos[i] < start + size}
        assert train == {i for i in pos if pos[i] < start - 3}


def test_within_group_split_keeps_both_sides(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "g string, t int")
    s = {(r.g, r.t): r.split for r in splits.split_within_groups(df, ["g"], ["t"], 0.7).collect()}
    assert s[("A", 1)] == "train" and s[("A", 2)] == "test"


def test_permute_column_is_a_permutation(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") * 3).alias("v"))
    p = splits.permute_column(df, "v", ["id"], seed=1).collect()
    assert sorted(r.v for r in p) == [i * 3 for i in range(200)] and len({r.id for r in p}) == 200
    assert sum(1 for r in p if r.v == 3 * r.id) < 20


def test_auc_matches_pairwise_count(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 6))) for _ in range(300)]  # many ties
    df = spark.createDataFrame(rows, "label int, prob double")
    got = ev.roc_auc(df).first().auc
    pos = [p for l, p in rows if l == 1]
    neg = [p for l, p in rows if l == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
    assert math.isclose(got, want, rel_tol=1e-12)


def test_r2_zero_variance_parameter_and_zero_division(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, pred double")
    assert ev.regression_metrics(df, zero_variance_r2=1.0).first().r2 == 1.0
    assert ev.regression_metrics(df).first().r2 == 0.0
    c = spark.createDataFrame([(1, 0), (0, 0)], "label int, pred_label int")
    m = ev.classification_metrics(c).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_running_total_before_many_values_per_bucket(spark):
    rng = random.Random(21)
    rows = [(k, float(v), rng.randint(1, 5)) for k in ("a", "b") for v in rng.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "k string, v double, w int")
    got = {(r.k, r.v): r._before for r in splits.running_total_before(df, "v", "w", ["k"], buckets=16).collect()}
    for k in ("a", "b"):
        acc = 0
        for _, v, w in sorted(r for r in rows if r[0] == k):
            assert got[(k, v)] == acc
            acc += w
    g2 = splits.running_total_before(df.filter("k = 'a'"), "v", "w", buckets=8).agg(F.max("_before")).first()[0]
    assert g2 == sum(w for k, _, w in rows if k == "a") - max(((v, w) for k, v, w in rows if k == "a"))[1]


def test_substring_match_finds_texts_shorter_than_a_gram(spark):
    from stationflow.operators.spatial import substring_match
    left = spark.createDataFrame([("합정",), ("a",), ("없음",)], "t string")
    reg = spark.createDataFrame([(2, "서울 합정동"), (1, "xax"), (3, "합정")], "id int, name string")
    got = {r.t: r.id for r in substring_match(left, reg, "t", "name", "id").collect()}
    assert got == {"합정": 2, "a": 1}


def test_one_hot_hour_is_cut_into_bounded_ranges(spark):
    """All rows in one hour: no range above the bound, positions still exact."""
    df = spark.range(5000).select(F.col("id"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts")).repartition(3)
    found, ranges = splits.ordered_ranges(df, ["ts", "id"], rows=400)
    assert ranges.agg(F.max("_c"), F.sum("_c")).first() == (max(r._c for r in ranges.collect()), 5000)
    assert max(r._c for r in ranges.collect()) <= 400
    assert {r.id: r._pos for r in splits.global_position(df, ["ts", "id"], rows=400).collect()} == {i: i for i in range(5000)}
    same, ranges = splits.ordered_ranges(df, ["ts"], rows=400)          # equal keys can't be cut
    assert sorted(r._at for r in same.collect())[-1] == 4999 and ranges.first()._n == 5000
    assert splits.global_position(df.limit(0), ["ts", "id"]).collect() == []


def test_shuffles_are_cycles_of_one_random_order(spark, monkeypatch):
    monkeypatch.setattr(splits, "RANGE_ROWS", 20)
    df = spark.range(300).select("id", (F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("s"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    got = splits.shuffled_columns(df.repartition(5), ["v", "s", "n"], ["id"], repeats=3, seed=9).collect()
    assert sorted(r.id for r in got) == list(range(300))
    step = {r.id: int(r["s__shuffled1"]) for r in got}
    for r in got:
        at = r.id
        for k in (1, 2, 3):
            at = step[at]
            assert (r[f"v__shuffled{k}"], int(r[f"s__shuffled{k}"]), r[f"n__shuffled{k}"]) == (2 * at, at, at if at % 7 else None)
    seen, at = set(), 0
    while at not in seen:
        seen.add(at)
        at = step[at]
    assert len(seen) == 300                                            # one cycle over all rows
    again = splits.shuffled_columns(df.repartition(2), ["v"], ["id"], seed=9).collect()
    assert {r.id: r["v__shuffled1"] for r in again} == {i: 2 * t for i, t in step.items()}
    tiny = splits.shuffled_columns(df.limit(2), ["v"], ["id"], repeats=3).collect()
    assert all(r["v__shuffled2"] == r.v and r["v__shuffled1"] == r["v__shuffled3"] != r.v for r in tiny)


def test_seeded_sample_is_stable_and_exact(spark):
    df = spark.range(4000)
    a = {r.id for r in splits.seeded_sample(df.repartition(7), ["id"], 100, seed=3).collect()}
    b = {r.id for r in splits.seeded_sample(df, ["id"], 100, seed=3).collect()}
    want = {r.id for r in df.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(100).collect()}
    assert a == b == want and splits.seeded_sample(df, ["id"], 9999).count() == 4000 and splits.seeded_sample(df, ["id"], 0).count() == 0


def test_permutation_importance_ranks_the_signal(spark):
    from stationflow.operators import models as md
    rng = random.Random(2)
    rows = [(i, float(rng.gauss(0, 1)), float(rng.gauss(0, 1)), float(rng.gauss(0, 1))) for i in range(600)]
    df = spark.createDataFrame([(i, a, b, c, 3 * a + 0.5 * b) for i, a, b, c in rows], "id long, a double, b double, c double, y double")
    m = md.fit(df, ["a", "b", "c"], "y", "linear")
    got = {r.feature: r for r in md.permutation_importance(m, df, ["a", "b", "c"], "y", ["id"], repeats=4).collect()}
    assert got["a"].importance_mean > 1.5 > got["b"].importance_mean > 0.01 > abs(got["c"].importance_mean) and got["a"].importance_std > 0


def test_nearest_by_pyramid_on_the_whole_globe(spark):
    """Random globe, poles, both sides of longitude 180, a hot place, one far dense town; per month."""
    rng = random.Random(21)
    base = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    base += [(90.0, 0.0), (-90.0, 10.0), (89.99, -170.0), (0.0, 180.0), (0.0, -180.0), (10.0, 179.999), (10.0, -179.999)]
    town = [(51.5 + rng.uniform(-0.01, 0.01), -0.1 + rng.uniform(-0.01, 0.01)) for _ in range(120)]
    L = [(f"s{i}", m, la, lo) for i, (la, lo) in enumerate(base) for m in (1, 2)] + [("none", 1, None, 3.0), ("alone", 9, 1.0, 1.0)]
    R = [(f"p{i:03}", 1, la + rng.uniform(-1, 1) * (abs(la) < 80), lo) for i, (la, lo) in enumerate(base[::2])]
    R += [(f"t{i:03}", 2, la, lo) for i, (la, lo) in enumerate(town)] + [(f"h{i:03}", 1, 20.0, 20.0) for i in range(50)] + [("q", 2, None, None)]
    ldf = spark.createDataFrame(L, "id string, m int, lat double, lon double").withColumn("x", F.lit(1))
    rdf = spark.createDataFrame(R, "pid string, m int, lat double, lon double").withColumn("kind", F.lit("k"))
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        rows = spatial.nearest(ldf, rdf, "id", "pid", by=("m",)).collect()
        assert rows[0].asDict().keys() == {"id", "m", "lat", "lon", "x", "pid", "kind", "r_lat", "r_lon", "dist_m"}
        assert len(rows) == 2 * len(base)
        for r in rows:
            want = min((hav(r.lat, r.lon, la, lo), p) for p, m, la, lo in R if m == r.m and la is not None)
            assert math.isclose(r.dist_m, want[0], abs_tol=1e-5)
            assert r.pid == want[1] or math.isclose(hav(r.lat, r.lon, r.r_lat, r.r_lon), want[0], abs_tol=1e-5)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spatial.nearest(ldf, rdf.limit(0), "id", "pid").collect() == []


def test_substring_match_in_one_city(spark):
    """All addresses share the city's grams: a text is looked up by its rarest one."""
    reg = [(i, f"서울특별시 마포구 {chr(0xAC00 + 37 * i)}{chr(0xAC00 + 91 * i)}동 {i}") for i in range(120)] + [(500, "서울특별시 마포구")]
    rdf = spark.createDataFrame(reg, "ord int, name string")
    texts = [f"{chr(0xAC00 + 37 * i)}{chr(0xAC00 + 91 * i)}동" for i in range(0, 120, 3)] + ["서울특별시 마포구", "마포구 없는동", "", "동 7", None, "동 7"]
    left = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.ord for r in spatial.substring_match(left, rdf, "t", "name", "ord").collect()}
    assert got == {i: next(o for o, n in reg if t in n) for i, t in enumerate(texts) if t and any(t in n for _, n in reg)}


def test_hull_of_hulls(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_HULL_BUFFER", 8)
    rng = random.Random(5)
    rows = [(c, rng.randint(0, 30) / 2, rng.randint(0, 30) / 2) for c in (1, 2) for _ in range(400)] + [(3, 1.0, float(i)) for i in range(9)]
    rows += [(4, 5.0, 5.0)] * 3 + [(5, None, 1.0)] + [(6, 2.0, 2.0), (6, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "cluster int, lat double, lon double").repartition(9)
    got = {}
    for r in spatial.convex_hulls(df).orderBy("cluster", "vertex").collect():
        got.setdefault(r.cluster, []).append((r.lon, r.lat, r.kind))
    assert {c: v[0][2] for c, v in got.items()} == {1: "polygon", 2: "polygon", 3: "line", 4: "point", 6: "line"}
    for c in (1, 2):
        pts, v = {(lo, la) for k, la, lo in rows if k == c}, [p[:2] for p in got[c]]
        assert v[0] == min(v) and set(v) <= pts and len(v) == len(set(v))
        for a, b in zip(v, v[1:] + v[:1]):                             # every point on the left of every edge, no corner on it
            side = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in pts]
            assert min(side) >= 0 and all(s > 0 for s, p in zip(side, pts) if p in set(v) - {a, b})
    assert [p[:2] for p in got[3]] == [(0.0, 1.0), (8.0, 1.0)]
