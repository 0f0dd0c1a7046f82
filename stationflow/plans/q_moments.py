"""Queries on mergeable moments.

The SQL twins solve the normal equations on the rows by Gauss-Jordan elimination in a
recursive query.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import cycles as cy
from ..operators import diagnose as dg
from ..operators import evaluate as ev
from ..operators import inventory as inv
from ..operators import moments as mo
from ..operators import profiles as pf
from ..operators import windows as wn
from ..operators.models import random_grid
from ..sources import adapter as ad
from ..util import cut_lineage
from .catalog import register
from .q_diagnose import FEATURES, FF_SQL, PROFILE_SQL, feature_frame, pairs_sql
from .q_inventory import panel_with_capacity
from .q_splits import MODELS_SQL, model_rows

# total_lag1 is the sum of the two flow lags, so it stays out
NUM = ["total_lag24", "inflow_lag1", "outflow_lag1", "hour", "weekday", "temp", "roll3"]
TRAIN_END, VALID_END = "2024-01-15", "2024-01-22"


def _at(day):
    return F.lit(day).cast("timestamp_ntz")


def _parts(spark, sf_dir):
    ff = cut_lineage(feature_frame(spark, sf_dir))
    return ff.filter(F.col("ts") < _at(TRAIN_END)), ff.filter((F.col("ts") >= _at(TRAIN_END)) & (F.col("ts") < _at(VALID_END))), \
        ff.filter(F.col("ts") >= _at(VALID_END))


def normal_equations_sql(rows: str, features: list[str], label: str, alpha: float, key: str = "0", tag: str = "") -> str:
    """CTEs ``rows_<tag>, stats.., gram.., elim.., coefs..(k_, n, intercept, w)`` over the CTE ``rows``:
    standardised ridge (or least squares) per ``key``, solved by Gauss-Jordan elimination."""
    d = len(features)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*features, label])
    z = [f"(r.f{i} - s.m{i}) / s.s{i}" for i in range(d)]
    cells = ", ".join("[" + ", ".join([f"sum({a} * {b})" + (f" + {alpha!r}" if i == j else "") for j, b in enumerate(z)] + [f"sum({a} * (r.y_ - s.my))"]) + "]"
                      for i, a in enumerate(z))
    stats = ", ".join(f"avg(f{i}) AS m{i}, CASE WHEN stddev_pop(f{i}) > 0 THEN stddev_pop(f{i}) ELSE 1.0 END AS s{i}" for i in range(d))
    return f"""
rows_{tag} AS (SELECT {key} AS k_, {", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(features))}, CAST({label} AS DOUBLE) AS y_
          FROM {rows} WHERE {complete}),
stats{tag} AS (SELECT k_, count(*) AS n, avg(y_) AS my, {stats} FROM rows_{tag} GROUP BY k_),
gram{tag} AS (SELECT r.k_, [{cells}] AS m FROM rows_{tag} r JOIN stats{tag} s ON r.k_ = s.k_ GROUP BY r.k_),
elim{tag} AS (SELECT k_, 1 AS i, m FROM gram{tag}
         UNION ALL
         SELECT k_, i + 1, list_transform(m, lambda r, p: CASE WHEN p = i THEN list_transform(r, lambda v: v / r[i])
                ELSE list_transform(r, lambda v, j: v - r[i] * m[i][j] / m[i][i]) END) FROM elim{tag} WHERE i <= {d}),
coefs{tag} AS (SELECT s.k_, s.n, [{", ".join(f"m[{i + 1}][{d + 1}] / s.s{i}" for i in range(d))}] AS w,
                 s.my - ({" + ".join(f"m[{i + 1}][{d + 1}] / s.s{i} * s.m{i}" for i in range(d))}) AS intercept
          FROM elim{tag} e JOIN stats{tag} s ON e.k_ = s.k_ WHERE i = {d + 1})"""


def _coef_sql(features, alpha, key="0", extra=""):
    head = "WITH RECURSIVE " + FF_SQL[len("WITH "):] + f",\ntrain AS (SELECT * FROM ff WHERE ts < TIMESTAMP '{TRAIN_END}'),"
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    return head + normal_equations_sql("train", features, "y", alpha, key) + f"""
SELECT {extra}CAST(n AS DOUBLE) AS n, round(intercept, 6) AS intercept, unnest({names}) AS feature, round(unnest(w), 6) AS coef FROM coefs"""


def _coef_rows(models, features, *keys):
    pairs = F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("feature"), F.col("coef").alias("coef"))
    return models.select(*keys, "n", F.round("intercept", 6).alias("intercept"), F.inline(pairs)).withColumn("coef", F.round("coef", 6))


@register("m12_least_squares", "M12", _coef_sql(NUM, 0.0), check="T")
def m12(spark, sf_dir):
    train = feature_frame(spark, sf_dir).filter(F.col("ts") < _at(TRAIN_END))
    return _coef_rows(mo.least_squares(train, NUM, "y"), NUM)


@register("m13_ridge_coefficients", "M13", _coef_sql(NUM, 10.0), check="T")
def m13(spark, sf_dir):
    train = feature_frame(spark, sf_dir).filter(F.col("ts") < _at(TRAIN_END))
    return _coef_rows(mo.least_squares(train, NUM, "y", 10.0), NUM)


@register("m26_station_ridge", "M26 M13", _coef_sql(NUM, 1.0, "station_id", "k_ AS station_id, "), check="T")
def m26_station(spark, sf_dir):
    """One ridge per station; the trips of a station meet only as moments."""
    train = feature_frame(spark, sf_dir).filter(F.col("ts") < _at(TRAIN_END))
    return _coef_rows(mo.least_squares(train, NUM, "y", 1.0, ["station_id"]), NUM, "station_id")


# The penalties of the grid.
ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]


@register("m26_per_station_vs_pooled", "M26 J15 M23", check="R")
def m26(spark, sf_dir):
    """The same ridge, grid and folds apart and pooled, side by side per station."""
    ff = feature_frame(spark, sf_dir)
    split = F.when(F.col("ts") < _at(TRAIN_END), "train").when(F.col("ts") < _at(VALID_END), "valid").otherwise("test")
    whole = ff.select("station_id", "ts", "y", *NUM, split.alias("split")).na.drop(subset=NUM)
    s = cut_lineage(mo.group_search(cut_lineage(whole), "station_id", "ts", "split", NUM, "y", ALPHAS, 3))
    side = {scope: s.filter(F.col("scope") == scope).select("station_id", "split", F.col("alpha").alias(f"alpha_{scope}"), F.col("r2").alias(f"r2_{scope}"),
                                                            F.col("rmse").alias(f"rmse_{scope}")) for scope in ("individual", "pooled")}
    return side["individual"].join(side["pooled"], ["station_id", "split"], "full")


@register("m23_weighted_model_space", "M14 M22 M23 M25 M34", check="R")
def m23(spark, sf_dir):
    """Four linear models, their whole grids, week weights, both flows; sealed test."""
    ff = feature_frame(spark, sf_dir)
    split = F.when(F.col("ts") < _at(TRAIN_END), "train").when(F.col("ts") < _at(VALID_END), "valid").otherwise("test")
    x = cut_lineage(pf.sample_weight(ff, pf.week_weights(ff, "y")).withColumn("split", split))
    return mo.model_space_search(x, FEATURES, ["inflow", "outflow"], "split", ["ts", "station_id"], "sample_weight")


def _split_frame(spark, sf_dir):
    split = F.when(F.col("ts") < _at(TRAIN_END), "train").when(F.col("ts") < _at(VALID_END), "valid").otherwise("test")
    return cut_lineage(feature_frame(spark, sf_dir).withColumn("split", split))


@register("m24_random_search", "M24", check="R")
def m24(spark, sf_dir):
    """60 seeded draws of penalty and share, with the plain model beside them."""
    draws = random_grid({"alpha": (0.0001, 100.0), "l1_ratio": [0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0]}, n=60, seed=7)
    return mo.model_space_search(_split_frame(spark, sf_dir), FEATURES, ["y"], "split", ["ts", "station_id"], space={"linear": [{}], "elasticnet": draws})


@register("m25_refit_sealed_test", "M25", check="R")
def m25(spark, sf_dir):
    """The best of four searches, fitted again on train and valid, scored once on the test rows."""
    s = mo.model_space_search(_split_frame(spark, sf_dir), FEATURES, ["y", "inflow", "outflow"], "split", ["ts", "station_id"])
    return s.filter("stage = 'sealed'").select("target", "model", "params", "cv_r2", "test_R2", "test_RMSE", "test_MAE")


_RIDGE_HEAD = "WITH RECURSIVE " + FF_SQL[len("WITH "):] + f",\ntrain AS (SELECT * FROM ff WHERE ts < TIMESTAMP '{TRAIN_END}'),"


@register("m42_capacity_clip", "M42", _RIDGE_HEAD + normal_equations_sql("train", NUM, "y", 10.0) + ", " + ad.with_views("stations")[5:] + f"""
SELECT ff.station_id, ff.ts, ff.y, CAST(s.lcd + s.qr AS BIGINT) AS capacity,
       round(least(greatest(c.intercept + {" + ".join(f"c.w[{i + 1}] * ff.{f}" for i, f in enumerate(NUM))}, 0.0), CAST(s.lcd + s.qr AS DOUBLE)), 6) + 0.0 AS pred
FROM ff JOIN stations s ON s.station_id = ff.station_id, coefs c
WHERE ff.ts >= TIMESTAMP '{VALID_END}' AND {" AND ".join(f"ff.{f} IS NOT NULL" for f in NUM)}""", check="T")
def m42(spark, sf_dir):
    """Ridge forecasts of the test rows, clipped to the docks of the station."""
    ff = cut_lineage(feature_frame(spark, sf_dir))
    model = mo.least_squares(ff.filter(F.col("ts") < _at(TRAIN_END)), NUM, "y", 10.0)
    cap = ad.stations(spark, sf_dir).select("station_id", (F.col("lcd") + F.col("qr")).cast("long").alias("capacity"))
    p = mo.linear_prediction(ff.filter(F.col("ts") >= _at(VALID_END)).na.drop(subset=NUM), model, NUM).join(cap, "station_id")
    clipped = F.least(F.greatest("pred", F.lit(0.0)), F.col("capacity").cast("double"))
    return p.select("station_id", "ts", "y", "capacity", F.round(clipped, 6).alias("pred"))


# Importance of a feature is the size of its standardised ridge coefficient
_IMPORTANCE = "[" + ", ".join(f"abs(c.w[{i + 1}] * s.s{i})" for i in range(len(FEATURES))) + "]"


@register("x10_partner_rules_ridge", "X10 X17", "WITH RECURSIVE " + PROFILE_SQL[len("WITH "):] + ",\nunr AS (" + pairs_sql(FEATURES) + "),\n"
          + normal_equations_sql("ff", FEATURES, "y", 1.0).strip() + f""",
imp AS (SELECT unnest([{", ".join(f"'{f}'" for f in FEATURES)}]) AS feature, unnest({_IMPORTANCE}) AS importance FROM coefs c JOIN stats s ON c.k_ = s.k_),
hp AS (SELECT variable_1 AS feature, variable_2 AS p FROM unr WHERE abs(correlation) >= 0.8
       UNION ALL SELECT variable_2, variable_1 FROM unr WHERE abs(correlation) >= 0.8),
pa AS (SELECT feature, list_sort(list(p)) AS high_corr_partners FROM hp GROUP BY 1)
SELECT prof.feature, nunique, missing_ratio, high_corr_partners, round(importance, 6) AS importance,
       nunique <= 1 OR (coalesce(importance, 0) < 0.001 AND missing_ratio >= 0.9) AS drop_must,
       NOT (nunique <= 1 OR (coalesce(importance, 0) < 0.001 AND missing_ratio >= 0.9))
         AND (coalesce(importance, 0) < 0.003 OR high_corr_partners IS NOT NULL) AS drop_consider
FROM prof LEFT JOIN pa ON pa.feature = prof.feature LEFT JOIN imp ON imp.feature = prof.feature""", check="T")
def x10(spark, sf_dir):
    ff = cut_lineage(feature_frame(spark, sf_dir))
    m = mo.read_moments(mo.moments(ff, [*FEATURES, "y"])).get((), mo.Moment.empty(len(FEATURES) + 1))
    w = mo.solve(m, list(range(len(FEATURES))), len(FEATURES), 1.0).scaled
    imp = spark.createDataFrame([(f, abs(float(v))) for f, v in zip(FEATURES, w)], "feature string, importance double")
    r = dg.partner_rules(dg.feature_profile(ff, FEATURES), dg.corr_pairs(ff, FEATURES), imp, 0.8)
    return r.withColumns({"importance": F.round("importance", 6), "missing_ratio": F.round("missing_ratio", 6)})


def _selection(spark, sf_dir, which):
    train, valid, _ = _parts(spark, sf_dir)
    return mo.selection_study(train.unionByName(valid), FEATURES, "y", ["ts", "station_id"])[which]


@register("x16_k_best_tuned", "X16", check="R")
def x16(spark, sf_dir):
    return _selection(spark, sf_dir, "tuning").filter("selector = 'select_k_best'")


@register("x17_coefficients_tuned", "X17", check="R")
def x17(spark, sf_dir):
    return _selection(spark, sf_dir, "tuning").filter("selector = 'select_from_model'")


@register("x18_rfe_cv", "X18", check="R")
def x18(spark, sf_dir):
    return _selection(spark, sf_dir, "tuning").filter("selector = 'rfecv'")


@register("x19_selection_frequency", "X19", check="R")
def x19(spark, sf_dir):
    return _selection(spark, sf_dir, "frequency")


@register("x19_outer_comparison", "X19", check="R")
def x19_outer(spark, sf_dir):
    return _selection(spark, sf_dir, "outer")


@register("x21_drop_one_feature", "X21", check="R")
def x21(spark, sf_dir):
    return mo.drop_one(*_parts(spark, sf_dir), FEATURES, "y")


# Groups of alternative encodings of one axis.
AXES = {"recent_demand": {"none": [], "lag_1h": ["total_lag1"], "flow_lags_1h": ["inflow_lag1", "outflow_lag1"], "rolling_mean_3h": ["roll3"],
                          "lag_1h + rolling_mean_3h": ["total_lag1", "roll3"]},
        "daily_demand": {"none": [], "lag_24h": ["total_lag24"]},
        "calendar": {"none": [], "weekday": ["weekday"], "is_weekend": ["is_weekend"], "both": ["weekday", "is_weekend"]},
        "weather": {"none": [], "temp": ["temp"], "temp_sq": ["temp_sq"], "both": ["temp", "temp_sq"]}}


@register("x22_axis_variants", "X22 W18", check="R")
def x22(spark, sf_dir):
    train, valid, _ = _parts(spark, sf_dir)
    return mo.compare_axes(train, valid, AXES, FEATURES, "y")


# The operating frame ---------------------------------------------------------------
def operating_frame(spark, sf_dir):
    """One row per station and 12-hour cycle: its demand, the weather and calendar at its
    start, the stock it starts with, and the demand of earlier cycles."""
    p = panel_with_capacity(spark, sf_dir)
    stock = inv.estimated_stock(p, "net_flow", "capacity")
    c = cy.tag_cycle(stock).groupBy("station_id", "cycle_start", "cycle_hour").agg(
        F.sum("outflow").cast("double").alias("demand"), F.min_by("stock_start_clip", "ts").cast("double").alias("initial_bikes"))
    wx = ad.weather(spark, sf_dir).select(F.col("ts").alias("cycle_start"), "temp", "humidity", "rain")
    c = c.join(wx, "cycle_start", "left").fillna(0.0, subset=["temp", "humidity", "rain"])
    code = ad.stations(spark, sf_dir).select("station_id", (F.dense_rank().over(Window.orderBy("station_id")) - 1).cast("double").alias("station_idx"))
    c = c.join(code, "station_id", "left")                     # the station dimension: a row each
    c = wn.add_cycle_means(wn.add_cycle_lags(c, "demand"), "demand")
    t = F.col("cycle_start")
    hs, hc = tp.cyclic(F.hour(t), 24)
    ws, wc = tp.cyclic(F.weekday(t), 7)
    ms, mc = tp.cyclic(F.month(t), 12)
    ds, dc = tp.cyclic(F.dayofyear(t), 365)
    return c.withColumns({
        "hour_sin": hs, "hour_cos": hc, "weekday_sin": ws, "weekday_cos": wc, "month_sin": ms, "month_cos": mc, "doy_sin": ds, "doy_cos": dc,
        "is_weekend": (F.weekday(t) >= 5).cast("double"), "rush": F.hour(t).isin(7, 8, 9, 17, 18, 19).cast("double"),
        "cycle_flag": (F.col("cycle_hour") == 16).cast("double"), "rain_flag": (F.col("rain") > 0).cast("double"),
        "discomfort": 0.81 * F.col("temp") + 0.01 * F.col("humidity") * (0.99 * F.col("temp") - 14.3) + 46.3,
        "demand_change_1": F.col("demand_prev_cycle") - F.col("demand_prev_day_cycle")})


# The named feature sets.
SET_A = ["temp", "humidity", "rain", "hour_sin", "hour_cos", "rush", "cycle_flag"]
SET_C = [*SET_A, "initial_bikes", "demand_prev_cycle", "demand_prev_day_cycle"]
WEEK, MONTH, DAY = ["weekday_sin", "weekday_cos"], ["month_sin", "month_cos"], ["doy_sin", "doy_cos"]
CYCLE_MEANS = ["demand_prev2_mean", "demand_prev3_mean", "demand_same7_mean"]
FEATURE_SETS = {
    "A_minimum": SET_A, "B_recommended": SET_C[:-1], "C_extended": SET_C, "D_with_station_idx": [*SET_C, "station_idx"],
    "E_calendar_plus": [*SET_C, "discomfort", *WEEK, *MONTH, "is_weekend"], "F_cycle_avg": [*SET_C, "discomfort", *WEEK, *DAY, *CYCLE_MEANS],
    "G_station_cycle": [*SET_C, "discomfort", *WEEK, *DAY, *CYCLE_MEANS, "station_idx"],
    "H_full_expanded": [*SET_C, "discomfort", *WEEK, *MONTH, *DAY, "rain_flag", *CYCLE_MEANS, "demand_prev7_mean", "demand_same14_mean",
                        "demand_change_1", "station_idx"]}
OPER_TRAIN_END, OPER_VALID_END = "2024-01-22", "2024-01-26"      # 14 earlier days go into the longest mean


@register("m40_feature_sets", "M40 M33", check="R")
def m40(spark, sf_dir):
    """Sets A to H on the same rows, ranked and chosen by the weighted score."""
    x = cut_lineage(operating_frame(spark, sf_dir))
    t = F.col("cycle_start")
    valid, test = x.filter((t >= _at(OPER_TRAIN_END)) & (t < _at(OPER_VALID_END))), x.filter(t >= _at(OPER_VALID_END))
    return ev.model_choice(mo.compare_feature_sets(x.filter(t < _at(OPER_TRAIN_END)), {"valid": valid, "test": test}, FEATURE_SETS, "demand"))


_SCORES = "\n".join(f"""
       1 - sum((y - pred) * (y - pred)) FILTER (WHERE {c}) / (var_pop(y) FILTER (WHERE {c}) * count(*) FILTER (WHERE {c})) AS {p}_R2,
       sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE {c})) AS {p}_RMSE,
       sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE {c})) / stddev_samp(y) FILTER (WHERE {c}) AS {p}_RMSE_over_std""" + ("," if p == "valid" else "")
    for p, c in (("valid", f"ts < TIMESTAMP '{VALID_END}'"), ("test", f"ts >= TIMESTAMP '{VALID_END}'")))


@register("m33_model_choice", "M33", MODELS_SQL + f""",
sc AS (SELECT model, max(complexity) AS feature_count, {_SCORES} FROM lm GROUP BY model),
rk AS (SELECT *, rank() OVER (ORDER BY valid_R2 DESC) + rank() OVER (ORDER BY test_R2 DESC) + rank() OVER (ORDER BY valid_RMSE)
              + rank() OVER (ORDER BY test_RMSE) AS rs,
              4 * test_R2 + 3 * valid_R2 - 2 * test_RMSE_over_std - 1.5 * valid_RMSE_over_std - 0.05 * rank() OVER (ORDER BY feature_count) AS score
       FROM sc)
SELECT model, CAST(rs AS INTEGER) AS final_rank_score, round(score, 6) AS selection_score,
       CAST(row_number() OVER (ORDER BY score DESC, test_R2 DESC, valid_R2 DESC, test_RMSE, model) AS INTEGER) AS place FROM rk""", check="T")
def m33(spark, sf_dir):
    """The baseline forecasts (previous day, hour, week) ranked and chosen."""
    rows = cut_lineage(model_rows(spark, sf_dir))
    out = rows.groupBy("model").agg(F.max("complexity").alias("feature_count"))
    for part, cond in (("valid", F.col("ts") < _at(VALID_END)), ("test", F.col("ts") >= _at(VALID_END))):
        own = rows.filter(cond)
        rel = ev.relative_errors(own, ["model"]).select("model", F.col("rmse").alias(f"{part}_RMSE"), F.col("rel_rmse").alias(f"{part}_RMSE_over_std"))
        out = out.join(rel, "model").join(ev.regression_metrics(own, keys=["model"]).select("model", F.col("r2").alias(f"{part}_R2")), "model")
    c = ev.model_choice(out, "model")
    return c.select("model", "final_rank_score", F.round("selection_score", 6).alias("selection_score"), "place")
