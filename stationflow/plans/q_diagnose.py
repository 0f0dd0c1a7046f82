"""Feature diagnostic queries.

The feature frame: the station-hour panel with lags, calendar parts, the hour's
weather and a guarded 3-hour trailing mean; target ``y`` = total flow.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import diagnose as dg
from ..operators.windows import guarded
from ..sources import adapter as ad
from ..util import cut_lineage
from .catalog import register
from .q_flow import PANEL, hourly_flow_panel

FEATURES = ["total_lag1", "total_lag24", "inflow_lag1", "outflow_lag1", "hour", "weekday",
            "is_weekend", "temp", "temp_sq", "roll3"]


def feature_frame(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir)
    w = Window.partitionBy("station_id").orderBy("ts")
    wx = ad.weather(spark, sf_dir).select("ts", "temp")
    x = p.join(wx, "ts", "left")  # derived hourly side: AQE sizes it at run time
    return x.select(
        "station_id", "ts", F.col("total_flow").cast("double").alias("y"),
        F.col("inflow").cast("double").alias("inflow"), F.col("outflow").cast("double").alias("outflow"),
        F.lag("total_flow", 1).over(w).cast("double").alias("total_lag1"),
        F.lag("total_flow", 24).over(w).cast("double").alias("total_lag24"),
        F.lag("inflow", 1).over(w).cast("double").alias("inflow_lag1"),
        F.lag("outflow", 1).over(w).cast("double").alias("outflow_lag1"),
        F.hour("ts").cast("double").alias("hour"), F.weekday("ts").cast("double").alias("weekday"),
        (F.weekday("ts") >= 5).cast("double").alias("is_weekend"), "temp",
        (F.col("temp") * F.col("temp")).alias("temp_sq"),
        guarded(F.avg, "total_flow", w.rowsBetween(-3, -1), 3).alias("roll3"))


FF_SQL = PANEL + ", " + ad.with_views("weather")[5:] + """,
ff AS (SELECT p.station_id, p.ts, CAST(p.total_flow AS DOUBLE) AS y, CAST(p.inflow AS DOUBLE) AS inflow,
              CAST(p.outflow AS DOUBLE) AS outflow,
              CAST(lag(p.total_flow, 1) OVER w AS DOUBLE) AS total_lag1,
              CAST(lag(p.total_flow, 24) OVER w AS DOUBLE) AS total_lag24,
              CAST(lag(p.inflow, 1) OVER w AS DOUBLE) AS inflow_lag1,
              CAST(lag(p.outflow, 1) OVER w AS DOUBLE) AS outflow_lag1,
              CAST(hour(p.ts) AS DOUBLE) AS hour, CAST(isodow(p.ts) - 1 AS DOUBLE) AS weekday,
              CAST(isodow(p.ts) >= 6 AS DOUBLE) AS is_weekend, wx.temp, wx.temp * wx.temp AS temp_sq,
              CASE WHEN count(p.total_flow) OVER r3 = 3 THEN avg(p.total_flow) OVER r3 END AS roll3
       FROM panel p LEFT JOIN weather wx ON p.ts = wx.ts
       WINDOW w AS (PARTITION BY p.station_id ORDER BY p.ts),
              r3 AS (PARTITION BY p.station_id ORDER BY p.ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""


def pairs_sql(cols):
    import itertools
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, corr({a}, {b}) AS correlation FROM ff"
        for a, b in itertools.combinations(cols, 2))


PAIRS_SQL = FF_SQL + ",\npairs AS (" + pairs_sql(FEATURES) + ")"


@register("x01_corr_pairs", "X1 X2", PAIRS_SQL + """
SELECT variable_1, variable_2, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation,
       abs(correlation) >= 0.9 AS high
FROM pairs""", check="T")
def x01(spark, sf_dir):
    p = dg.corr_pairs(feature_frame(spark, sf_dir), FEATURES)
    return p.select("variable_1", "variable_2", F.round("correlation", 6).alias("correlation"),
                    F.round("abs_correlation", 6).alias("abs_correlation"),
                    (F.col("abs_correlation") >= 0.9).alias("high"))


SPEAR = FEATURES


@register("x03_spearman", "X3 W20", FF_SQL + ",\n" + "\nUNION ALL ".join(
    f"""s_{f} AS (SELECT '{f}' AS feature, corr(rx, ry) AS spearman FROM (
          SELECT rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS rx,
                 rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
          FROM ff WHERE {f} IS NOT NULL AND y IS NOT NULL) r)""" for f in SPEAR).replace("\nUNION ALL ", ",\n")
          + "\nSELECT feature, round(spearman, 6) AS spearman FROM ("
          + " UNION ALL ".join(f"SELECT * FROM s_{f}" for f in SPEAR) + ") u", check="T")
def x03(spark, sf_dir):
    s = dg.spearman(cut_lineage(feature_frame(spark, sf_dir)), SPEAR, "y")
    return s.select("feature", F.round("spearman", 6).alias("spearman"))


def _profile_sql(f):
    return f"""SELECT '{f}' AS feature, CAST(count(DISTINCT {f}) + max(CAST({f} IS NULL AS INTEGER)) AS BIGINT) AS nunique,
       round(avg(CAST({f} IS NULL AS DOUBLE)), 6) AS missing_ratio,
       round(avg(coalesce(CAST({f} = 0 AS DOUBLE), 0.0)), 6) AS zero_ratio,
       CAST(min({f}) AS DOUBLE) AS min, CAST(max({f}) AS DOUBLE) AS max, round(avg({f}), 6) AS mean,
       round(stddev_samp({f}), 6) AS std,
       round(CASE WHEN count({f}) > 2 AND avg(pow({f} - mu, 2)) > 0
             THEN avg(pow({f} - mu, 3)) / pow(avg(pow({f} - mu, 2)), 1.5)
                  * sqrt(count({f}) * (count({f}) - 1)) / (count({f}) - 2) END, 6) AS skew,
       coalesce(bool_and(CASE WHEN {f} IS NOT NULL THEN {f} IN (0, 1) END), false) AS is_binary,
       round(CASE WHEN count({f}) >= 5 AND count(DISTINCT {f}) >= 3
             AND min(y) FILTER (WHERE {f} IS NOT NULL) < max(y) FILTER (WHERE {f} IS NOT NULL)
             THEN abs(corr(pow({f} - mu, 2), y)) - abs(corr({f} - mu, y)) END, 6) AS poly_signal
FROM ff, (SELECT avg({f}) AS mu FROM ff) m"""


PROFILE_SQL = FF_SQL + ",\nprof AS (" + "\nUNION ALL ".join(_profile_sql(f) for f in FEATURES) + ")"


def _profile(spark, sf_dir):
    p = dg.feature_profile(feature_frame(spark, sf_dir), FEATURES, "y")
    r = ["missing_ratio", "zero_ratio", "mean", "std", "skew", "poly_signal"]
    return p.withColumns({c: F.round(c, 6) for c in r})


@register("x04_feature_profile", "X4 X5 X6 X7 X9", PROFILE_SQL + """
SELECT *, CASE WHEN nunique <= 2 THEN 'keep' WHEN skew >= 1 AND min >= 0 THEN 'log'
               WHEN poly_signal >= 0.05 THEN 'poly' ELSE 'keep' END AS hint
FROM prof""", check="T")
def x04(spark, sf_dir):
    return dg.transform_hint(_profile(spark, sf_dir))


@register("x08_drop_reasons", "X8 F17", PROFILE_SQL.replace(
    "\nprof AS (", "\nprof AS (" + _profile_sql("const_col").replace("FROM ff,", "FROM (SELECT *, 1.0 AS const_col FROM ff) ff,")
    .replace("(SELECT avg(const_col) AS mu FROM ff)", "(SELECT 1.0 AS mu)") + "\nUNION ALL "
    + _profile_sql("null_col").replace("FROM ff,", "FROM (SELECT *, CAST(NULL AS DOUBLE) AS null_col FROM ff) ff,")
    .replace("(SELECT avg(null_col) AS mu FROM ff)", "(SELECT CAST(NULL AS DOUBLE) AS mu)") + "\nUNION ALL ", 1) + """
SELECT 'station_id' AS feature, 'non_numeric' AS reason UNION ALL SELECT 'ts', 'non_numeric'
UNION ALL SELECT feature, CASE WHEN missing_ratio = 1 THEN 'all_missing' WHEN nunique <= 1 THEN 'constant' END
FROM prof WHERE missing_ratio = 1 OR nunique <= 1""")
def x08(spark, sf_dir):
    ff = feature_frame(spark, sf_dir).withColumns({"const_col": F.lit(1.0),
                                                   "null_col": F.lit(None).cast("double")})
    ff = ff.drop("y", "inflow", "outflow")
    from ..schema import numeric_columns
    prof = dg.feature_profile(ff, numeric_columns(ff))
    return dg.drop_reasons(ff, prof)


# Derived feature -> base features it replaces (X11 rule table).
DERIVED_RULES = {"temp_sq": {"temp"}, "roll3": {"total_lag1"}, "is_weekend": {"weekday"}}


@register("x11_derived_rule_drops", "X11", PAIRS_SQL + """,
rules AS (SELECT * FROM (VALUES ('temp_sq', 'temp'), ('roll3', 'total_lag1'), ('is_weekend', 'weekday')) r(derived, base)),
hp AS (SELECT * FROM pairs WHERE abs(correlation) >= 0.8)
SELECT hp.variable_1, hp.variable_2, round(hp.correlation, 6) AS correlation,
       coalesce(r1.derived, r2.derived) AS derived_variable, coalesce(r1.base, r2.base) AS base_variable_to_drop,
       CASE WHEN coalesce(r1.derived, r2.derived) IS NULL THEN 'manual_review' ELSE 'rule' END AS rule_applied
FROM hp LEFT JOIN rules r1 ON hp.variable_1 = r1.derived AND hp.variable_2 = r1.base
        LEFT JOIN rules r2 ON hp.variable_2 = r2.derived AND hp.variable_1 = r2.base""", check="T")
def x11(spark, sf_dir):
    p = dg.corr_pairs(feature_frame(spark, sf_dir), FEATURES)
    d = dg.derived_rule_drops(p, DERIVED_RULES, 0.8)
    return d.select("variable_1", "variable_2", F.round("correlation", 6).alias("correlation"),
                    "derived_variable", "base_variable_to_drop", "rule_applied")


TARGETS = ["inflow", "outflow", "y"]


@register("x12_top_features", "X12", FF_SQL + """,
l AS (""" + "\nUNION ALL ".join(f"SELECT '{t}' AS target, '{f}' AS feature, corr({f}, {t}) AS correlation FROM ff"
                                for t in TARGETS for f in FEATURES) + """)
SELECT target, feature, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY abs(correlation) DESC, feature) AS INTEGER)
                  AS rank FROM l) x WHERE rank <= 3""", check="T")
def x12(spark, sf_dir):
    t = dg.top_features(feature_frame(spark, sf_dir), FEATURES, TARGETS, 3)
    return t.select("target", "feature", F.round("correlation", 6).alias("correlation"),
                    F.round("abs_correlation", 6).alias("abs_correlation"), "rank")


MI_FEATURES = [f for f in FEATURES if f != "hour"]   # calendar positions are not transformed
SQL_TRANSFORMS = {"raw": "{x}", "log": "ln(1 + greatest({x}, 0.0))", "poly": "{x} * {x}"}


def _long_sql(features, src):
    return "\nUNION ALL ".join(f"SELECT '{f}' AS feature, '{t}' AS transform, CAST({tx.format(x=f)} AS DOUBLE) AS x, y "
                               f"FROM {src} WHERE {f} IS NOT NULL AND y IS NOT NULL"
                               for f in features for t, tx in SQL_TRANSFORMS.items())


@register("x13_binned_mutual_information", "X13 W21", FF_SQL + """,
lg AS (""" + _long_sql(MI_FEATURES, "ff") + """),
e AS (SELECT feature, transform,
             list_sort(list_distinct(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS ex,
             list_sort(list_distinct(quantile_cont(y, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS ey
      FROM lg GROUP BY 1, 2),
b AS (SELECT lg.feature, lg.transform,
             least(len(list_filter(ex[2:], lambda v: v < x)), len(ex) - 2) AS bx,
             least(len(list_filter(ey[2:], lambda v: v < y)), len(ey) - 2) AS by_
      FROM lg JOIN e ON lg.feature = e.feature AND lg.transform = e.transform),
j AS (SELECT feature, transform, bx, by_, count(*) AS nxy FROM b GROUP BY 1, 2, 3, 4),
jj AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, transform) AS n,
              sum(nxy) OVER (PARTITION BY feature, transform, bx) AS nx,
              sum(nxy) OVER (PARTITION BY feature, transform, by_) AS ny FROM j),
mi AS (SELECT feature, transform, sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi FROM jj GROUP BY 1, 2),
st AS (SELECT feature, transform, count(*) AS n, min(x) AS low, abs(corr(x, y)) AS r FROM lg GROUP BY 1, 2),
w AS (SELECT feature, max(n) AS n, max(r) FILTER (WHERE transform = 'raw') AS raw_abs_corr,
             max(mi) FILTER (WHERE transform = 'raw') AS raw_mi,
             CASE WHEN max(low) FILTER (WHERE transform = 'raw') >= 0 THEN max(r) FILTER (WHERE transform = 'log') END AS log_abs_corr,
             CASE WHEN max(low) FILTER (WHERE transform = 'raw') >= 0 THEN max(mi) FILTER (WHERE transform = 'log') END AS log_mi,
             max(r) FILTER (WHERE transform <> 'log') AS poly_abs_corr,
             sum(mi) FILTER (WHERE transform <> 'log') AS poly_mi
      FROM st JOIN mi USING (feature, transform) GROUP BY 1),
sc AS (SELECT *, round((raw_abs_corr + raw_mi) / 2, 9) AS s0, coalesce(round((log_abs_corr + log_mi) / 2, 9), -1) AS s1,
              round((poly_abs_corr + poly_mi) / 2, 9) AS s2 FROM w WHERE n >= 30)
SELECT feature, round(raw_abs_corr, 6) AS raw_abs_corr, round(raw_mi, 6) AS raw_mi, round(log_abs_corr, 6) AS log_abs_corr,
       round(log_mi, 6) AS log_mi, round(poly_abs_corr, 6) AS poly_abs_corr, round(poly_mi, 6) AS poly_mi,
       CASE WHEN s0 >= s1 AND s0 >= s2 THEN 'raw' WHEN s1 >= s2 THEN 'log' ELSE 'poly' END AS best_transform
FROM sc""", check="T")
def x13(spark, sf_dir):
    # counts and percentiles read the frame many times: it is written once
    c = dg.transform_comparison(cut_lineage(feature_frame(spark, sf_dir)), MI_FEATURES, "y", 10)
    return c.select("feature", *[F.round(x, 6).alias(x) for x in c.columns if x.endswith(("_corr", "_mi"))], "best_transform")


def _cv_sql(f):
    """Regressions on the rows themselves (not on moments), fold by fold."""
    return "\nUNION ALL ".join(f"""SELECT '{f}' AS feature, '{t}' AS transform, CAST({f if t == "poly" else tx.format(x=f)} AS DOUBLE) AS x, y,
       row_number() OVER (ORDER BY ts, station_id) - 1 AS pos, count(*) OVER () AS n
FROM ff WHERE {f} IS NOT NULL AND y IS NOT NULL""" for t, tx in SQL_TRANSFORMS.items())


@register("x14_cv_transform_choice", "X14 M6", FF_SQL + """,
lf AS (""" + "\nUNION ALL ".join(_cv_sql(f) for f in FEATURES) + """),
ps AS (SELECT *, n - 5 * (n // 6) AS first, n // 6 AS size FROM lf),
fo AS (SELECT * FROM ps, (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS fold) k WHERE pos < first + (fold + 1) * size),
ro AS (SELECT *, pos >= first + fold * size AS test FROM fo),
s AS (SELECT fold, feature, transform, avg(x) AS mx, avg(x * x) AS mq, avg(y) AS my, covar_pop(x, y) AS sxy,
             var_pop(x) AS sxx, covar_pop(x * x, y) AS sqy, covar_pop(x, x * x) AS sxq, var_pop(x * x) AS sqq
      FROM ro WHERE NOT test GROUP BY 1, 2, 3),
c AS (SELECT *, sxx * sqq - sxq * sxq AS det, transform = 'poly' AND sxx * sqq - sxq * sxq > 1e-9 * sxx * sqq AS two FROM s),
b AS (SELECT *, CASE WHEN two THEN (sxy * sqq - sqy * sxq) / det WHEN sxx > 0 THEN sxy / sxx ELSE 0.0 END AS b1,
                CASE WHEN two THEN (sqy * sxx - sxy * sxq) / det ELSE 0.0 END AS b2 FROM c),
te AS (SELECT ro.fold, ro.feature, ro.transform, y, my + b1 * (x - mx) + b2 * (x * x - mq) AS pred
       FROM ro JOIN b USING (fold, feature, transform) WHERE test),
per AS (SELECT fold, feature, transform, avg(abs(y - pred)) AS mae, sum(pow(y - pred, 2)) AS sse, var_pop(y) * count(*) AS sst
        FROM te GROUP BY 1, 2, 3),
m AS (SELECT feature, transform, avg(CASE WHEN sst = 0 THEN 0.0 ELSE 1 - sse / sst END) AS r2,
             stddev_pop(CASE WHEN sst = 0 THEN 0.0 ELSE 1 - sse / sst END) AS r2_std, avg(mae) AS mae, stddev_pop(mae) AS mae_std
      FROM per GROUP BY 1, 2),
o AS (SELECT feature, transform, corr(pred, y) AS oof_corr FROM te GROUP BY 1, 2)
SELECT feature, transform, round(r2, 6) AS r2, round(r2_std, 6) AS r2_std, round(mae, 6) AS mae, round(mae_std, 6) AS mae_std,
       round(oof_corr, 6) AS oof_corr,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY round(r2, 4) DESC, round(mae, 4), round(oof_corr, 4) DESC,
            CASE transform WHEN 'raw' THEN 0 WHEN 'log' THEN 1 ELSE 2 END) AS INTEGER) AS rank
FROM m JOIN o USING (feature, transform)""", check="T")
def x14(spark, sf_dir):
    blocks = dg.feature_blocks(feature_frame(spark, sf_dir), FEATURES, "y", ["ts", "station_id"])
    c = dg.cv_transform_choice(cut_lineage(blocks))   # read by three passes
    return c.select("feature", "transform", *[F.round(x, 6).alias(x) for x in ("r2", "r2_std", "mae", "mae_std", "oof_corr")], "rank")


# The transform choice applied by the X15 query.
CHOICE = {"total_lag1": "log", "temp": "poly"}


@register("x15_apply_transforms", "X15", FF_SQL + """
SELECT station_id, ts, round(CASE WHEN total_lag1 IS NOT NULL THEN ln(1 + greatest(total_lag1, 0.0)) END, 6)
         AS total_lag1_log, round(temp * temp, 6) AS temp_sq
FROM ff""", check="T")
def x15(spark, sf_dir):
    ff = feature_frame(spark, sf_dir).drop("temp_sq")
    out = dg.apply_transforms(ff, CHOICE)
    return out.select("station_id", "ts", F.round("total_lag1_log", 6).alias("total_lag1_log"),
                      F.round("temp_sq", 6).alias("temp_sq"))


@register("x16_f_scores", "X16", FF_SQL + """,
r AS (""" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, corr({f}, y) AS r, count(*) FILTER (WHERE {f} IS NOT NULL AND y IS NOT NULL) AS n FROM ff"
    for f in FEATURES) + """)
SELECT feature, round(r, 6) AS r, n,
       round(CASE WHEN r * r < 1 THEN r * r / (1 - r * r) * (n - 2) END, 4) AS f_stat,
       CAST(row_number() OVER (ORDER BY CASE WHEN r * r < 1 THEN r * r / (1 - r * r) * (n - 2) END DESC NULLS LAST,
                                        feature) AS INTEGER) AS rank
FROM r""", check="T")
def x16(spark, sf_dir):
    s = dg.f_scores(feature_frame(spark, sf_dir), FEATURES, "y")
    return s.select("feature", F.round("r", 6).alias("r"), "n", F.round("f_stat", 4).alias("f_stat"), "rank")
