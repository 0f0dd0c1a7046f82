"""Split, ordering, set-operation and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import splits as sp
from ..sources import adapter as ad
from .catalog import register
from .q_flow import PANEL, PRED_SQL, hourly_flow_panel, od_day, panel_with_pred

V = ad.with_views


# M1 ---------------------------------------------------------------------------
@register("m01_split_by_dates", "M1", PANEL + """
SELECT station_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'train'
                            WHEN ts < TIMESTAMP '2024-01-22' THEN 'valid' ELSE 'test' END AS split
FROM panel""")
def m01(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts")
    return p.withColumn("split", sp.split_by_dates("ts", F.lit("2024-01-15").cast("timestamp_ntz"),
                                                   F.lit("2024-01-22").cast("timestamp_ntz")))


# M2 ---------------------------------------------------------------------------
@register("m02_split_by_ratio", "M2", V("trips") + """,
x AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM trips)
SELECT event_id, CASE WHEN pos < floor(n * 0.7) THEN 'train' WHEN pos < floor(n * (0.7 + 0.15)) THEN 'valid'
                      ELSE 'test' END AS split
FROM x""")
def m02(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("event_id", "ts")
    return sp.split_by_ratio(t, ["ts", "event_id"], (0.7, 0.15), ("train", "valid", "test")) \
        .select("event_id", "split")


# M3 ---------------------------------------------------------------------------
@register("m03_split_distinct_time", "M3", V("trips") + """,
d AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM trips),
r AS (SELECT h, dense_rank() OVER (ORDER BY h) - 1 AS rk, count(*) OVER () AS n FROM d)
SELECT t.event_id, CASE WHEN rk < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
FROM trips t JOIN r ON date_trunc('hour', t.ts) = r.h""")
def m03(spark, sf_dir):
    from ..functions.timeparts import trunc
    t = ad.trips(spark, sf_dir).select("event_id", trunc("hour", "ts").alias("h"))
    return sp.split_by_distinct_time(t, "h", 0.8).select("event_id", "split")


# M4 ---------------------------------------------------------------------------
@register("m04_split_time_quantile", "M4 A28", V("trips") + """,
c AS (SELECT make_timestamp(CAST(round(quantile_cont(epoch_us(ts) / 1e6, 0.8) * 1e6) AS BIGINT)) AS cut FROM trips)
SELECT event_id, CASE WHEN ts <= cut THEN 'train' ELSE 'test' END AS split FROM trips, c""")
def m04(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("event_id", "ts")
    return sp.split_by_time_quantile(t, "ts", 0.8).select("event_id", "split")


# M5 ---------------------------------------------------------------------------
@register("m05_split_within_month", "M5", V("od_daily") + """,
d AS (SELECT start_id AS station_id, day, sum(cnt) AS cnt FROM od_daily GROUP BY 1, 2),
x AS (SELECT *, row_number() OVER (PARTITION BY station_id, year(day), month(day) ORDER BY day) AS rn,
             count(*) OVER (PARTITION BY station_id, year(day), month(day)) AS n FROM d)
SELECT station_id, day, CASE WHEN rn <= least(greatest(floor(n * 0.7), 1), n - 1) THEN 'train' ELSE 'test' END AS split
FROM x""")
def m05(spark, sf_dir):
    d = od_day(spark, sf_dir).withColumns({"y": F.year("day"), "m": F.month("day")})
    return sp.split_within_groups(d, ["station_id", "y", "m"], ["day"], 0.7).select("station_id", "day", "split")


# M6 ---------------------------------------------------------------------------
@register("m06_ts_folds", "M6", V("trips") + """,
x AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM trips),
f AS (SELECT x.*, CAST(unnest(range(0, 5)) AS INTEGER) AS fold FROM x),
r AS (SELECT event_id, fold,
             CASE WHEN pos >= n - (5 - fold) * floor(n / 6) AND pos < n - (5 - fold) * floor(n / 6) + floor(n / 6)
                  THEN 'test' WHEN pos < n - (5 - fold) * floor(n / 6) - 24 THEN 'train' END AS role FROM f)
SELECT fold, role, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM r WHERE role IS NOT NULL GROUP BY 1, 2""")
def m06(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("event_id", "ts")
    f = sp.ts_fold_labels(t, ["ts", "event_id"], k=5, gap=24)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
                                         F.max("event_id").alias("last_id"))


# M7 ---------------------------------------------------------------------------
@register("m07_rolling_month_folds", "M7", V("od_daily") + """,
d AS (SELECT start_id AS station_id, day, sum(cnt) AS cnt FROM od_daily GROUP BY 1, 2),
f AS (SELECT d.*, CAST(unnest(range(1, 4)) AS INTEGER) AS fold FROM d),
r AS (SELECT *, CASE WHEN day >= date_trunc('month', DATE '1998-12-31') - to_months(fold)
                      AND day < date_trunc('month', DATE '1998-12-31') - to_months(fold) + INTERVAL 1 MONTH THEN 'valid'
                     WHEN day < date_trunc('month', DATE '1998-12-31') - to_months(fold) THEN 'train' END AS role
      FROM f)
SELECT fold, role, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM r WHERE role IS NOT NULL
GROUP BY 1, 2""")
def m07(spark, sf_dir):
    f = sp.rolling_month_folds(od_day(spark, sf_dir), "day", "1998-12-31", 3)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"),
                                         F.max("day").alias("last_day"))


# M8 ---------------------------------------------------------------------------
@register("m08_fixed_month_folds", "M8", V("od_daily") + """,
d AS (SELECT start_id AS station_id, day, sum(cnt) AS cnt FROM od_daily GROUP BY 1, 2),
folds AS (SELECT * FROM (VALUES (1, 3, [4, 5]), (2, 5, [6, 7]), (3, 7, [8, 9]), (4, 9, [10, 11, 12])) f(fold, last, valid)),
r AS (SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN month(day) <= last THEN 'train' WHEN list_contains(valid, month(day)) THEN 'valid' END AS role, d.*
      FROM d, folds WHERE year(day) = 1997)
SELECT fold, role, count(*) AS n, CAST(sum(cnt) AS DOUBLE) AS cnt, min(day) AS first_day, max(day) AS last_day FROM r WHERE role IS NOT NULL GROUP BY 1, 2""")
def m08(spark, sf_dir):
    f = sp.fixed_month_folds(od_day(spark, sf_dir), "day", 1997)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").cast("double").alias("cnt"), F.min("day").alias("first_day"),
                                         F.max("day").alias("last_day"))


# M9 ---------------------------------------------------------------------------
@register("m09_leave_years", "M9", V("od_daily") + """,
d AS (SELECT start_id AS station_id, day, sum(cnt) AS cnt FROM od_daily GROUP BY 1, 2)
SELECT CASE WHEN year(day) = 1996 THEN 'train' ELSE 'test' END AS split, count(*) AS n, sum(cnt) AS cnt
FROM d WHERE year(day) IN (1996, 1997) GROUP BY 1""")
def m09(spark, sf_dir):
    d = sp.leave_years(od_day(spark, sf_dir), "day", 1996, 1997, ["day", "station_id"])
    return d.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


# O2 / O4 / O5 -------------------------------------------------------------------
@register("o02_sort_by_abs", "O2 O1", PANEL + """
SELECT station_id, ts, net_flow FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY abs(net_flow) DESC, ts) AS rn FROM panel) x
WHERE rn <= 5""")
def o02(spark, sf_dir):
    from ..operators.windows import top_n
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "net_flow")
    return top_n(p, "station_id", [F.abs("net_flow").desc(), F.col("ts")], 5)


@register("o04_positional_slice", "O4 M38", PRED_SQL + """
SELECT station_id, ts, y - pred AS residual, abs(y - pred) AS abs_error FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts) AS rn,
         count(*) OVER (PARTITION BY station_id) AS n FROM pp) x
WHERE rn <= 3 OR rn > n - 2""")
def o04(spark, sf_dir):
    r = ev.residuals(panel_with_pred(spark, sf_dir))
    return sp.positional_slice(r, ["station_id"], ["ts"], first=3, last=2) \
        .select("station_id", "ts", "residual", "abs_error")


@register("o05_seeded_sample", "O5", check="R")
def o05(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("event_id", "start_id", "cnt")
    return sp.seeded_sample(t, ["event_id"], 100, seed=7)


@register("o05b_permute_column", "O5 X20", check="R")
def o05b(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("event_id", "start_id", "cnt")
    return sp.permute_column(t, "cnt", ["event_id"], seed=7)


# U1 / U3 / U4 / U5 -----------------------------------------------------------------
@register("u01_union_tagged", "U1", V("trips") + """
SELECT start_id AS station_id, ts, 'origin' AS tag, NULL::DOUBLE AS use_min FROM trips WHERE basis = 'dep'
UNION ALL SELECT end_id, ts, 'destination', use_min FROM trips WHERE basis = 'arr'""")
def u01(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    a = t.filter("basis = 'dep'").select(F.col("start_id").alias("station_id"), "ts", F.lit("origin").alias("tag"))
    b = t.filter("basis = 'arr'").select(F.col("end_id").alias("station_id"), "ts",
                                         F.lit("destination").alias("tag"), "use_min")
    return a.unionByName(b, allowMissingColumns=True)


@register("u03_missing_hours", "U3 A34", V("trips") + """,
h AS (SELECT DISTINCT start_id AS station_id, date_trunc('hour', ts) AS ts FROM trips),
r AS (SELECT station_id, min(ts) AS lo, max(ts) AS hi FROM h GROUP BY 1),
s AS (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM r)
SELECT s.station_id, s.ts FROM s ANTI JOIN h ON s.station_id = h.station_id AND s.ts = h.ts""")
def u03(spark, sf_dir):
    """Hours inside each station's own range with no departure: spine minus observed."""
    from ..functions.timeparts import trunc
    from ..operators.panel import densify
    h = ad.trips(spark, sf_dir).select(F.col("start_id").alias("station_id"),
                                       trunc("hour", "ts").alias("ts")).distinct()
    return densify(h, fill=None, value_cols=[]).join(h, ["station_id", "ts"], "left_anti")


@register("u04_missing_meta_fill", "U4 F19", V("trips", "stations") + """,
ids AS (SELECT DISTINCT start_id AS station_id FROM trips UNION SELECT 'ST-99'),
known AS (SELECT station_id, lcd + qr AS capacity FROM stations WHERE region <> 4)
SELECT station_id, capacity FROM known WHERE station_id IN (SELECT station_id FROM ids)
UNION ALL
SELECT station_id, 0 FROM (SELECT station_id FROM ids EXCEPT SELECT station_id FROM known) m""")
def u04(spark, sf_dir):
    from ..functions.timeparts import capacity
    t = ad.trips(spark, sf_dir).select(F.col("start_id").alias("station_id")).distinct()
    ids = t.unionByName(spark.range(1).select(F.lit("ST-99").alias("station_id"))).distinct()
    known = ad.stations(spark, sf_dir).filter("region <> 4").select(
        "station_id", capacity("lcd", "qr").alias("capacity"))
    missing = ids.exceptAll(known.select("station_id")).withColumn("capacity", F.lit(0))
    return known.join(ids, "station_id", "left_semi").unionByName(missing)


@register("u05_feature_row_overlap", "U5", PANEL + """,
a AS (SELECT DISTINCT coalesce(inflow, -9999) AS i, coalesce(outflow, -9999) AS o, hour(ts) AS h FROM panel
      WHERE ts < TIMESTAMP '2024-01-21'),
b AS (SELECT DISTINCT coalesce(inflow, -9999) AS i, coalesce(outflow, -9999) AS o, hour(ts) AS h FROM panel
      WHERE ts >= TIMESTAMP '2024-01-21')
SELECT (SELECT count(*) FROM b) AS b_rows, (SELECT count(*) FROM (SELECT * FROM b INTERSECT SELECT * FROM a) x)
         AS shared, round((SELECT count(*) FROM (SELECT * FROM b INTERSECT SELECT * FROM a) x)
                          / (SELECT count(*) FROM b), 6) AS share""")
def u05(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir)
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    cols = [F.coalesce("inflow", F.lit(-9999)).alias("i"), F.coalesce("outflow", F.lit(-9999)).alias("o"),
            F.hour("ts").alias("h")]
    a = p.filter(F.col("ts") < cut).select(*cols).distinct().withColumn("_in_a", F.lit(1))
    b = p.filter(F.col("ts") >= cut).select(*cols).distinct()
    # compare the rows themselves (not their hashes): a left join on all columns
    j = b.join(a, ["i", "o", "h"], "left").agg(F.count(F.lit(1)).alias("b_rows"),
                                               F.count("_in_a").alias("shared"))
    return j.select("b_rows", "shared", F.round(F.col("shared") / F.col("b_rows"), 6).alias("share"))


# M30 / M31 ----------------------------------------------------------------------
@register("m30_regression_metrics", "M30 M31 D3", PRED_SQL + """
SELECT station_id, round(avg(abs(y - pred)), 6) AS mae, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse,
       count(*) AS n,
       round(CASE WHEN var_pop(y) * count(*) = 0 THEN 0.0
                  ELSE 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) END, 6) AS r2
FROM pp GROUP BY 1""", check="T")
def m30(spark, sf_dir):
    m = ev.regression_metrics(panel_with_pred(spark, sf_dir), keys=["station_id"])
    return m.select("station_id", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"), "n",
                    F.round("r2", 6).alias("r2"))


@register("m32_masked_metrics", "M32", PRED_SQL + """
SELECT round(avg(abs(y - pred)) FILTER (WHERE hour(ts) IN (7, 8, 9, 17, 18, 19)), 6) AS mae_peak,
       round(sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE hour(ts) IN (7, 8, 9, 17, 18, 19))), 6) AS rmse_peak,
       round(avg(abs(y - pred)) FILTER (WHERE hour(ts) NOT IN (7, 8, 9, 17, 18, 19)), 6) AS mae_offpeak,
       round(sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE hour(ts) NOT IN (7, 8, 9, 17, 18, 19))), 6) AS rmse_offpeak,
       round(0.7 * sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE hour(ts) IN (7, 8, 9, 17, 18, 19)))
             + 0.3 * sqrt(avg((y - pred) * (y - pred)) FILTER (WHERE hour(ts) NOT IN (7, 8, 9, 17, 18, 19))), 6)
         AS weighted_rmse
FROM pp""", check="T")
def m32(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir)
    peak = F.hour("ts").isin(7, 8, 9, 17, 18, 19)
    m = ev.masked_metrics(p, {"peak": peak, "offpeak": ~peak}, weights={"peak": 0.7, "offpeak": 0.3})
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


MODELS_SQL = PANEL + """,
pl AS (SELECT station_id, ts, CAST(total_flow AS DOUBLE) AS y,
              CAST(lag(total_flow, 24) OVER w AS DOUBLE) AS p_day, CAST(lag(total_flow, 1) OVER w AS DOUBLE) AS p_hour,
              CAST(lag(total_flow, 168) OVER w AS DOUBLE) AS p_week
       FROM panel WINDOW w AS (PARTITION BY station_id ORDER BY ts)),
lm AS (SELECT station_id, ts, y, 'day' AS model, p_day AS pred, 1 AS complexity FROM pl WHERE p_week IS NOT NULL
       UNION ALL SELECT station_id, ts, y, 'hour', p_hour, 2 FROM pl WHERE p_week IS NOT NULL
       UNION ALL SELECT station_id, ts, y, 'week', p_week, 3 FROM pl WHERE p_week IS NOT NULL)"""


def model_rows(spark, sf_dir):
    from pyspark.sql import Window
    p = hourly_flow_panel(spark, sf_dir)
    w = Window.partitionBy("station_id").orderBy("ts")
    pl = p.select("station_id", "ts", F.col("total_flow").cast("double").alias("y"),
                  *[F.lag("total_flow", k).over(w).cast("double").alias(n)
                    for n, k in (("p_day", 24), ("p_hour", 1), ("p_week", 168))]).filter("p_week IS NOT NULL")
    parts = [pl.select("station_id", "ts", "y", F.lit(m).alias("model"), F.col(c).alias("pred"),
                       F.lit(cx).alias("complexity"))
             for m, c, cx in (("day", "p_day", 1), ("hour", "p_hour", 2), ("week", "p_week", 3))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("m33_rank_sum_choice", "M33 W16", MODELS_SQL + """,
e AS (SELECT station_id, model, max(complexity) AS complexity, round(sqrt(avg((y - pred) * (y - pred))), 9) AS rmse,
             round(avg(abs(y - pred)), 9) AS mae, stddev_samp(y) AS y_std, avg(y) AS y_mean FROM lm GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY station_id ORDER BY rmse) AS rmse_rank,
             rank() OVER (PARTITION BY station_id ORDER BY mae) AS mae_rank FROM e),
s AS (SELECT *, CAST(rmse_rank + mae_rank + 0.5 * complexity AS DOUBLE) AS score FROM r)
SELECT station_id, model, round(rmse / y_std, 6) AS rel_rmse, round(mae / y_mean, 6) AS rel_mae, score,
       CAST(rank() OVER (PARTITION BY station_id ORDER BY score) AS INTEGER) AS choice_rank
FROM s""", check="T")
def m33(spark, sf_dir):
    lm = model_rows(spark, sf_dir)
    e = lm.groupBy("station_id", "model").agg(F.max("complexity").alias("complexity"))
    rel = ev.relative_errors(lm, ["station_id", "model"])
    rel = rel.withColumns({"rmse": F.round("rmse", 9), "mae": F.round("mae", 9)}).join(e, ["station_id", "model"])
    ch = ev.rank_sum_choice(rel, ["station_id"], ["rmse", "mae"], complexity="complexity", penalty=0.5)
    return ch.select("station_id", "model", F.round("rel_rmse", 6).alias("rel_rmse"),
                     F.round("rel_mae", 6).alias("rel_mae"), "score", "choice_rank")


@register("m34_generalisation_gaps", "M34 M1 M31", PRED_SQL + """,
s AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'train' WHEN ts < TIMESTAMP '2024-01-22' THEN 'valid'
                     ELSE 'test' END AS split FROM pp),
m AS (SELECT station_id, split, CASE WHEN var_pop(y) * count(*) = 0 THEN 0.0
                                     ELSE 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) END AS r2
      FROM s GROUP BY 1, 2),
w AS (SELECT station_id, max(r2) FILTER (WHERE split = 'train') AS tr, max(r2) FILTER (WHERE split = 'valid') AS va,
             max(r2) FILTER (WHERE split = 'test') AS te FROM m GROUP BY 1)
SELECT station_id, round(tr - te, 6) AS gap_train_test, round(va - te, 6) AS gap_valid_test FROM w""", check="T")
def m34(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir).withColumn(
        "split", sp.split_by_dates("ts", F.lit("2024-01-15").cast("timestamp_ntz"),
                                   F.lit("2024-01-22").cast("timestamp_ntz")))
    m = ev.regression_metrics(p, keys=["station_id", "split"])
    w = m.groupBy("station_id").pivot("split", ["train", "valid", "test"]).agg(F.first("r2"))
    g = ev.generalisation_gaps("train", "valid", "test")
    return w.select("station_id", *[F.round(v, 6).alias(k) for k, v in g.items()])


CLS_SQL = PRED_SQL + """,
c AS (SELECT station_id, ts, CAST(y > 0 AS INTEGER) AS label, CAST(pred > 0 AS INTEGER) AS pred_label,
             pred / (pred + 1) AS prob FROM pp)"""


@register("m35_classification_metrics", "M35", CLS_SQL + """,
k AS (SELECT station_id, count(*) FILTER (WHERE label = 1 AND pred_label = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND pred_label = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND pred_label = 0) AS fn,
             count(*) FILTER (WHERE label = 0 AND pred_label = 0) AS tn FROM c GROUP BY 1),
m AS (SELECT *, CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS accuracy,
             CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM k)
SELECT station_id, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1
FROM m""", check="T")
def m35(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir).select("station_id", (F.col("y") > 0).cast("int").alias("label"),
                                              (F.col("pred") > 0).cast("int").alias("pred_label"))
    m = ev.classification_metrics(p, keys=["station_id"])
    return m.select("station_id", "tp", "fp", "fn", "tn",
                    *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("m36_roc_auc", "M36 W20", CLS_SQL + """,
r AS (SELECT station_id, label, rank() OVER (PARTITION BY station_id ORDER BY prob)
             + (count(*) OVER (PARTITION BY station_id, prob) - 1) / 2.0 AS rk FROM c),
s AS (SELECT station_id, sum(rk) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS np,
             count(*) FILTER (WHERE label = 0) AS nn FROM r GROUP BY 1)
SELECT station_id, round(CASE WHEN np = 0 OR nn = 0 THEN NULL ELSE (rs - np * (np + 1) / 2.0) / (np * nn) END, 6) AS auc
FROM s""", check="T")
def m36(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir).select(
        "station_id", (F.col("y") > 0).cast("int").alias("label"),
        (F.col("pred") / (F.col("pred") + 1)).alias("prob"))
    a = ev.roc_auc(p, keys=["station_id"])
    return a.select("station_id", F.round("auc", 6).alias("auc"))


@register("m29_baselines", "M29", PANEL + """,
tr AS (SELECT avg(total_flow) AS m FROM panel WHERE ts < TIMESTAMP '2024-01-21'),
te AS (SELECT station_id, ts, CAST(total_flow AS DOUBLE) AS y,
              CAST(lag(total_flow) OVER (PARTITION BY station_id ORDER BY ts) AS DOUBLE) AS pred_prev
       FROM panel),
t2 AS (SELECT * FROM te WHERE ts >= TIMESTAMP '2024-01-21')
SELECT round(avg(abs(y - m)), 6) AS mae_mean, round(avg(abs(y - pred_prev)), 6) AS mae_prev FROM t2, tr""",
          check="T")
def m29(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", F.col("total_flow").cast("double").alias("y"))
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    mean = p.filter(F.col("ts") < cut).agg(F.avg("y")).first()[0]
    b = ev.baselines(p, "y", train_mean=mean).filter(F.col("ts") >= cut)
    return b.agg(F.round(F.avg(F.abs(F.col("y") - F.col("pred_mean"))), 6).alias("mae_mean"),
                 F.round(F.avg(F.abs(F.col("y") - F.col("pred_prev"))), 6).alias("mae_prev"))
