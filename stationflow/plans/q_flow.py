"""Flow queries: the minimum slice and the 2.5 aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import trunc

from ..operators import flow, panel, windows
from ..sources import adapter as ad
from ..operators.inventory import residual_buffer
from .catalog import register

V = ad.with_views


def hourly_flow_panel(spark, sf_dir, trips=None):
    """trips -> G5 -> A2 -> G1 -> A3 -> W1: net flow per station and hour, no gaps."""
    t = trips if trips is not None else ad.trips(spark, sf_dir)
    ex = flow.explode_by_station(t)
    dense = panel.densify(flow.role_flow(ex), value_cols=["inflow", "outflow"])
    out = flow.add_flow_totals(dense)
    return windows.add_lags(out, "total_flow", [1, 24])


EXPLODE_SQL = """
ex AS (SELECT *, CASE WHEN start_id = station_id AND end_id = station_id THEN 'both'
                      WHEN start_id = station_id THEN 'start' ELSE 'end' END AS role
       FROM (SELECT *, unnest(list_distinct([start_id, end_id])) AS station_id FROM trips) u
       WHERE station_id IS NOT NULL)"""

HOURLY_SQL = EXPLODE_SQL + """,
hf AS (SELECT station_id, date_trunc('hour', ts) AS ts,
              count(*) FILTER (WHERE role IN ('end', 'both')) AS inflow,
              count(*) FILTER (WHERE role IN ('start', 'both')) AS outflow
       FROM ex GROUP BY 1, 2),
rng AS (SELECT station_id, min(ts) AS lo, max(ts) AS hi FROM hf GROUP BY 1),
spine AS (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM rng),
panel AS (SELECT s.station_id, s.ts, coalesce(h.inflow, 0) AS inflow, coalesce(h.outflow, 0) AS outflow,
                 coalesce(h.inflow, 0) + coalesce(h.outflow, 0) AS total_flow,
                 coalesce(h.inflow, 0) - coalesce(h.outflow, 0) AS net_flow
          FROM spine s LEFT JOIN hf h ON s.station_id = h.station_id AND s.ts = h.ts)"""

register("g1_hourly_flow_panel", "G5 A2 G1 A3 W1 J7 D1", V("trips") + "," + HOURLY_SQL + """
SELECT *, lag(total_flow, 1) OVER w AS total_flow_lag1, lag(total_flow, 24) OVER w AS total_flow_lag24
FROM panel WINDOW w AS (PARTITION BY station_id ORDER BY ts)""")(hourly_flow_panel)


# ---------------------------------------------------------------------------
# Shared Spark inputs
# ---------------------------------------------------------------------------
def trips_weather(spark, sf_dir):
    """Trips with the weather of their hour (left join on the hour key).

    The weather side is derived (one row per hour of the calendar); it gets no hint,
    so no extra job sizes it up front: AQE turns the join into a broadcast at run
    time from the materialised size, and keeps the shuffle join beyond that."""
    t = ad.trips(spark, sf_dir).withColumn("hour_ts", trunc("hour", "ts"))
    w = ad.weather(spark, sf_dir).withColumnRenamed("ts", "hour_ts")
    return t.join(w, "hour_ts", "left")


TW_SQL = """tw AS (SELECT t.*, date_trunc('hour', t.ts) AS hour_ts, w.temp, w.humidity, w.rain
        FROM trips t LEFT JOIN weather w ON date_trunc('hour', t.ts) = w.ts)"""

PANEL = V("trips") + "," + HOURLY_SQL


def _station_by_basis():
    return F.when(F.col("basis") == "dep", F.col("start_id")).otherwise(F.col("end_id"))


ST_BY_BASIS_SQL = "CASE WHEN basis = 'dep' THEN start_id ELSE end_id END"


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# A1 ---------------------------------------------------------------------------
@register("a1_hourly_departures", "A1 J1", V("trips", "weather") + "," + TW_SQL + """
SELECT start_id AS station_id, hour_ts AS ts, sum(cnt) AS departures,
       round(avg(temp), 6) AS temp, round(avg(humidity), 6) AS humidity
FROM tw GROUP BY 1, 2""", check="T")
def a1(spark, sf_dir):
    d = flow.hourly_departures(trips_weather(spark, sf_dir), ["temp", "humidity"])
    return d.withColumns({"temp": r6("temp"), "humidity": r6("humidity")})


# A4 / J3 -------------------------------------------------------------------------
@register("a4_two_sided_flow", "A4 J3", V("trips") + """,
r AS (SELECT start_id AS station_id, date_trunc('hour', ts) AS ts, sum(cnt) AS rentals
      FROM trips WHERE basis = 'dep' GROUP BY 1, 2),
b AS (SELECT end_id AS station_id, date_trunc('hour', ts) AS ts, sum(cnt) AS returns
      FROM trips WHERE basis = 'arr' GROUP BY 1, 2)
SELECT coalesce(r.station_id, b.station_id) AS station_id, coalesce(r.ts, b.ts) AS ts,
       coalesce(rentals, 0.0) AS rentals, coalesce(returns, 0.0) AS returns,
       coalesce(rentals, 0.0) - coalesce(returns, 0.0) AS net_out
FROM r FULL OUTER JOIN b ON r.station_id = b.station_id AND r.ts = b.ts""")
def a4(spark, sf_dir):
    return flow.two_sided_flow(ad.trips(spark, sf_dir))


# A5 ---------------------------------------------------------------------------
@register("a5_signed_count", "A5", V("trips") + f"""
SELECT {ST_BY_BASIS_SQL} AS station_id, date_trunc('hour', ts) AS ts,
       sum(CASE WHEN basis = 'dep' THEN -cnt ELSE cnt END) AS signed_cnt
FROM trips GROUP BY 1, 2""")
def a5(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    return flow.signed_count(t, [_station_by_basis().alias("station_id"),
                                 trunc("hour", "ts").alias("ts")])


# A6 ---------------------------------------------------------------------------
@register("a6_net_by_pivot", "A6 A40", V("trips") + f"""
SELECT station_id, ts, arr, dep, arr - dep AS net FROM (
  SELECT {ST_BY_BASIS_SQL} AS station_id, date_trunc('hour', ts) AS ts,
         count(*) FILTER (WHERE basis = 'arr') AS arr, count(*) FILTER (WHERE basis = 'dep') AS dep
  FROM trips GROUP BY 1, 2) g""")
def a6(spark, sf_dir):
    t = ad.trips(spark, sf_dir).withColumns({"station_id": _station_by_basis(),
                                             "hts": trunc("hour", "ts")})
    out = flow.net_by_pivot(t, ["station_id", "hts"], cnt=None)
    return out.withColumnRenamed("hts", "ts")


# A7 ---------------------------------------------------------------------------
@register("a7_first_non_null", "A7", V("trips", "weather") + "," + TW_SQL + """
SELECT start_id AS station_id, arg_min(temp, (ts, event_id)) AS temp
FROM tw WHERE temp IS NOT NULL GROUP BY 1""")
def a7(spark, sf_dir):
    tw = trips_weather(spark, sf_dir).withColumnRenamed("start_id", "station_id")
    return flow.first_non_null(tw, ["station_id"], "temp", ["ts", "event_id"])


# A8 ---------------------------------------------------------------------------
ARR_TS_SQL = "ts + to_microseconds(CAST(round(use_min * 60000000.0) AS BIGINT))"


@register("a8_event_deltas", "A8 P6", V("trips") + f"""
SELECT start_id AS station_id, ts AS event_time, -cnt AS delta FROM trips
UNION ALL
SELECT end_id, {ARR_TS_SQL}, cnt FROM trips""")
def a8(spark, sf_dir):
    from ..functions.timeparts import add_minutes
    t = ad.trips(spark, sf_dir).withColumn("arr_ts", add_minutes("ts", "use_min"))
    return flow.event_deltas(t, "ts", "arr_ts")


# A9 ---------------------------------------------------------------------------
@register("a9_trip_profile", "A9 P16 P17", V("trips") + """
SELECT CAST(isodow(base_date) >= 6 AS INTEGER) AS weekend, hour,
       CAST(hour IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS commute,
       count(*) AS trips, sum(cnt) AS cnt, round(avg(use_min), 6) AS mean_min
FROM trips GROUP BY 1, 2, 3""", check="T")
def a9(spark, sf_dir):
    from ..functions import timeparts as tp
    t = ad.trips(spark, sf_dir)
    return (t.groupBy(tp.weekend_flag("base_date").alias("weekend"), "hour",
                      tp.hour_in("hour", [7, 8, 9, 17, 18, 19]).alias("commute"))
            .agg(F.count(F.lit(1)).alias("trips"), F.sum("cnt").alias("cnt"),
                 F.round(F.avg("use_min"), 6).alias("mean_min")))


# A10 --------------------------------------------------------------------------
@register("a10_multi_agg", "A10", V("trips") + """
SELECT start_id, sum(cnt) AS cnt_sum, round(avg(cnt), 6) AS cnt_mean, max(cnt) AS cnt_max,
       min(cnt) AS cnt_min, arg_min(use_min, (ts, event_id)) AS use_min_first,
       arg_max(use_min, (ts, event_id)) AS use_min_last
FROM trips GROUP BY 1""", check="T")
def a10(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    out = flow.group_agg(t, ["start_id"], {"__order__": ["ts", "event_id"],
                                           "cnt": ["sum", "mean", "max", "min"],
                                           "use_min": ["first", "last"]})
    return out.withColumn("cnt_mean", r6("cnt_mean"))


# A11 --------------------------------------------------------------------------
@register("a11_block_3h", "A11 P11", PANEL + """
SELECT station_id, time_bucket(INTERVAL 3 HOUR, ts) AS block_start,
       CAST(sum(inflow) AS BIGINT) AS inflow_sum, round(avg(total_flow), 6) AS total_flow_mean,
       max(net_flow) AS net_flow_max, arg_min(outflow, ts) AS outflow_first
FROM panel GROUP BY 1, 2""", check="T")
def a11(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir)
    out = flow.block_agg(p, 3, {"__order__": ["ts"], "inflow": ["sum"], "total_flow": ["mean"],
                                "net_flow": ["max"], "outflow": ["first"]})
    return out.withColumn("total_flow_mean", r6("total_flow_mean"))


# A15 --------------------------------------------------------------------------
@register("a15_week_hour_totals", "A15 P9", PANEL + """
SELECT station_id, CAST(isoyear(ts) AS VARCHAR) || '-' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS iso_week,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(sum(total_flow) AS BIGINT) AS total_flow
FROM panel GROUP BY 1, 2, 3""")
def a15(spark, sf_dir):
    from ..functions.timeparts import iso_year_week
    p = hourly_flow_panel(spark, sf_dir)
    return p.groupBy("station_id", iso_year_week("ts").alias("iso_week"),
                     F.hour("ts").alias("hour")).agg(F.sum("total_flow").alias("total_flow"))


# A16 / C1 -----------------------------------------------------------------------
OD_DAY_SQL = """od_day AS (SELECT start_id AS station_id, day, sum(cnt) AS cnt FROM od_daily GROUP BY 1, 2)"""


def od_day(spark, sf_dir):
    return ad.od_daily(spark, sf_dir).groupBy(F.col("start_id").alias("station_id"), "day") \
        .agg(F.sum("cnt").alias("cnt"))


@register("a16_month_weekday_profile", "A16 C1", V("od_daily") + "," + OD_DAY_SQL + """
SELECT station_id, CAST(month(day) AS INTEGER) AS month, CAST(isodow(day) - 1 AS INTEGER) AS weekday,
       round(avg(cnt), 6) AS mean_cnt
FROM od_day GROUP BY 1, 2, 3""", check="T")
def a16(spark, sf_dir):
    d = od_day(spark, sf_dir)
    return d.groupBy("station_id", F.month("day").alias("month"), F.weekday("day").alias("weekday")) \
        .agg(F.round(F.avg("cnt"), 6).alias("mean_cnt"))


# A17 --------------------------------------------------------------------------
@register("a17_month_week_sums", "A17 P10", V("od_daily") + """
SELECT start_id AS station_id, strftime(day, '%Y-%m') AS ym,
       CAST(floor((day(day) - 1) / 7) + 1 AS INTEGER) AS week_of_month, sum(cnt) AS cnt
FROM od_daily GROUP BY 1, 2, 3""")
def a17(spark, sf_dir):
    from ..functions.timeparts import week_of_month, year_month_label
    od = ad.od_daily(spark, sf_dir)
    return od.groupBy(F.col("start_id").alias("station_id"), year_month_label("day").alias("ym"),
                      week_of_month("day").alias("week_of_month")).agg(F.sum("cnt").alias("cnt"))


# A18 --------------------------------------------------------------------------
@register("a18_daily_resample", "A18", V("trips") + """,
d AS (SELECT start_id AS station_id, CAST(ts AS DATE) AS day, sum(cnt) AS cnt FROM trips GROUP BY 1, 2),
r AS (SELECT station_id, min(day) AS lo, max(day) AS hi FROM d GROUP BY 1),
s AS (SELECT station_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM r)
SELECT s.station_id, s.day, coalesce(d.cnt, 0.0) AS cnt, CAST(date_trunc('month', s.day) AS DATE) AS month
FROM s LEFT JOIN d ON s.station_id = d.station_id AND s.day = d.day""")
def a18(spark, sf_dir):
    t = ad.trips(spark, sf_dir).withColumnRenamed("start_id", "station_id")
    return flow.daily_resample(t, "cnt")


# A19 --------------------------------------------------------------------------
@register("a19_quarter_totals", "A19 A41", V("od_daily") + """
SELECT start_id AS station_id, CAST(year(day) AS INTEGER) AS year, sum(cnt) AS annual_total FROM od_daily
GROUP BY 1, 2""")
def a19(spark, sf_dir):
    od = ad.od_daily(spark, sf_dir).withColumns({"q": F.quarter("day"), "year": F.year("day")})
    # wide quarter columns per (station, year), as the station table carries them
    wide = od.groupBy(F.col("start_id").alias("station_id"), "year").pivot("q", [1, 2, 3, 4]).sum("cnt")
    wide = wide.select("station_id", "year", *[F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"q{i}_total")
                                               for i in range(1, 5)])
    return flow.quarter_totals(wide, ["station_id", "year"], [f"q{i}_total" for i in range(1, 5)])


# A20 --------------------------------------------------------------------------
@register("a20_cluster_summary", "A20", V("stations") + """
SELECT region, count(*) AS n, CAST(sum(lcd) AS BIGINT) AS lcd_sum, round(avg(lat), 6) AS lat_mean
FROM stations GROUP BY 1""", check="T")
def a20(spark, sf_dir):
    s = ad.stations(spark, sf_dir)
    return s.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("lcd").alias("lcd_sum"),
                                   F.round(F.avg("lat"), 6).alias("lat_mean"))


# A21 --------------------------------------------------------------------------
@register("a21_key_usage", "A21 P37", V("od_daily") + """
SELECT start_id, day, CAST(round_even(sum(cnt), 0) AS BIGINT) AS usage FROM od_daily GROUP BY 1, 2""")
def a21(spark, sf_dir):
    return flow.key_usage(ad.od_daily(spark, sf_dir), ["start_id", "day"])


# A22 --------------------------------------------------------------------------
@register("a22_distinct_rows", "A22", V("trips") + """
SELECT DISTINCT start_id, end_id, basis, hour FROM trips""")
def a22(spark, sf_dir):
    return ad.trips(spark, sf_dir).select("start_id", "end_id", "basis", "hour").dropDuplicates()


# A23 / U2 -------------------------------------------------------------------------
@register("a23_first_by_key", "A23 W17", V("trips") + """
SELECT event_id, start_id, ts, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY start_id ORDER BY ts, event_id) AS rn FROM trips) x
WHERE rn = 1""")
def a23(spark, sf_dir):
    from ..operators.cleanse import first_by_key
    t = ad.trips(spark, sf_dir).select("event_id", "start_id", "ts", "cnt")
    return first_by_key(t, ["start_id"], [F.col("ts"), F.col("event_id")])


# A24 --------------------------------------------------------------------------
@register("a24_duplicate_counts", "A24", V("trips") + """
SELECT count(*) - count(DISTINCT (start_id, end_id, basis, hour)) AS dup_rows,
       count(*) - count(DISTINCT (start_id, hour)) AS dup_keys
FROM trips""")
def a24(spark, sf_dir):
    t = ad.trips(spark, sf_dir).select("start_id", "end_id", "basis", "hour")
    return flow.duplicate_counts(t, ["start_id", "hour"])


# A25 --------------------------------------------------------------------------
@register("a25_distinct_count_list", "A25", V("trips") + """
SELECT start_id, count(DISTINCT end_id) AS n_dest, list_sort(list_distinct(list(end_id))) AS dests
FROM trips GROUP BY 1""")
def a25(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    return t.groupBy("start_id").agg(F.count_distinct("end_id").alias("n_dest"),
                                     F.array_sort(F.collect_set("end_id")).alias("dests"))


# A26 --------------------------------------------------------------------------
@register("a26_value_frequency", "A26 O1", V("trips") + """
SELECT end_id, count(*) AS n FROM trips GROUP BY 1""")
def a26(spark, sf_dir):
    return flow.value_frequency(ad.trips(spark, sf_dir), "end_id")


# A27 --------------------------------------------------------------------------
@register("a27_describe", "A27", V("od_daily") + """
SELECT start_id, count(use_dist) AS count, round(avg(use_dist), 4) AS mean,
       round(stddev_samp(use_dist), 4) AS std, min(use_dist) AS min,
       round(quantile_cont(use_dist, 0.5), 4) AS p50, round(quantile_cont(use_dist, 0.9), 4) AS p90,
       round(quantile_cont(use_dist, 0.95), 4) AS p95, round(quantile_cont(use_dist, 0.99), 4) AS p99,
       max(use_dist) AS max
FROM od_daily GROUP BY 1""", check="T")
def a27(spark, sf_dir):
    d = flow.describe(ad.od_daily(spark, sf_dir), "use_dist", keys=["start_id"])
    return d.select("start_id", "count", "min", "max",
                    *[F.round(c, 4).alias(c) for c in ("mean", "std", "p50", "p90", "p95", "p99")])


# A28 --------------------------------------------------------------------------
@register("a28_exact_quantiles", "A28 M4", V("trips") + """
SELECT start_id, round(quantile_cont(use_min, 0.25), 6) AS q25, round(quantile_cont(use_min, 0.75), 6) AS q75,
       make_timestamp(CAST(floor(quantile_cont(epoch_us(ts) / 1e6, 0.8)) * 1000000 AS BIGINT)) AS ts_q80
FROM trips GROUP BY 1""", check="T")
def a28(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    from ..functions.timeparts import epoch_seconds, from_epoch_seconds
    from ..operators.splits import exact_percentiles, join_null_safe
    use = exact_percentiles(t, "use_min", [0.25, 0.75], ["start_id"], "use")
    time = exact_percentiles(t.withColumn("_t", epoch_seconds("ts")), "_t", [0.8], ["start_id"], "time")
    return join_null_safe(time, use, ["start_id"], "left").select(
        "start_id", F.round(F.col("use")[0], 6).alias("q25"), F.round(F.col("use")[1], 6).alias("q75"),
        from_epoch_seconds(F.floor(F.col("time")[0])).alias("ts_q80"))


# A29 / A37 / A39 / M29 --------------------------------------------------------------
def panel_with_pred(spark, sf_dir):
    """Panel rows with a naive forecast (same hour yesterday) as ``pred``."""
    p = hourly_flow_panel(spark, sf_dir)
    return p.filter(F.col("total_flow_lag24").isNotNull()) \
        .select("station_id", "ts", F.col("total_flow").cast("double").alias("y"),
                F.col("total_flow_lag24").cast("double").alias("pred"))


PRED_SQL = PANEL + """,
pl AS (SELECT *, lag(total_flow, 24) OVER (PARTITION BY station_id ORDER BY ts) AS lag24 FROM panel),
pp AS (SELECT station_id, ts, CAST(total_flow AS DOUBLE) AS y, CAST(lag24 AS DOUBLE) AS pred
       FROM pl WHERE lag24 IS NOT NULL)"""


@register("a29_residual_buffer", "A29", PRED_SQL + """
SELECT station_id, round(quantile_cont(greatest(y - pred, 0), 0.9), 6) AS buffer FROM pp GROUP BY 1""",
          check="T")
def a29(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir)
    return residual_buffer(p.withColumn("residual", F.col("y") - F.col("pred")), "residual", ["station_id"]) \
        .withColumn("buffer", F.round("buffer", 6))


@register("a37_error_table", "A37", PRED_SQL + """
SELECT station_id, CAST(hour(ts) AS INTEGER) AS hour, round(avg(y), 6) AS mean_actual,
       round(avg(pred), 6) AS mean_pred, round(avg(abs(y - pred)), 6) AS mae,
       round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse
FROM pp GROUP BY 1, 2""", check="T")
def a37(spark, sf_dir):
    p = panel_with_pred(spark, sf_dir).withColumn("hour", F.hour("ts"))
    out = flow.error_table(p, ["station_id", "hour"])
    return out.select("station_id", "hour", *[r6(c).alias(c) for c in
                                              ("mean_actual", "mean_pred", "mae", "rmse")])


@register("a39_target_diagnosis", "A39", PANEL + """
SELECT station_id, round(avg(total_flow), 6) AS mean, round(stddev_samp(total_flow), 6) AS std,
       round(avg(CASE WHEN total_flow = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_share
FROM panel GROUP BY 1""", check="T")
def a39(spark, sf_dir):
    out = flow.target_diagnosis(hourly_flow_panel(spark, sf_dir), "total_flow", ["station_id"])
    return out.select("station_id", *[r6(c).alias(c) for c in ("mean", "std", "zero_share")])


# A30 --------------------------------------------------------------------------
@register("a30_station_profile", "A30 P27", PANEL + """
SELECT station_id, round(mean_cnt, 6) AS mean_cnt, round(peak_mean, 6) AS peak_mean,
       round(CASE WHEN mean_cnt <> 0 THEN peak_mean / mean_cnt ELSE 0.0 END, 6) AS peak_ratio
FROM (SELECT station_id, avg(total_flow) AS mean_cnt,
             avg(CASE WHEN hour(ts) IN (7, 8, 9, 17, 18, 19) THEN total_flow END) AS peak_mean
      FROM panel GROUP BY 1) g""", check="T")
def a30(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir).withColumn("hour", F.hour("ts"))
    out = flow.station_profile(p, "total_flow", [7, 8, 9, 17, 18, 19])
    return out.select("station_id", *[r6(c).alias(c) for c in ("mean_cnt", "peak_mean", "peak_ratio")])


# A34 --------------------------------------------------------------------------
@register("a34_coverage", "A34 U3", V("trips") + """
SELECT start_id AS station_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month,
       count(DISTINCT date_trunc('hour', ts)) AS observed,
       CAST(date_diff('hour', date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) + 1 AS BIGINT) AS full_hours,
       CAST(date_diff('hour', date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) + 1 AS BIGINT)
         - count(DISTINCT date_trunc('hour', ts)) AS missing,
       count(DISTINCT date_trunc('hour', ts)) /
         (date_diff('hour', date_trunc('hour', min(ts)), date_trunc('hour', max(ts))) + 1) AS coverage
FROM trips GROUP BY 1, 2""")
def a34(spark, sf_dir):
    t = ad.trips(spark, sf_dir).withColumnRenamed("start_id", "station_id")
    return flow.coverage(t, by_month=True)


# A35 --------------------------------------------------------------------------
@register("a35_quality_summary", "A35", V("trips", "weather") + "," + TW_SQL + """
SELECT metric, value FROM (
  SELECT count(*) AS rows, count(DISTINCT start_id) AS stations,
         count(*) FILTER (WHERE temp IS NULL) AS null__temp,
         count(*) FILTER (WHERE use_min IS NULL) AS null__use_min,
         count(*) FILTER (WHERE end_id IS NULL) AS null__end_id FROM tw) s
UNPIVOT (value FOR metric IN (rows, stations, null__temp, null__use_min, null__end_id))""")
def a35(spark, sf_dir):
    tw = trips_weather(spark, sf_dir).select(F.col("start_id").alias("station_id"), "temp",
                                             "use_min", "end_id")
    out = flow.quality_summary(tw)
    return out.withColumn("metric", F.regexp_replace("metric", "^stations$", "stations")) \
        .filter(F.col("metric") != "null__station_id")


# A36 --------------------------------------------------------------------------
@register("a36_range_summary", "A36 M1", V("trips") + """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'train' ELSE 'test' END AS split,
       min(ts) AS start, max(ts) AS "end", count(*) AS rows, round(avg(cnt), 6) AS target_mean
FROM trips GROUP BY 1""", check="T")
def a36(spark, sf_dir):
    t = ad.trips(spark, sf_dir).withColumn(
        "split", F.when(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), "train").otherwise("test"))
    return flow.range_summary(t, "split", "ts", "cnt").withColumn("target_mean", r6("target_mean"))


# A38 --------------------------------------------------------------------------
@register("a38_baseline_profile", "A38 M29 J1", PANEL + """,
tr AS (SELECT * FROM panel WHERE ts < TIMESTAMP '2024-01-21'),
te AS (SELECT * FROM panel WHERE ts >= TIMESTAMP '2024-01-21'),
prof AS (SELECT station_id, hour(ts) AS h, isodow(ts) AS d, avg(total_flow) AS gm FROM tr GROUP BY 1, 2, 3),
g AS (SELECT avg(total_flow) AS glob FROM tr)
SELECT te.station_id, te.ts, te.total_flow,
       round(greatest(coalesce(prof.gm, g.glob), 0.0), 6) AS baseline
FROM te LEFT JOIN prof ON te.station_id = prof.station_id AND hour(te.ts) = prof.h AND isodow(te.ts) = prof.d,
     g""", check="T")
def a38(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "total_flow") \
        .withColumns({"h": F.hour("ts"), "d": F.weekday("ts")})
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    out = flow.baseline_profile(p.filter(F.col("ts") < cut), p.filter(F.col("ts") >= cut),
                                ["station_id", "h", "d"], "total_flow")
    return out.select("station_id", "ts", "total_flow", r6("baseline").alias("baseline"))


# A40 --------------------------------------------------------------------------
@register("a40_pivot_hours", "A40", PANEL + """
SELECT station_id, """ + ", ".join(
    f'CAST(coalesce(sum(total_flow) FILTER (WHERE hour(ts) = {h}), 0) AS BIGINT) AS "{h}"' for h in range(24)) + """
FROM panel GROUP BY 1""")
def a40(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir).withColumn("hour", F.hour("ts"))
    w = p.groupBy("station_id").pivot("hour", list(range(24))).sum("total_flow")
    return w.fillna(0, subset=[str(h) for h in range(24)])


# Streaming --------------------------------------------------------
@register("st1_stream_hourly_flow", "A2 A3 G5", V("trips") + "," + EXPLODE_SQL + """
SELECT station_id, date_trunc('hour', ts) AS ts,
       count(*) FILTER (WHERE role IN ('end', 'both')) AS inflow,
       count(*) FILTER (WHERE role IN ('start', 'both')) AS outflow,
       count(*) FILTER (WHERE role IN ('end', 'both')) + count(*) FILTER (WHERE role IN ('start', 'both')) AS total_flow,
       count(*) FILTER (WHERE role IN ('end', 'both')) - count(*) FILTER (WHERE role IN ('start', 'both')) AS net_flow
FROM ex GROUP BY 1, 2""")
def st1(spark, sf_dir):
    """The events table read as a file stream, hourly flow appended per closed hour.
    With ``availableNow`` the final watermark flush emits every hour."""
    from ..sources.readers import scratch_path
    from ..sources.tables import table_path
    from ..streaming.hourly import hourly_flow_stream, run_available_now
    ev_schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    src = spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    trips = src.select(
        "event_id",
        F.concat(F.lit("ST-"), (F.col("user_id") % ad.N_STATIONS).cast("string")).alias("start_id"),
        F.concat(F.lit("ST-"), ((F.col("event_id") * 7 + 3) % ad.N_STATIONS).cast("string")).alias("end_id"),
        F.col("ts").cast("timestamp_ltz").alias("ts"))  # event time must be zoned (UTC session)
    stream = hourly_flow_stream(trips)
    out = run_available_now(spark, stream, scratch_path(spark, "st1_sink"), scratch_path(spark, "st1_ckpt"))
    return out.select("station_id", "ts", "inflow", "outflow", "total_flow", "net_flow")
