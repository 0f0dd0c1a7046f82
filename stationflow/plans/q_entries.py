"""End-to-end build queries and the remaining join forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import adapter as ad
from . import entries
from .catalog import register
from .q_cleanse import TARGETS, TSQL
from .q_diagnose import FF_SQL, feature_frame
from .q_flow import HOURLY_SQL, PANEL, hourly_flow_panel
from .q_geo import G12_CTES, G13_CTES
from .q_inventory import PROJ_SQL, panel_with_capacity
from .q_panel import TEMP_SRC_SQL, temp_lookup

V = ad.with_views
R6 = ["temp_lag_1h", "month_sin", "month_cos", "residential", "business", "tourism", "transit_index",
      "commute_in_index", "commute_out_index"]


@register("g20_station_feature_table", "G20 P13 P14 P16 P17 G7 G12 G13 J1", V(
    "trips", "stations", "weather", "subway_points", "subway_daily", "region_month") + "," + HOURLY_SQL
    + TEMP_SRC_SQL + ", " + G12_CTES + "," + G13_CTES + """
SELECT p.station_id, p.ts, p.inflow, p.outflow, p.total_flow, p.net_flow, """ + ", ".join(
    f"CAST(isodow(p.ts) - 1 = {i} AS INTEGER) AS dow_{i}" for i in range(7)) + """,
       CAST(isodow(p.ts) >= 6 AS INTEGER) AS resting_day,
       CAST(hour(p.ts) IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS rush,
       round(sin(2 * pi() * (month(p.ts) - 1) / 12.0), 6) AS month_sin,
       round(cos(2 * pi() * (month(p.ts) - 1) / 12.0), 6) AS month_cos,
       round(tl.temp, 6) AS temp_lag_1h,
       round(coalesce(regf.residential, 0.0), 6) AS residential, round(coalesce(regf.business, 0.0), 6) AS business,
       round(coalesce(regf.tourism, 0.0), 6) AS tourism, round(coalesce(subf.transit_index, 0.0), 6) AS transit_index,
       round(coalesce(subf.commute_in_index, 0.0), 6) AS commute_in_index,
       round(coalesce(subf.commute_out_index, 0.0), 6) AS commute_out_index
FROM panel p LEFT JOIN tlook tl ON tl.ts = p.ts - INTERVAL 1 HOUR
     LEFT JOIN regf ON regf.station_id = p.station_id AND regf.month = month(p.ts)
     LEFT JOIN subf ON subf.station_id = p.station_id""", check="T")
def g20(spark, sf_dir):
    out = entries.station_feature_table(spark, sf_dir, temp_lookup(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in R6})


# The subway table of the test data ends in 1998: its days are moved to those of the trips.
SUBWAY_YEARS = 27
R_TRIP = ["month_sin", "month_cos", "hour_sin", "hour_cos", "station_lat", "station_lon", *entries.CONTEXT]
HOLIDAYS = ["2024-01-01"]


@register("g20_trip_station_features", "G20 F4 G5 G7 P12 P13 P14 P16 P17 P18 P21", (V(
    "trips", "stations", "weather", "subway_points", "subway_daily", "region_month") + "," + HOURLY_SQL + TEMP_SRC_SQL + ", " + G12_CTES + ","
    + G13_CTES).replace("CAST(o_orderdate AS DATE) AS day", f"CAST(CAST(o_orderdate AS DATE) + INTERVAL {SUBWAY_YEARS} YEAR AS DATE) AS day") + f""",
kept AS (SELECT t.*, CASE WHEN w.temp < 50 THEN w.rain END AS snow FROM trips t LEFT JOIN weather w ON w.ts = date_trunc('hour', t.ts)
         WHERE (start_id IN {TSQL} OR end_id IN {TSQL}) AND use_dist > 50),
ends AS (SELECT *, unnest(list_distinct([start_id, end_id])) AS station_id FROM kept),
x AS (SELECT *, CASE WHEN start_id = station_id AND end_id = station_id THEN 'both' WHEN start_id = station_id THEN 'start' ELSE 'end' END AS role
      FROM ends WHERE station_id IN {TSQL})
SELECT x.event_id, x.station_id, x.start_id, x.end_id, x.basis, x.use_min, x.use_dist, x.ts, x.base_date, x.role, x.hour,
       CAST(year(x.ts) AS INTEGER) AS year, CAST(month(x.ts) AS INTEGER) AS month,
       round(sin(2 * pi() * (month(x.ts) - 1) / 12.0), 6) + 0.0 AS month_sin, round(cos(2 * pi() * (month(x.ts) - 1) / 12.0), 6) + 0.0 AS month_cos,
       """ + ", ".join(f"CAST(isodow(x.ts) - 1 = {i} AS INTEGER) AS weekday_{i}" for i in range(7)) + """,
       CAST(isodow(x.ts) >= 6 OR x.base_date = DATE '2024-01-01' AS INTEGER) AS is_restingday,
       round(sin(2 * pi() * x.hour / 24.0), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * x.hour / 24.0), 6) + 0.0 AS hour_cos,
       CAST(x.hour >= 12 AS INTEGER) AS is_noon, CAST(x.hour IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rushhour,
       CAST(coalesce(x.snow > 0, false) AS INTEGER) AS snow_flag, round(s.lat, 6) AS station_lat, round(s.lon, 6) AS station_lon, s.dong AS station_dong,
       round(coalesce(tl.temp, 0.0), 6) AS temp_lag_1hr, round(coalesce(regf.residential, 0.0), 6) AS residential,
       round(coalesce(regf.business, 0.0), 6) AS business, round(coalesce(regf.tourism, 0.0), 6) AS tourism,
       round(coalesce(subd.transit_index, 0.0), 6) AS transit_index, round(coalesce(subd.commute_in_index, 0.0), 6) AS commute_in_index,
       round(coalesce(subd.commute_out_index, 0.0), 6) AS commute_out_index
FROM x LEFT JOIN tlook tl ON tl.ts = date_trunc('hour', x.ts) - INTERVAL 1 HOUR JOIN stations s ON s.station_id = x.station_id
     LEFT JOIN regf ON regf.station_id = x.station_id AND regf.month = month(x.ts)
     LEFT JOIN subd ON subd.station_id = x.station_id AND subd.day = x.base_date""", check="T")
def g20_trips(spark, sf_dir):
    w = ad.weather(spark, sf_dir).select(F.col("ts").alias("_h"), F.when(F.col("temp") < 50, F.col("rain")).alias("snow"))
    t = ad.trips(spark, sf_dir).join(w, F.date_trunc("hour", "ts") == F.col("_h"), "left").drop("_h")
    daily = ad.subway_daily(spark, sf_dir).withColumn("day", F.add_months("day", 12 * SUBWAY_YEARS))
    out = entries.trip_station_features(t, TARGETS, ad.stations(spark, sf_dir), temp_lookup(spark, sf_dir), ad.region_month(spark, sf_dir),
                                        ad.subway_points(spark, sf_dir), daily, HOLIDAYS)
    return out.withColumns({c: F.round(c, 6) for c in R_TRIP})


@register("g21_hourly_station_dataset", "G21 A23 A21 J1 J5 W8", PANEL + ", " + V("weather")[5:] + """,
feats AS (SELECT p.station_id, p.ts, p.total_flow, w.temp FROM panel p LEFT JOIN weather w ON p.ts = w.ts),
usage AS (SELECT start_id AS station_id, date_trunc('hour', ts) AS ts, CAST(round_even(sum(cnt), 0) AS BIGINT) AS usage
          FROM trips WHERE start_id IN (SELECT station_id FROM feats) GROUP BY 1, 2),
j AS (SELECT f.*, coalesce(u.usage, 0) AS usage FROM feats f
      LEFT JOIN usage u ON f.station_id = u.station_id AND f.ts = u.ts)
SELECT station_id, ts, total_flow, round(temp, 6) AS temp, usage,
       CAST(coalesce(usage - lag(usage) OVER (PARTITION BY station_id ORDER BY ts), 0) AS BIGINT) AS delta_usage
FROM j""", check="T")
def g21(spark, sf_dir):
    from ..util import bounded_broadcast
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "total_flow")
    w = ad.weather(spark, sf_dir).select("ts", "temp")
    feats = p.join(w, "ts", "left")  # derived side: AQE sizes it at run time
    out = entries.hourly_station_dataset(feats, ad.trips(spark, sf_dir))
    return out.withColumn("temp", F.round("temp", 6))


@register("g22_forecasting_dataset", "G22 P12 P35", FF_SQL + ", " + V("stations")[5:] + """
SELECT ff.station_id, ff.ts, ff.y, ff.total_lag1, ff.total_lag24, ff.roll3, s.lcd + s.qr AS capacity, s.region,
       round(sin(2 * pi() * hour(ff.ts) / 24.0), 6) AS hour_sin,
       round(cos(2 * pi() * hour(ff.ts) / 24.0), 6) + 0.0 AS hour_cos,  -- -0.0 as 0.0, as Spark's round gives
       round(sin(2 * pi() * (isodow(ff.ts) - 1) / 7.0), 6) AS dow_sin, round(cos(2 * pi() * (isodow(ff.ts) - 1) / 7.0), 6)
         AS dow_cos
FROM ff LEFT JOIN stations s ON ff.station_id = s.station_id""", check="T")
def g22(spark, sf_dir):
    ff = feature_frame(spark, sf_dir).select("station_id", "ts", "y", "total_lag1", "total_lag24", "roll3")
    out = entries.forecasting_dataset(ff, ad.stations(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")})


@register("j02_join_different_keys", "J2", V("trips", "stations") + """
SELECT t.event_id, t.end_id, s.lcd, s.region FROM trips t LEFT JOIN stations s ON t.end_id = s.station_id""")
def j02(spark, sf_dir):
    from ..util import bounded_broadcast
    t = ad.trips(spark, sf_dir).select("event_id", "end_id")
    s = ad.stations(spark, sf_dir).select("station_id", "lcd", "region")
    j = t.join(bounded_broadcast(s), t.end_id == s.station_id, "left")
    return j.drop("station_id")  # right key dropped after the expression join


@register("j04_inner_join_suffixes", "J4 J15", V("trips") + """,
a AS (SELECT start_id AS station_id, sum(cnt) AS cnt, count(*) AS n FROM trips GROUP BY 1),
b AS (SELECT end_id AS station_id, sum(cnt) AS cnt, count(*) AS n FROM trips GROUP BY 1)
SELECT a.station_id, a.cnt AS cnt_start, a.n AS n_start, b.cnt AS cnt_end, b.n AS n_end
FROM a JOIN b ON a.station_id = b.station_id""")
def j04(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    a = t.groupBy(F.col("start_id").alias("station_id")).agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("n"))
    b = t.groupBy(F.col("end_id").alias("station_id")).agg(F.sum("cnt").alias("cnt"), F.count(F.lit(1)).alias("n"))
    x, y = a.alias("x"), b.alias("y")
    j = x.join(y, F.col("x.station_id") == F.col("y.station_id"), "inner")
    return j.select(F.col("x.station_id").alias("station_id"),
                    *[F.col(f"x.{c}").alias(f"{c}_start") for c in ("cnt", "n")],
                    *[F.col(f"y.{c}").alias(f"{c}_end") for c in ("cnt", "n")])


@register("entry_b_train_frame", "C13 C15 M5", check="R")
def entry_b(spark, sf_dir):
    from .q_profiles import month_representatives
    p = hourly_flow_panel(spark, sf_dir)
    sel = month_representatives(spark, sf_dir).filter("is_representative = 1")
    return entries.entry_b_train_frame(p, sel)


@register("entry_c_risk", "I11 I13", PROJ_SQL + """
SELECT station_id, count(*) AS cycles, CAST(sum(risk) AS BIGINT) AS risk_cycles, round(avg(need), 6) AS mean_need, max(need) AS max_need,
       min(proj_min) AS min_stock, CASE WHEN max(need) FILTER (WHERE risk = 1) >= 3 THEN 'act_now'
            WHEN max(need) FILTER (WHERE risk = 1) >= 1 THEN 'review' ELSE 'watch' END AS priority
FROM proj GROUP BY 1""", check="T")
def entry_c(spark, sf_dir):
    return entries.entry_c_risk(panel_with_capacity(spark, sf_dir)).withColumn("mean_need", F.round("mean_need", 6))
