"""Panel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import trunc
from ..operators import cleanse
from ..operators import flow
from ..operators import panel as pn
from ..sources import adapter as ad
from .catalog import register
from .q_flow import EXPLODE_SQL, PANEL, hourly_flow_panel
from .q_windows import interp_sql

V = ad.with_views

HF_SQL = V("trips") + "," + EXPLODE_SQL + """,
hf AS (SELECT station_id, date_trunc('hour', ts) AS ts,
              count(*) FILTER (WHERE role IN ('end', 'both')) AS inflow,
              count(*) FILTER (WHERE role IN ('start', 'both')) AS outflow
       FROM ex GROUP BY 1, 2)"""


def _hf(spark, sf_dir):
    return flow.role_flow(flow.explode_by_station(ad.trips(spark, sf_dir)))


@register("g02_densify_common", "G2", HF_SQL + """,
g AS (SELECT min(ts) AS lo, max(ts) AS hi FROM hf),
sp AS (SELECT s.station_id, unnest(generate_series(g.lo, g.hi, INTERVAL 1 HOUR)) AS ts
       FROM (SELECT DISTINCT station_id FROM hf) s, g)
SELECT sp.station_id, sp.ts, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
FROM sp LEFT JOIN hf ON sp.station_id = hf.station_id AND sp.ts = hf.ts""")
def g02(spark, sf_dir):
    return pn.densify_common(_hf(spark, sf_dir))


@register("g03_densify_whole_days", "G3", HF_SQL + """,
r AS (SELECT station_id, date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 23 HOUR AS hi
      FROM hf GROUP BY 1),
sp AS (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM r)
SELECT sp.station_id, sp.ts, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
FROM sp LEFT JOIN hf ON sp.station_id = hf.station_id AND sp.ts = hf.ts""")
def g03(spark, sf_dir):
    return pn.densify(_hf(spark, sf_dir), whole_days=True)


@register("g04_densify_by_basis", "G4", V("trips") + """,
c AS (SELECT CASE WHEN basis = 'dep' THEN start_id ELSE end_id END AS station_id,
             date_trunc('hour', ts) AS ts, basis, sum(cnt) AS cnt FROM trips GROUP BY 1, 2, 3),
r AS (SELECT station_id, min(ts) AS lo, max(ts) AS hi FROM c GROUP BY 1),
sp AS (SELECT x.station_id, x.ts, b.basis
       FROM (SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM r) x,
            (VALUES ('dep'), ('arr')) b(basis))
SELECT sp.station_id, sp.ts, sp.basis, coalesce(cnt, 0.0) AS cnt
FROM sp LEFT JOIN c ON sp.station_id = c.station_id AND sp.ts = c.ts AND sp.basis = c.basis""")
def g04(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    st = F.when(F.col("basis") == "dep", F.col("start_id")).otherwise(F.col("end_id"))
    c = t.groupBy(st.alias("station_id"), trunc("hour", "ts").alias("ts"), "basis") \
        .agg(F.sum("cnt").alias("cnt"))
    return pn.densify_by(c, "basis", ["dep", "arr"], fill=0.0)


@register("g06_single_station_roles", "G6", V("trips") + """
SELECT CASE WHEN start_id = 'ST-7' AND end_id = 'ST-7' THEN 'both' WHEN start_id = 'ST-7' THEN 'start'
            ELSE 'end' END AS role, CAST(hour AS INTEGER) AS hour, count(*) AS n
FROM trips WHERE start_id = 'ST-7' OR end_id = 'ST-7' GROUP BY 1, 2""")
def g06(spark, sf_dir):
    x = flow.tag_single_station(ad.trips(spark, sf_dir), "ST-7")
    return x.groupBy("role", "hour").agg(F.count(F.lit(1)).alias("n"))


# G7 = U2 (two temperature sources, first wins) + spine + W15 + J13 lookup at ts - 1h
TEMP_SRC_SQL = """,
src AS (SELECT ts, temp, 0 AS prio FROM weather
        UNION ALL SELECT date_trunc('hour', ts), avg(use_min) / 10, 1 FROM trips
                  WHERE CAST(ts AS DATE) = DATE '2024-01-01' GROUP BY 1),
dedup AS (SELECT ts, temp FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY prio) AS rn FROM src) s
          WHERE rn = 1),
trg AS (SELECT min(ts) AS lo, max(ts) AS hi FROM dedup),
tsp AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM trg),
tx AS (SELECT tsp.ts, dedup.temp FROM tsp LEFT JOIN dedup ON tsp.ts = dedup.ts),
tlook AS (SELECT ts, temp_i AS temp FROM """ + interp_sql("tx", "temp", None) + " i)"


def temp_lookup(spark, sf_dir):
    """Hourly temperature series: measured weather first, the boundary source
    (trip-derived, first day only) where weather is absent; gaps interpolated."""
    w = ad.weather(spark, sf_dir).select("ts", "temp")
    t = ad.trips(spark, sf_dir).filter(F.to_date("ts") == F.lit("2024-01-01").cast("date"))
    boundary = t.groupBy(trunc("hour", "ts").alias("ts")).agg((F.avg("use_min") / 10).alias("temp"))
    dedup = cleanse.union_priority([w, boundary], ["ts"])
    sp = pn.hour_spine(dedup).join(dedup, "ts", "left")
    return pn.interpolate_linear(sp, ["temp"], "ts")


@register("g07_temp_lag_1h", "G7 J13 U2 W15", PANEL + ", " + V("weather")[5:] + TEMP_SRC_SQL + """
SELECT p.station_id, p.ts, round(l.temp, 6) AS temp_lag_1h
FROM panel p LEFT JOIN tlook l ON l.ts = p.ts - INTERVAL 1 HOUR""", check="T")
def g07(spark, sf_dir):
    look = temp_lookup(spark, sf_dir).select(F.col("ts").alias("lts"), F.col("temp").alias("temp_lag_1h"))
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts")
    # the lookup is derived (one row per calendar hour): AQE sizes it at run time
    j = p.join(look, F.col("lts") == F.col("ts") - F.expr("INTERVAL 1 HOUR"), "left")
    return j.select("station_id", "ts", F.round("temp_lag_1h", 6).alias("temp_lag_1h"))


@register("g08_weather_per_hour_all_stations", "G8 A7 W15 J1", PANEL + ", " + V("weather")[5:] + """,
tw AS (SELECT t.ts AS trip_ts, t.event_id, date_trunc('hour', t.ts) AS h, w.temp
       FROM trips t LEFT JOIN weather w ON date_trunc('hour', t.ts) = w.ts),
fh AS (SELECT h AS ts, arg_min(temp, (trip_ts, event_id)) AS temp FROM tw WHERE temp IS NOT NULL GROUP BY 1),
r2 AS (SELECT min(ts) AS lo, max(ts) AS hi FROM fh),
sp2 AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM r2),
wx AS (SELECT sp2.ts, fh.temp FROM sp2 LEFT JOIN fh ON sp2.ts = fh.ts),
wi AS (SELECT ts, temp_i AS temp FROM """ + interp_sql("wx", "temp", None) + """ i)
SELECT p.station_id, p.ts, p.total_flow, round(wi.temp, 6) AS temp
FROM panel p LEFT JOIN wi ON p.ts = wi.ts""", check="T")
def g08(spark, sf_dir):
    from .q_flow import trips_weather
    tw = trips_weather(spark, sf_dir)
    fh = flow.first_non_null(tw, ["hour_ts"], "temp", ["ts", "event_id"]).withColumnRenamed("hour_ts", "ts")
    sp = pn.hour_spine(fh).join(fh, "ts", "left")
    wi = pn.interpolate_linear(sp, ["temp"], "ts")
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "total_flow")
    return p.join(wi, "ts", "left").select(
        "station_id", "ts", "total_flow", F.round("temp", 6).alias("temp"))
