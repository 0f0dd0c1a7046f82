"""Window queries over the dense station-hour panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import panel as pn
from ..operators import windows as wn
from ..sources import adapter as ad
from .catalog import register
from .q_flow import PANEL, hourly_flow_panel

V = ad.with_views
W = "WINDOW w AS (PARTITION BY station_id ORDER BY ts)"


def _panel(spark, sf_dir):
    return hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "inflow", "outflow",
                                                   "total_flow", "net_flow")


LAGS = [1, 2, 3, 6, 8, 12, 24, 48, 72, 168]


@register("w01_lags_leads", "W1 W2 D4", PANEL + """
SELECT station_id, ts, total_flow, """ + ", ".join(
    f"lag(total_flow, {k}) OVER w AS total_flow_lag{k}" for k in LAGS) + """,
       lead(net_flow, 1) OVER w AS net_flow_lead1
FROM panel """ + W)
def w01(spark, sf_dir):
    p = _panel(spark, sf_dir).select("station_id", "ts", "total_flow", "net_flow")
    p = wn.add_lags(p, "total_flow", LAGS)
    return wn.add_leads(p, "net_flow", [1]).drop("net_flow")


def _guard_sql(fn, col, lo, hi, n, part="station_id", order="ts"):
    frame = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {lo} AND {hi})"
    return f"CASE WHEN count({col}) {frame} = {n} THEN {fn}({col}) {frame} END"


ROLL = [2, 3, 6, 8, 12, 14, 24, 48]


@register("w03_trailing_stats", "W3 W4 D2", PANEL + """
SELECT station_id, ts, """ + ", ".join(
    f"round({_guard_sql('avg', 'total_flow', f'{n} PRECEDING', '1 PRECEDING', n)}, 6) AS total_flow_roll{n}"
    for n in ROLL) + """,
       round(""" + _guard_sql("stddev_samp", "total_flow", "24 PRECEDING", "1 PRECEDING", 24) + """, 6) AS total_flow_std24
FROM panel""", check="T")
def w03(spark, sf_dir):
    p = _panel(spark, sf_dir).select("station_id", "ts", "total_flow")
    p = wn.add_trailing_means(p, "total_flow", ROLL)
    p = wn.add_trailing_std(p, "total_flow", 24)
    return p.select("station_id", "ts", *[F.round(c, 6).alias(c) for c in p.columns[3:]])


@register("w05_current_window_stats", "W5", PANEL + """
SELECT station_id, ts,
       round(""" + _guard_sql("avg", "net_flow", "2 PRECEDING", "CURRENT ROW", 3) + """, 6) AS net_flow_mean3,
       round(coalesce(""" + _guard_sql("stddev_samp", "net_flow", "2 PRECEDING", "CURRENT ROW", 3) + """, 0.0), 6) AS net_flow_sd3
FROM panel""", check="T")
def w05(spark, sf_dir):
    p = wn.add_centered_stats(_panel(spark, sf_dir).select("station_id", "ts", "net_flow"), "net_flow", 3)
    return p.select("station_id", "ts", F.round("net_flow_mean3", 6).alias("net_flow_mean3"),
                    F.round("net_flow_sd3", 6).alias("net_flow_sd3"))


@register("w06_future_demand", "W6", PANEL + """
SELECT station_id, ts, """ + "CAST(" + _guard_sql("sum", "outflow", "CURRENT ROW", "11 FOLLOWING", 12) + """ AS BIGINT) AS demand12
FROM panel""")
def w06(spark, sf_dir):
    p = _panel(spark, sf_dir).select("station_id", "ts", "outflow")
    return wn.add_future_sum(p, "outflow", 12, name="demand12").drop("outflow")


@register("w07_expanding_same_slot", "W7", PANEL + """
SELECT station_id, ts, round(avg(total_flow) OVER (PARTITION BY station_id, isodow(ts), hour(ts) ORDER BY ts
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS slot_mean
FROM panel""", check="T")
def w07(spark, sf_dir):
    p = _panel(spark, sf_dir).withColumns({"dow": F.weekday("ts"), "hour": F.hour("ts")})
    p = wn.add_expanding_mean(p, "total_flow", ["station_id", "dow", "hour"], name="slot_mean")
    return p.select("station_id", "ts", F.round("slot_mean", 6).alias("slot_mean"))


@register("w08_diff_running_stock", "W8 W9 W10 I1 P35", PANEL + ", " + ad.with_views("stations")[5:] + """
SELECT p.station_id, p.ts,
       CAST(coalesce(net_flow - lag(net_flow) OVER w, 0) AS BIGINT) AS net_flow_diff,
       CAST(sum(net_flow) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS net_flow_cum,
       CAST(coalesce(sum(net_flow) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
         AS net_flow_cum_before,
       CAST(greatest(s.lcd + s.qr + coalesce(sum(net_flow) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
         AS BIGINT) AS stock
FROM panel p JOIN stations s ON p.station_id = s.station_id
WINDOW w AS (PARTITION BY p.station_id ORDER BY p.ts)""")
def w08(spark, sf_dir):
    from ..functions.timeparts import capacity
    from ..util import bounded_broadcast
    st = ad.stations(spark, sf_dir).select("station_id", capacity("lcd", "qr").alias("capacity"))
    p = _panel(spark, sf_dir).select("station_id", "ts", "net_flow").join(bounded_broadcast(st), "station_id")
    p = wn.add_diff(p, "net_flow")
    p = wn.add_running_sum(p, "net_flow")
    p = wn.add_running_sum(p, "net_flow", before=True)
    p = wn.add_running_stock(p, "net_flow", "capacity")
    return p.drop("net_flow", "capacity")


def _panel_weather(spark, sf_dir):
    p = _panel(spark, sf_dir).select("station_id", "ts", "total_flow")
    w = ad.weather(spark, sf_dir).select("ts", "temp")
    from ..util import bounded_broadcast
    return p.join(w, "ts", "left")  # derived hourly side: AQE sizes it at run time


PW_SQL = PANEL + ", " + ad.with_views("weather")[5:] + """,
pw AS (SELECT p.station_id, p.ts, p.total_flow, w.temp FROM panel p LEFT JOIN weather w ON p.ts = w.ts)"""


@register("w13_ffill_bfill", "W13 W14 J1", PW_SQL + """
SELECT station_id, ts,
       round(coalesce(last_value(temp IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY ts
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      first_value(temp IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY ts
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS temp_fb,
       round(last_value(temp IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY ts
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS temp_f
FROM pw""", check="T")
def w13(spark, sf_dir):
    pw = _panel_weather(spark, sf_dir).withColumn("temp_f", F.col("temp"))
    pw = pn.ffill_bfill(pw, ["temp"], ["ts"], ["station_id"])
    pw = pn.ffill_bfill(pw, ["temp_f"], ["ts"], ["station_id"], backward=False)
    return pw.select("station_id", "ts", F.round("temp", 6).alias("temp_fb"),
                     F.round("temp_f", 6).alias("temp_f"))


def interp_sql(src: str, col: str, part: str | None, order: str = "ts") -> str:
    """DuckDB twin of ``panel.interpolate_linear``: positional linear fill, nearest at the ends."""
    pb = f"PARTITION BY {part} " if part else ""
    f = f"OVER ({pb}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    b = f"OVER ({pb}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""(SELECT *, CASE WHEN {col} IS NOT NULL THEN {col} WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
                      WHEN ni = pi THEN pv ELSE pv + (nv - pv) * (pos - pi) / (ni - pi) END AS {col}_i
   FROM (SELECT *, last_value({col} IGNORE NULLS) {f} AS pv,
                last_value(CASE WHEN {col} IS NOT NULL THEN pos END IGNORE NULLS) {f} AS pi,
                first_value({col} IGNORE NULLS) {b} AS nv,
                first_value(CASE WHEN {col} IS NOT NULL THEN pos END IGNORE NULLS) {b} AS ni
         FROM (SELECT *, row_number() OVER ({pb}ORDER BY {order}) AS pos FROM {src}) a) b)"""


@register("w15_interpolate_weather", "W15 G8", V("weather") + """,
rng AS (SELECT min(ts) AS lo, max(ts) AS hi FROM weather),
sp AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM rng),
wx AS (SELECT sp.ts, w.temp FROM sp LEFT JOIN weather w ON sp.ts = w.ts)
SELECT ts, round(temp_i, 6) AS temp FROM """ + interp_sql("wx", "temp", None) + " i", check="T")
def w15(spark, sf_dir):
    w = ad.weather(spark, sf_dir).select("ts", "temp")
    sp = pn.hour_spine(w).join(w, "ts", "left")
    out = pn.interpolate_linear(sp, ["temp"], "ts")
    return out.select("ts", F.round("temp", 6).alias("temp"))


@register("w15b_interpolate_per_station", "W15", PW_SQL + """
SELECT station_id, ts, round(temp_i, 6) AS temp FROM """ + interp_sql("pw", "temp", "station_id") + " i",
          check="T")
def w15b(spark, sf_dir):
    pw = _panel_weather(spark, sf_dir)
    out = pn.interpolate_linear(pw, ["temp"], "ts", ["station_id"])
    return out.select("station_id", "ts", F.round("temp", 6).alias("temp"))


DAILY_SQL = PANEL + """,
daily AS (SELECT station_id, CAST(ts AS DATE) AS day, CAST(sum(total_flow) AS BIGINT) AS total FROM panel GROUP BY 1, 2)"""


def _daily(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.groupBy("station_id", F.to_date("ts").alias("day")).agg(F.sum("total_flow").alias("total"))


@register("w16_rank_min", "W16", DAILY_SQL + """
SELECT station_id, day, total,
       CAST(rank() OVER (PARTITION BY day ORDER BY total DESC NULLS LAST) AS INTEGER) AS rank_desc,
       CAST(rank() OVER (PARTITION BY day ORDER BY total ASC NULLS LAST) AS INTEGER) AS rank_asc
FROM daily""")
def w16(spark, sf_dir):
    d = _daily(spark, sf_dir)
    d = wn.add_rank(d, "total", "day", ascending=False, name="rank_desc")
    return wn.add_rank(d, "total", "day", ascending=True, name="rank_asc")


@register("w17_top_hours", "W17 O3 O1", PANEL + """
SELECT station_id, ts, total_flow FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY total_flow DESC, ts) AS rn FROM panel) x
WHERE rn <= 3""")
def w17(spark, sf_dir):
    p = _panel(spark, sf_dir).select("station_id", "ts", "total_flow")
    return wn.top_n(p, "station_id", [F.col("total_flow").desc(), F.col("ts")], 3)


@register("w18_arg_best", "W18", DAILY_SQL + """
SELECT station_id, arg_max(day, (total, -epoch(day))) AS best_day, max(total) AS best_total,
       arg_min(day, (total, epoch(day))) AS worst_day
FROM daily GROUP BY 1""")
def w18(spark, sf_dir):
    d = _daily(spark, sf_dir)
    best = wn.arg_best(d, ["station_id"], "total", ["day", "total"], largest=True, tiebreak=["day"]) \
        .withColumnsRenamed({"day": "best_day", "total": "best_total"})
    worst = wn.arg_best(d, ["station_id"], "total", ["day"], tiebreak=["day"]) \
        .withColumnRenamed("day", "worst_day")
    return best.join(worst, "station_id")


@register("w19_argmax_column", "W19", PANEL + """
SELECT station_id, ts, CASE WHEN inflow = greatest(inflow, outflow) THEN 'inflow' ELSE 'outflow' END AS bigger
FROM panel""")
def w19(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select("station_id", "ts", wn.argmax_column(["inflow", "outflow"]).alias("bigger"))


@register("w20_average_rank", "W20", DAILY_SQL + """
SELECT station_id, day, rank() OVER (PARTITION BY station_id ORDER BY total)
         + (count(*) OVER (PARTITION BY station_id, total) - 1) / 2.0 AS total_avgrank
FROM daily""")
def w20(spark, sf_dir):
    d = _daily(spark, sf_dir)
    return wn.add_average_rank(d, "total", "station_id").drop("total")


@register("w21_quantile_bins", "W21", V("od_daily") + """,
e AS (SELECT list_sort(list_distinct(quantile_cont(use_dist, [0, 0.25, 0.5, 0.75, 1.0]))) AS edges FROM od_daily),
b AS (SELECT use_dist, cnt, CAST(least(len(list_filter(edges[2:], lambda x: x < use_dist)), len(edges) - 2) AS INTEGER) AS bin
      FROM od_daily, e)
SELECT bin, round(median(cnt), 6) AS median, round(avg(cnt), 6) AS mean, count(*) AS n FROM b GROUP BY 1""",
          check="T")
def w21(spark, sf_dir):
    od = ad.od_daily(spark, sf_dir).select("use_dist", "cnt")
    out = wn.quantile_bins(od, "use_dist", 4, value="cnt")
    return out.select("bin", F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"), "n")
