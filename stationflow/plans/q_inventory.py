"""Inventory and rebalancing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import capacity
from ..operators import flow
from ..operators import inventory as inv
from ..sources import adapter as ad
from ..util import bounded_broadcast
from .catalog import register
from .q_cycles import CAGG_SQL, CYC, cycle_table
from .q_flow import PANEL, hourly_flow_panel

V = ad.with_views
ST = ad.with_views("stations")[5:]


def panel_with_capacity(spark, sf_dir):
    st = ad.stations(spark, sf_dir).select("station_id", capacity("lcd", "qr").alias("capacity"))
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "inflow", "outflow", "net_flow")
    return p.join(bounded_broadcast(st), "station_id")


PCAP_SQL = PANEL + ", " + ST + """,
pcap AS (SELECT p.station_id, p.ts, p.inflow, p.outflow, p.net_flow, s.lcd + s.qr AS capacity
         FROM panel p JOIN stations s ON p.station_id = s.station_id)"""


@register("i01_estimated_stock", "I1 I2", PCAP_SQL + """,
x AS (SELECT *, capacity + coalesce(sum(net_flow) OVER (PARTITION BY station_id ORDER BY ts
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stock_start FROM pcap)
SELECT station_id, ts, CAST(stock_start AS BIGINT) AS stock_start, CAST(stock_start + net_flow AS BIGINT) AS stock_end,
       CAST(least(greatest(stock_start, 0), capacity) AS BIGINT) AS stock_start_clip,
       CAST(least(greatest(stock_start + net_flow, 0), capacity) AS BIGINT) AS stock_end_clip
FROM x""")
def i01(spark, sf_dir):
    x = inv.estimated_stock(panel_with_capacity(spark, sf_dir), "net_flow", "capacity")
    return x.select("station_id", "ts", "stock_start", "stock_end", "stock_start_clip", "stock_end_clip")


@register("i03_simulate_stock", "I3", "WITH RECURSIVE " + PCAP_SQL[len("WITH "):] + """,
base AS (SELECT station_id, CAST(ts AS DATE) AS day, ts, inflow - outflow AS d, capacity AS cap,
                row_number() OVER (PARTITION BY station_id, CAST(ts AS DATE) ORDER BY ts) AS rn FROM pcap),
sim AS (SELECT station_id, day, rn, ts, CAST(cap AS DOUBLE) AS stock_start,
               CAST(least(greatest(cap + d, 0), cap) AS DOUBLE) AS stock
        FROM base WHERE rn = 1
        UNION ALL
        SELECT b.station_id, b.day, b.rn, b.ts, s.stock, CAST(least(greatest(s.stock + b.d, 0), b.cap) AS DOUBLE)
        FROM sim s JOIN base b ON b.station_id = s.station_id AND b.day = s.day AND b.rn = s.rn + 1)
SELECT station_id, ts, stock_start, stock FROM sim""")
def i03(spark, sf_dir):
    return inv.simulate_stock(panel_with_capacity(spark, sf_dir), "inflow", "outflow", "capacity")


ARR = "ts + to_microseconds(CAST(round(use_min * 60000000.0) AS BIGINT))"
NEED_SQL = V("trips") + f""",
deltas AS (SELECT start_id AS station_id, ts AS event_time, -cnt AS delta FROM trips
           UNION ALL SELECT end_id, {ARR}, cnt FROM trips),
g AS (SELECT station_id, {CYC.format(t="event_time")} AS cycle_start, event_time, delta, sum(delta) AS tot
      FROM deltas GROUP BY 1, 2, 3, 4),
r AS (SELECT *, sum(tot) OVER (PARTITION BY station_id, cycle_start ORDER BY event_time, delta
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM g),
needs AS (SELECT station_id, cycle_start, 0.0 - least(0, min(run)) AS need, sum(tot) AS net FROM r GROUP BY 1, 2)"""


def _deltas(spark, sf_dir):
    from ..functions.timeparts import add_minutes
    t = ad.trips(spark, sf_dir).withColumn("arr_ts", add_minutes("ts", "use_min"))
    return flow.event_deltas(t, "ts", "arr_ts")


def _needs(spark, sf_dir):
    return inv.cycle_need(_deltas(spark, sf_dir))


@register("i05_cycle_need", "I5 A8", NEED_SQL + " SELECT * FROM needs")
def i05(spark, sf_dir):
    return _needs(spark, sf_dir)


REFILL_SQL = NEED_SQL + """,
rng AS (SELECT min(cycle_start) AS lo, max(cycle_start) AS hi FROM needs),
grid AS (SELECT s.station_id, unnest(generate_series(lo, hi, INTERVAL 12 HOUR)) AS cycle_start
         FROM (SELECT DISTINCT station_id FROM needs) s, rng),
g2 AS (SELECT grid.station_id, grid.cycle_start, coalesce(need, 0) AS need, coalesce(net, 0) AS net
       FROM grid LEFT JOIN needs ON grid.station_id = needs.station_id AND grid.cycle_start = needs.cycle_start),
x AS (SELECT *, sum(net) OVER (PARTITION BY station_id ORDER BY cycle_start
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - net AS n_prev FROM g2),
y AS (SELECT *, greatest(0, max(need - n_prev) OVER (PARTITION BY station_id ORDER BY cycle_start
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS d FROM x),
refill AS (SELECT station_id, cycle_start, need, net, n_prev + d AS start, n_prev + d + net AS "end",
                  d - coalesce(lag(d) OVER (PARTITION BY station_id ORDER BY cycle_start), 0) AS add FROM y)"""


def _refill(spark, sf_dir):
    return inv.carried_refill(inv.full_cycle_grid(_needs(spark, sf_dir)))


@register("i06_carried_refill", "I6", REFILL_SQL + " SELECT * FROM refill")
def i06(spark, sf_dir):
    return _refill(spark, sf_dir)


@register("i07_visit_availability", "I7", REFILL_SQL + """,
hd AS (SELECT station_id, cycle_start, CAST(date_diff('hour', cycle_start, date_trunc('hour', event_time)) AS INTEGER) AS off,
              sum(tot) AS d
       FROM g GROUP BY 1, 2, 3),
vis AS (SELECT *, CAST(unnest(range(0, 12)) AS INTEGER) AS off FROM (SELECT station_id, cycle_start, start FROM refill) r),
stv AS (SELECT v.station_id, v.cycle_start, v.off, v.start + coalesce(sum(hd.d) FILTER (WHERE hd.off < v.off), 0) AS stock
        FROM vis v LEFT JOIN hd ON v.station_id = hd.station_id AND v.cycle_start = hd.cycle_start
        GROUP BY v.station_id, v.cycle_start, v.off, v.start)
SELECT station_id, CAST((hour(cycle_start) + off) % 24 AS INTEGER) AS visit_hour,
       round(avg(CASE WHEN stock > 0 THEN 1.0 ELSE 0.0 END), 6) AS available_share, round(avg(stock), 6) AS mean_stock
FROM stv GROUP BY 1, 2""", check="T")
def i07(spark, sf_dir):
    out = inv.visit_availability(_deltas(spark, sf_dir),
                                 _refill(spark, sf_dir).select("station_id", "cycle_start", "start"))
    return out.select("station_id", "visit_hour", F.round("available_share", 6).alias("available_share"),
                      F.round("mean_stock", 6).alias("mean_stock"))


@register("i08_fill_summary", "I8", REFILL_SQL + """
SELECT station_id, round(avg(add) FILTER (WHERE hour(cycle_start) = 4), 6) AS add_mean_04,
       round(avg(add) FILTER (WHERE hour(cycle_start) = 16), 6) AS add_mean_16,
       round(avg(add), 6) AS add_mean, max(add) AS add_max
FROM refill GROUP BY 1""", check="T")
def i08(spark, sf_dir):
    r = _refill(spark, sf_dir)
    h = F.hour("cycle_start")
    return r.groupBy("station_id").agg(
        F.round(F.avg(F.when(h == 4, F.col("add"))), 6).alias("add_mean_04"),
        F.round(F.avg(F.when(h == 16, F.col("add"))), 6).alias("add_mean_16"),
        F.round(F.avg("add"), 6).alias("add_mean"), F.max("add").alias("add_max"))


@register("i09_needed_bikes", "I9 I10 I15 I16 A29 P27", CAGG_SQL + ", " + ST + """,
c AS (SELECT c.*, s.lcd + s.qr AS capacity,
             CAST(lag(outflow_sum, 2) OVER (PARTITION BY c.station_id ORDER BY cycle_start) AS DOUBLE) AS pred
      FROM cagg c JOIN stations s ON c.station_id = s.station_id),
buf AS (SELECT station_id, quantile_cont(greatest(outflow_sum - pred, 0), 0.9) AS buffer
        FROM c WHERE pred IS NOT NULL GROUP BY 1)
SELECT c.station_id, c.cycle_start,
       CAST(greatest(0, ceil(pred + buffer - capacity)) AS BIGINT) AS needed,
       pred - capacity AS required_raw,
       round(CASE WHEN capacity = 0 THEN 0.0 ELSE net_flow_max / capacity END, 6) AS cap_ratio,
       CAST(CASE WHEN capacity = 0 THEN 0.0 ELSE net_flow_max / capacity END < 0.3 AS INTEGER) AS cap_risk,
       round_even(CAST(outflow_sum AS DOUBLE), 0) AS replenish_target
FROM c JOIN buf ON c.station_id = buf.station_id WHERE pred IS NOT NULL""", check="T")
def i09(spark, sf_dir):
    st = ad.stations(spark, sf_dir).select("station_id", capacity("lcd", "qr").alias("capacity"))
    c = cycle_table(spark, sf_dir).join(bounded_broadcast(st), "station_id")
    from pyspark.sql import Window
    c = c.withColumn("pred", F.lag("outflow_sum", 2).over(
        Window.partitionBy("station_id").orderBy("cycle_start")).cast("double")).filter("pred IS NOT NULL")
    buf = inv.residual_buffer(c.withColumn("over", F.col("outflow_sum") - F.col("pred")), "over", ["station_id"])
    x = c.join(buf, "station_id")
    ratio, risk = inv.capacity_risk("net_flow_max", "capacity")
    return x.select("station_id", "cycle_start", inv.needed_bikes("pred", "buffer", "capacity").alias("needed"),
                    inv.required_unclipped("pred", "capacity").alias("required_raw"),
                    F.round(ratio, 6).alias("cap_ratio"), risk.alias("cap_risk"),
                    inv.replenish_target(F.col("outflow_sum").cast("double")).alias("replenish_target"))


PROJ_SQL = PCAP_SQL + """,
stk AS (SELECT *, CAST(capacity + coalesce(sum(net_flow) OVER (PARTITION BY station_id ORDER BY ts
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_stock FROM pcap),
f AS (SELECT *, min(start_stock + net_flow) OVER fw AS mn, last_value(start_stock + net_flow) OVER fw AS lst,
             sum(inflow) OVER fw AS tin, sum(outflow) OVER fw AS tout, count(*) OVER fw AS n
      FROM stk WINDOW fw AS (PARTITION BY station_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)),
proj AS (SELECT station_id, ts AS cycle_start, start_stock, CAST(tout AS BIGINT) AS total_outflow,
                CAST(tin AS BIGINT) AS total_inflow, CAST(lst AS BIGINT) AS proj_end, CAST(mn AS BIGINT) AS proj_min,
                CAST(ceil(greatest(0, -mn)) AS BIGINT) AS need, CAST(mn <= 0 AS INTEGER) AS risk
         FROM f WHERE hour(ts) IN (4, 16) AND n = 12)"""


def _projection(spark, sf_dir):
    p = inv.estimated_stock(panel_with_capacity(spark, sf_dir), "net_flow", "capacity")
    return inv.projection_12h(p)


@register("i11_projection_12h", "I11", PROJ_SQL + " SELECT * FROM proj")
def i11(spark, sf_dir):
    return _projection(spark, sf_dir)


@register("i13_risk_priority", "I13", PROJ_SQL + """
SELECT station_id, count(*) AS cycles, CAST(sum(risk) AS BIGINT) AS risk_cycles, round(avg(need), 6) AS mean_need,
       max(need) AS max_need, min(proj_min) AS min_stock,
       CASE WHEN max(need) FILTER (WHERE risk = 1) >= 3 THEN 'act_now'
            WHEN max(need) FILTER (WHERE risk = 1) >= 1 THEN 'review' ELSE 'watch' END AS priority
FROM proj GROUP BY 1""", check="T")
def i13(spark, sf_dir):
    s = inv.risk_summary(_projection(spark, sf_dir))
    return s.withColumn("mean_need", F.round("mean_need", 6))


@register("i08b_slot_mean_forecast", "I8 W7 M30", REFILL_SQL + """,
f AS (SELECT *, avg(add) OVER (PARTITION BY station_id, hour(cycle_start) ORDER BY cycle_start
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pred FROM refill),
s AS (SELECT CAST(add AS DOUBLE) AS y, pred FROM f WHERE pred IS NOT NULL)
SELECT round(avg(abs(y - pred)), 6) AS mae, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse,
       round(CASE WHEN var_pop(y) = 0 THEN 0.0 ELSE 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) END, 6)
         AS r2
FROM s""", check="T")
def i08b(spark, sf_dir):
    """Forecast each cycle's refill by the mean of the same slot (04 or 16) in earlier
    cycles of the station, then score it."""
    from ..operators import evaluate as ev
    from ..operators.windows import add_expanding_mean
    r = _refill(spark, sf_dir).withColumn("slot", F.hour("cycle_start"))
    f = add_expanding_mean(r, "add", ["station_id", "slot"], order="cycle_start", name="pred")
    s = f.filter(F.col("pred").isNotNull()).select(F.col("add").cast("double").alias("y"), "pred")
    m = ev.regression_metrics(s, "y", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])
