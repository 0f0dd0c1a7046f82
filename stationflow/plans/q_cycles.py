"""Cycle queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cycles as cy
from ..operators import windows as wn
from ..sources import adapter as ad
from .catalog import register
from .q_flow import PANEL, hourly_flow_panel

V = ad.with_views
CYC = "time_bucket(INTERVAL 12 HOUR, {t}, TIMESTAMP '2000-01-01 04:00:00')"

PC_SQL = PANEL + """,
pc AS (SELECT *, """ + CYC.format(t="ts") + """ AS cycle_start,
              CAST(date_diff('hour', """ + CYC.format(t="ts") + """, ts) AS INTEGER) AS off,
              CAST(hour(""" + CYC.format(t="ts") + """) AS INTEGER) AS cycle_hour
       FROM panel)"""

CAGG_SQL = PC_SQL + """,
cagg AS (SELECT station_id, cycle_start, cycle_hour, CAST(sum(outflow) AS BIGINT) AS outflow_sum,
                round(avg(total_flow), 6) AS total_flow_mean, max(net_flow) AS net_flow_max,
                arg_min(inflow, ts) AS inflow_first
         FROM pc GROUP BY 1, 2, 3)"""


def _panel(spark, sf_dir):
    return hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "inflow", "outflow",
                                                   "total_flow", "net_flow")


def cycle_table(spark, sf_dir):
    c = cy.cycle_agg(_panel(spark, sf_dir), {"__order__": ["ts"], "outflow": ["sum"],
                                             "total_flow": ["mean"], "net_flow": ["max"],
                                             "inflow": ["first"]})
    return c.withColumn("total_flow_mean", F.round("total_flow_mean", 6))


@register("a12_cycle_agg", "A12 I4", CAGG_SQL + " SELECT * FROM cagg", check="T")
def a12(spark, sf_dir):
    return cycle_table(spark, sf_dir)


@register("i04_event_cycle", "I4", V("trips") + """
SELECT event_id, """ + CYC.format(t="ts") + """ AS cycle_start,
       CAST(date_diff('hour', """ + CYC.format(t="ts") + """, ts) AS INTEGER) AS cycle_offset,
       CAST(hour(""" + CYC.format(t="ts") + """) AS INTEGER) AS cycle_hour
FROM trips""")
def i04(spark, sf_dir):
    return cy.tag_cycle(ad.trips(spark, sf_dir).select("event_id", "ts")).drop("ts")


@register("a13_early_demand", "A13", PC_SQL + """
SELECT station_id, cycle_start, """ + ", ".join(
    f"CAST(coalesce(sum(outflow) FILTER (WHERE off < {n}), 0) AS BIGINT) AS outflow_first{n}h"
    for n in (2, 4, 6)) + """
FROM pc GROUP BY 1, 2""")
def a13(spark, sf_dir):
    return cy.early_demand(_panel(spark, sf_dir), "outflow")


@register("a14_cycle_start_features", "A14", PC_SQL + """
SELECT station_id, cycle_start, arg_min(ts, ts) AS ts, arg_min(inflow, ts) AS inflow,
       arg_min(net_flow, ts) AS net_flow
FROM pc GROUP BY 1, 2""")
def a14(spark, sf_dir):
    return cy.cycle_start_features(_panel(spark, sf_dir), ["ts", "inflow", "net_flow"])


BEFORE_SQL = PC_SQL + """,
vh AS (SELECT DISTINCT station_id, cycle_start FROM pc),
grid AS (SELECT vh.*, CAST(unnest(range(0, 12)) AS INTEGER) AS visit_hour FROM vh),
before AS (SELECT g.station_id, g.cycle_start, g.visit_hour,
                  CAST(coalesce(sum(pc.outflow) FILTER (WHERE pc.off < g.visit_hour), 0) AS DOUBLE) AS demand_before
           FROM grid g JOIN pc ON g.station_id = pc.station_id AND g.cycle_start = pc.cycle_start
           GROUP BY 1, 2, 3)"""


@register("a42_demand_before_visit", "A42 J8 I14", BEFORE_SQL + """
SELECT *, CAST(demand_before < 3 AS INTEGER) AS available FROM before""")
def a42(spark, sf_dir):
    from ..operators.inventory import availability_label
    b = cy.demand_before_visit(_panel(spark, sf_dir), "outflow")
    return b.withColumn("available", availability_label(b, F.lit(3)))


def _g(fn, n, lo, hi, part="station_id"):
    fr = f"OVER (PARTITION BY {part} ORDER BY cycle_start ROWS BETWEEN {lo} AND {hi})"
    return f"round(CASE WHEN count(outflow_sum) {fr} = {n} THEN {fn}(outflow_sum) {fr} END, 6)"


@register("w11_cycle_lags_means", "W11 W12", CAGG_SQL + """
SELECT station_id, cycle_start,
       lag(outflow_sum, 1) OVER w AS outflow_sum_prev_cycle, lag(outflow_sum, 2) OVER w AS outflow_sum_prev_day_cycle,
       """ + ", ".join(f"{_g('avg', n, f'{n} PRECEDING', '1 PRECEDING')} AS outflow_sum_prev{n}_mean" for n in (2, 3, 7))
    + ", " + ", ".join(f"{_g('avg', n, f'{n} PRECEDING', '1 PRECEDING', 'station_id, cycle_hour')} "
                       f"AS outflow_sum_same{n}_mean" for n in (7, 14)) + """,
       outflow_sum - lag(outflow_sum, 1) OVER w AS outflow_sum_change
FROM cagg WINDOW w AS (PARTITION BY station_id ORDER BY cycle_start)""", check="T")
def w11(spark, sf_dir):
    c = cycle_table(spark, sf_dir).select("station_id", "cycle_start", "cycle_hour", "outflow_sum")
    c = wn.add_cycle_lags(c, "outflow_sum")
    c = wn.add_cycle_means(c, "outflow_sum")
    keep = [x for x in c.columns if x not in ("cycle_hour", "outflow_sum")]
    return c.select(*[F.round(x, 6).alias(x) if "mean" in x else F.col(x) for x in keep])
