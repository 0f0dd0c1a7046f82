"""Live projection queries: both flow models fitted on the hours before the
start, the stock of every station projected over the next 12 hours. The SQL twin fits by
Gauss-Jordan elimination and walks the steps in a recursive query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import live
from ..sources import adapter as ad
from ..util import cut_lineage
from .catalog import register
from .q_flow import PANEL, hourly_flow_panel
from .q_moments import normal_equations_sql

START = "2024-01-25 16:00:00"
KNOWN = ["hour_sin", "hour_cos", "is_weekend", "rush", "temp"]
V = ad.with_views


def known_features(spark, sf_dir):
    """Calendar and weather of every hour that has weather."""
    hs, hc = tp.cyclic(F.hour("ts"), 24)
    return ad.weather(spark, sf_dir).select("ts", "temp").withColumns({
        "hour_sin": hs, "hour_cos": hc, "is_weekend": (F.weekday("ts") >= 5).cast("double"),
        "rush": F.hour("ts").isin(7, 8, 9, 17, 18, 19).cast("double")})


def live_stock(spark, sf_dir):
    """Stands in for the operator's count: 60 % of the docks, rounded down."""
    return ad.stations(spark, sf_dir).select("station_id", F.floor((F.col("lcd") + F.col("qr")) * 0.6).alias("live_stock"))


def projection(spark, sf_dir):
    start = F.lit(START).cast("timestamp_ntz")
    p = hourly_flow_panel(spark, sf_dir).select("station_id", "ts", "inflow", "outflow")
    past = cut_lineage(live.flow_lags(p).filter(F.col("ts") < start))       # read by the fit and by the projection
    known = known_features(spark, sf_dir)
    models = live.fit_flow_models(past.join(known, "ts"), KNOWN)
    return live.live_projection(past, live_stock(spark, sf_dir), known, models, START)


KNOWN_SQL = V("weather")[5:] + """,
known AS (SELECT ts, temp, sin(2 * pi() * hour(ts) / 24.0) AS hour_sin, cos(2 * pi() * hour(ts) / 24.0) AS hour_cos,
                 CAST(isodow(ts) >= 6 AS DOUBLE) AS is_weekend, CAST(hour(ts) IN (7, 8, 9, 17, 18, 19) AS DOUBLE) AS rush FROM weather)"""
LAG_SQL = ",\n".join(f"""CAST(lag({f}, 1) OVER w AS DOUBLE) AS {f}_lag_1h, CAST(lag({f}, 24) OVER w AS DOUBLE) AS {f}_lag_24h,
       avg(CAST({f} AS DOUBLE)) OVER (PARTITION BY station_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS {f}_rolling_3h"""
                     for f in live.FLOWS)


def _fit_sql(f):
    return normal_equations_sql("complete", [*KNOWN, *(f"{f}_{x}" for x in live.LAGS)], f"log_{f}", 0.0, tag=f"_{f}")


def _known_part(f):
    return f"(SELECT c.intercept + " + " + ".join(f"c.w[{i + 1}] * coalesce(k.{x}, s.m{i})" for i, x in enumerate(KNOWN)) + f" FROM coefs_{f} c, stats_{f} s)"


def _step(f):
    a, n = f"past_{f}", len(KNOWN)
    lags = (f"{a}[24]", f"{a}[1]", f"list_avg({a}[22:24])")
    return f"(exp(h.{f} + " + " + ".join(f"c_{f}.w[{n + i + 1}] * coalesce({x}, s_{f}.m{n + i})" for i, x in enumerate(lags)) + ") - 1)"


LIVE_SQL = "WITH RECURSIVE " + PANEL[len("WITH "):] + ", " + KNOWN_SQL + ", " + V("stations")[5:] + f""",
lagged AS (SELECT station_id, ts, inflow, outflow, {LAG_SQL} FROM panel WINDOW w AS (PARTITION BY station_id ORDER BY ts)),
train AS (SELECT l.*, k.* EXCLUDE (ts), ln(1 + CAST(inflow AS DOUBLE)) AS log_inflow, ln(1 + CAST(outflow AS DOUBLE)) AS log_outflow
          FROM lagged l JOIN known k ON k.ts = l.ts WHERE l.ts < TIMESTAMP '{START}'),
complete AS (SELECT * FROM train WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*KNOWN, *(f"{f}_{x}" for f in live.FLOWS for x in live.LAGS)])}),
""" + ",".join(_fit_sql(f) for f in live.FLOWS) + f""",
steps AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS step),
plan AS (SELECT st.step, {", ".join(f"{_known_part(f)} AS {f}" for f in live.FLOWS)}
         FROM steps st LEFT JOIN known k ON k.ts = TIMESTAMP '{START}' + to_hours(st.step - 1)),
hours AS (SELECT s.station_id, floor((s.lcd + s.qr) * 0.6) AS stock, CAST(unnest(range(24, 0, -1)) AS INTEGER) AS age FROM stations s),
begin_ AS (SELECT h.station_id, CAST(max(h.stock) AS DOUBLE) AS stock,
                  {", ".join(f"list(CAST(p.{f} AS DOUBLE) ORDER BY h.age DESC) AS past_{f}" for f in live.FLOWS)}
           FROM hours h LEFT JOIN panel p ON p.station_id = h.station_id AND p.ts = TIMESTAMP '{START}' - to_hours(h.age) GROUP BY 1),
walk AS (SELECT station_id, 0 AS step, CAST(NULL AS DOUBLE) AS stock_before, stock AS stock_after, past_outflow, past_inflow FROM begin_
         UNION ALL
         SELECT w.station_id, h.step, w.stock_after, w.stock_after + {_step("inflow")} - {_step("outflow")},
                list_append(past_outflow[2:24], {_step("outflow")}), list_append(past_inflow[2:24], {_step("inflow")})
         FROM walk w JOIN plan h ON h.step = w.step + 1, coefs_outflow c_outflow, coefs_inflow c_inflow, stats_outflow s_outflow, stats_inflow s_inflow),
path AS (SELECT station_id, step, TIMESTAMP '{START}' + to_hours(step - 1) AS ts, stock_before, past_inflow[24] AS pred_inflow,
                past_outflow[24] AS pred_outflow, stock_after, CAST(stock_after <= 0 AS INTEGER) AS risk_zero_stock FROM walk WHERE step > 0)"""


@register("i12_live_projection", "I12", LIVE_SQL + """
SELECT station_id, step, ts, round(stock_before, 4) AS stock_before, round(pred_inflow, 4) AS pred_inflow,
       round(pred_outflow, 4) AS pred_outflow, round(stock_after, 4) AS stock_after, risk_zero_stock FROM path""", check="T")
def i12_path(spark, sf_dir):
    p = projection(spark, sf_dir)
    return p.withColumns({c: F.round(c, 4) for c in ("stock_before", "pred_inflow", "pred_outflow", "stock_after")})


@register("i12_live_summary", "I12 I13", LIVE_SQL + """,
g AS (SELECT station_id, arg_min(stock_before, step) AS start_stock, round(sum(pred_inflow), 4) AS total_inflow,
             round(sum(pred_outflow), 4) AS total_outflow, round(min(stock_after), 4) AS min_stock, round(arg_max(stock_after, step), 4) AS end_stock,
             max(risk_zero_stock) AS risk_zero_stock, CAST(ceil(greatest(0.0, -min(stock_after))) AS BIGINT) AS need FROM path GROUP BY 1)
SELECT *, CASE WHEN risk_zero_stock = 1 AND need >= 3 THEN 'act_now' WHEN risk_zero_stock = 1 AND need >= 1 THEN 'review' ELSE 'watch' END AS priority
FROM g""", check="T")
def i12_summary(spark, sf_dir):
    s = live.live_summary(projection(spark, sf_dir))
    return s.withColumns({c: F.round(c, 4) for c in ("total_inflow", "total_outflow", "min_stock", "end_stock")})
