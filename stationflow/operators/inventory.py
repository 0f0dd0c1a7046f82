"""Dock inventory and rebalancing.

The reference runs these as Python loops over rows; here they are window
expressions, a closed form (I6) and a bounded array fold (I3):

* I3 folds at most 24 hourly steps per (station, day) with ``aggregate`` inside
  the JVM; the group size is bounded by the calendar, not by the data.
* I5 takes the running minimum minute by minute (a window holds one station's minute)
  and puts the at most 720 minutes of a cycle together; I6 works on cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import cycle_start, trunc


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# I1 / I2 ---------------------------------------------------------------------
def estimated_stock(panel: DataFrame, net: str, capacity: str, station: str = "station_id",
                    time_col: str = "ts") -> DataFrame:
    """Start stock = capacity + net flow of all earlier hours; end = start + net;
    and the same clipped to ``[0, capacity]`` (I2)."""
    w = Window.partitionBy(station).orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col(capacity) + F.coalesce(F.sum(net).over(w), F.lit(0))
    x = panel.withColumn("stock_start", start).withColumn("stock_end", F.col("stock_start") + F.col(net))
    clip = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), F.col(capacity))
    return x.withColumns({"stock_start_clip": clip("stock_start"), "stock_end_clip": clip("stock_end")})


# I3 --------------------------------------------------------------------------
def simulate_stock(panel: DataFrame, inflow: str, outflow: str, capacity: str,
                   station: str = "station_id", time_col: str = "ts") -> DataFrame:
    """Per (station, day): start at capacity, each hour ``stock = clamp(stock + in - out,
    0, cap)`` carried to the next hour (two barriers, so not a running sum). Fractional
    flows stay fractional; ``stock_start`` is the stock before the hour."""
    day = F.to_date(time_col)
    # one station-day holds at most 24 hourly steps
    g = panel.groupBy(station, day.alias("day")).agg(
        F.max(capacity).alias("cap"),
        F.array_sort(F.collect_list(F.struct(F.col(time_col).alias("t"),
                                             (F.col(inflow) - F.col(outflow)).alias("d")))).alias("steps"))
    init = F.struct(F.col("cap").cast("double").alias("s"),
                    F.array().cast("array<struct<t:timestamp_ntz,stock_start:double,stock:double>>").alias("out"))

    def step(acc, x):
        s = F.least(F.greatest(acc["s"] + x["d"], F.lit(0.0)), F.col("cap").cast("double"))
        hour = F.struct(x["t"].alias("t"), acc["s"].alias("stock_start"), s.alias("stock"))
        return F.struct(s.alias("s"), F.array_append(acc["out"], hour).alias("out"))

    sim = g.select(station, "day", F.aggregate("steps", init, step)["out"].alias("out"))
    return sim.select(station, F.inline("out")).withColumnRenamed("t", time_col)


# I5 --------------------------------------------------------------------------
def cycle_need(deltas: DataFrame, station: str = "station_id", time_col: str = "event_time",
               delta: str = "delta") -> DataFrame:
    """Bikes needed at the start of each cycle so the stock never goes negative:
    ``-min(0, running sum)`` of the cycle's deltas ordered by (time, delta), plus
    the cycle's net change. The lowest prefix of a cycle is that of a minute on top of
    the sum of the minutes before it, so a hot station's cycle is cut into minutes."""
    x = deltas.withColumn("cycle_start", cycle_start(time_col))
    # exact pre-aggregation: equal (time, delta) rows are adjacent in the order and
    # share a sign, so the prefix minimum is reached at a group boundary
    g = x.groupBy(station, "cycle_start", time_col, delta).agg(F.sum(delta).alias("_tot"))
    minute = [station, "cycle_start", "_minute"]
    g = g.withColumn("_minute", trunc("minute", time_col))
    inner = Window.partitionBy(*minute).orderBy(time_col, delta).rowsBetween(Window.unboundedPreceding, 0)
    m = g.withColumn("_run", F.sum("_tot").over(inner)).groupBy(*minute) \
        .agg(F.min("_run").alias("_low"), F.sum("_tot").alias("_tot"))
    w = Window.partitionBy(station, "cycle_start").orderBy("_minute").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("_low", F.sum("_tot").over(w) - F.col("_tot") + F.col("_low"))
    return m.groupBy(station, "cycle_start").agg(
        # 0 - x rather than -x: no negative zero when the running sum never dips
        (F.lit(0) - F.least(F.lit(0), F.min("_low"))).alias("need"), F.sum("_tot").alias("net"))


def full_cycle_grid(needs: DataFrame, station: str = "station_id") -> DataFrame:
    """Every station over every 12-hour cycle from the first to the last one seen;
    cycles without events get need 0 and net 0."""
    lo, hi = needs.agg(F.min("cycle_start"), F.max("cycle_start")).first()  # two scalars
    st = needs.select(station).distinct()
    grid = st.select(station, F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 12 HOURS")))
                     .alias("cycle_start"))
    return grid.join(needs, [station, "cycle_start"], "left") \
        .fillna(0, subset=["need", "net"])


# I6 --------------------------------------------------------------------------
def carried_refill(grid: DataFrame, station: str = "station_id") -> DataFrame:
    """Carried simulation over cycles without a loop:
    with N the cumulative net, ``d_t = max(0, max_{s<=t}(need_s - N_{s-1}))``,
    ``start_t = N_{t-1} + d_t``, ``end_t = start_t + net_t``, ``add_t = d_t - d_{t-1}``."""
    w = Window.partitionBy(station).orderBy("cycle_start")
    cum = w.rowsBetween(Window.unboundedPreceding, 0)
    x = grid.withColumn("_n_prev", F.sum("net").over(cum) - F.col("net"))
    x = x.withColumn("_d", F.greatest(F.lit(0), F.max(F.col("need") - F.col("_n_prev")).over(cum)))
    x = x.withColumn("start", F.col("_n_prev") + F.col("_d")) \
         .withColumn("end", F.col("start") + F.col("net")) \
         .withColumn("add", F.col("_d") - F.coalesce(F.lag("_d").over(w), F.lit(0)))
    return x.drop("_n_prev", "_d")


# I7 / I14 --------------------------------------------------------------------
def visit_availability(deltas: DataFrame, starts: DataFrame, station: str = "station_id",
                       time_col: str = "event_time", delta: str = "delta") -> DataFrame:
    """Stock at a visit on the hour = the cycle's ``start`` stock plus every change, in and
    out, before the visit; per (station, visit hour 0..23) its mean and the share of cycles
    with stock > 0. Cycles without events count with their start stock."""
    offset = F.timestamp_diff("HOUR", F.col("cycle_start"), F.col(time_col))
    hourly = deltas.withColumn("cycle_start", cycle_start(time_col)) \
        .groupBy(station, "cycle_start", offset.alias("_h")).agg(F.sum(delta).alias("_d"))
    # at most 12 hours in a cycle
    hours = hourly.groupBy(station, "cycle_start").agg(F.collect_list(F.struct("_h", "_d")).alias("_hours"))
    x = starts.join(hours, [station, "cycle_start"], "left") \
        .withColumn("_visit", F.explode(F.sequence(F.lit(0), F.lit(11))))
    before = F.aggregate(F.filter(F.coalesce("_hours", F.array()), lambda h: h["_h"] < F.col("_visit")),
                         F.lit(0.0), lambda acc, h: acc + h["_d"])
    x = x.withColumn("stock_at_visit", F.col("start") + before) \
        .withColumn("visit_hour", F.pmod(F.hour("cycle_start") + F.col("_visit"), F.lit(24)).cast("int"))
    return x.groupBy(station, "visit_hour").agg(
        F.avg((F.col("stock_at_visit") > 0).cast("double")).alias("available_share"),
        F.avg("stock_at_visit").alias("mean_stock"))


def availability_label(before: DataFrame, prepared: Column | str) -> Column:
    """Bikes are available if demand before the visit is below the prepared stock."""
    return (F.col("demand_before") < _c(prepared)).cast("int")


# I9 / I10 --------------------------------------------------------------------
def residual_buffer(df: DataFrame, residual: str, keys: list[str], q: float = 0.9) -> DataFrame:
    """The safety buffer of each group, the exact q-quantile of ``max(residual, 0)``, from
    counts per value (no group's values meet in one buffer)."""
    from .splits import exact_percentiles
    x = df.filter(F.col(residual).isNotNull()).withColumn("_over", F.greatest(F.col(residual).cast("double"), F.lit(0.0)))
    return exact_percentiles(x, "_over", [q], keys, "_p").select(*keys, F.col("_p")[0].alias("buffer"))


def needed_bikes(pred, buffer, stock) -> Column:
    return F.greatest(F.lit(0), F.ceil(_c(pred) + _c(buffer) - _c(stock))).cast("bigint")


def required_unclipped(pred, capacity) -> Column:
    return _c(pred) - _c(capacity)


# I11 -------------------------------------------------------------------------
def projection_12h(panel: DataFrame, inflow: str = "inflow", outflow: str = "outflow", stock: str = "stock_start",
                   station: str = "station_id", time_col: str = "ts", start_hours=(4, 16), horizon: int = 12) -> DataFrame:
    """From each cycle start and its start stock, the next ``horizon`` hours: flow totals,
    projected stock at the end and at its lowest, need ``ceil(max(0, -lowest))`` and risk
    (lowest ``<= 0``); windows shorter than the horizon are dropped. One running sum and
    one forward window, no self join."""
    w = Window.partitionBy(station).orderBy(time_col)
    net = F.col(inflow) - F.col(outflow)
    run = panel.withColumn("_S", F.sum(net).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = run.withColumn("_base", F.col(stock) - (F.col("_S") - net))
    fw = w.rowsBetween(0, horizon - 1)
    run = run.withColumns({"_min": F.min("_S").over(fw), "_last": F.last("_S").over(fw),
                           "_in": F.sum(inflow).over(fw), "_out": F.sum(outflow).over(fw),
                           "_n": F.count(F.lit(1)).over(fw)})
    x = run.filter(F.hour(time_col).isin(list(start_hours)) & (F.col("_n") == horizon))
    lowest = F.col("_min") + F.col("_base")
    return x.select(station, F.col(time_col).alias("cycle_start"), F.col(stock).alias("start_stock"),
                    F.col("_out").alias("total_outflow"), F.col("_in").alias("total_inflow"),
                    (F.col("_last") + F.col("_base")).alias("proj_end"), lowest.alias("proj_min"),
                    F.ceil(F.greatest(F.lit(0), -lowest)).cast("bigint").alias("need"),
                    (lowest <= 0).cast("int").alias("risk"))


# I13 -------------------------------------------------------------------------
def risk_summary(proj: DataFrame, station: str = "station_id", act_now: int = 3,
                 review: int = 1) -> DataFrame:
    """Per station the label of its worst projection: risk and a need of ``act_now`` or
    more, risk and a need of ``review`` or more, or only watched."""
    worst = F.max(F.when(F.col("risk") == 1, F.col("need")))
    g = proj.groupBy(station).agg(F.count(F.lit(1)).alias("cycles"), F.sum("risk").alias("risk_cycles"),
                                  F.avg("need").alias("mean_need"), F.max("need").alias("max_need"),
                                  F.min("proj_min").alias("min_stock"), worst.alias("_worst"))
    label = (F.when(F.col("_worst") >= act_now, F.lit("act_now"))
              .when(F.col("_worst") >= review, F.lit("review")).otherwise(F.lit("watch")))
    return g.withColumn("priority", label).drop("_worst")


# I15 / I16 -------------------------------------------------------------------
def capacity_risk(net, capacity, threshold: float = 0.3) -> tuple[Column, Column]:
    from ..functions.timeparts import safe_ratio
    r = safe_ratio(net, capacity)
    return r, (r < F.lit(threshold)).cast("int")


def replenish_target(demand) -> Column:
    return F.bround(_c(demand), 0)


__all__ = ["estimated_stock", "simulate_stock", "cycle_need", "full_cycle_grid", "carried_refill",
           "visit_availability", "availability_label", "needed_bikes", "residual_buffer", "required_unclipped",
           "projection_12h", "risk_summary", "capacity_risk", "replenish_target"]
