"""12-hour rebalancing cycles.

A cycle is a 12-hour shift starting 04:00 or 16:00; hours 00-03 belong to the
previous day's 16:00 cycle. ``window(ts, '12 hours', startTime='4 hours')`` on
``timestamp_ntz`` gives exactly that grid (SURVEY 2.X.9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import cycle_start
from .flow import group_agg


def tag_cycle(df: DataFrame, time_col: str = "ts") -> DataFrame:
    """I4: cycle start, hour offset inside the cycle (0..11) and start hour (4/16)."""
    cs = cycle_start(time_col)
    return df.withColumns({"cycle_start": cs}).withColumns({
        "cycle_offset": (F.timestamp_diff("HOUR", F.col("cycle_start"), F.col(time_col))).cast("int"),
        "cycle_hour": F.hour("cycle_start")})


def cycle_agg(panel: DataFrame, spec: dict[str, list[str]], station: str = "station_id",
              time_col: str = "ts") -> DataFrame:
    """Aggregate a station-hour panel per (station, cycle)."""
    return group_agg(tag_cycle(panel, time_col), [station, "cycle_start", "cycle_hour"], spec)


def early_demand(panel: DataFrame, value: str, hours=(2, 4, 6), station: str = "station_id",
                 time_col: str = "ts") -> DataFrame:
    """Demand in the first N hours of each cycle (0 when the cycle has none)."""
    x = tag_cycle(panel, time_col)
    return x.groupBy(station, "cycle_start").agg(*[
        F.coalesce(F.sum(F.when(F.col("cycle_offset") < n, F.col(value))), F.lit(0)).alias(f"{value}_first{n}h")
        for n in hours])


def cycle_start_features(panel: DataFrame, cols: list[str], station: str = "station_id",
                         time_col: str = "ts") -> DataFrame:
    """The first row (by time) of every cycle; one pass with ``min_by``."""
    x = tag_cycle(panel, time_col)
    s = F.struct(*[F.col(c) for c in cols])
    return x.groupBy(station, "cycle_start").agg(F.min_by(s, F.col(time_col)).alias("_f")) \
        .select(station, "cycle_start", "_f.*")


def demand_before_visit(panel: DataFrame, value: str, visit_hours: int = 12,
                        station: str = "station_id", time_col: str = "ts") -> DataFrame:
    """For every cycle and visit hour h in 0..11, the cumulative demand of
    the cycle's hours before h. The visit grid is a fixed 12-element explode."""
    x = tag_cycle(panel, time_col)
    per = x.groupBy(station, "cycle_start").agg(
        F.array_sort(F.collect_list(F.struct("cycle_offset", F.col(value).alias("v")))).alias("hrs"))
    # at most 12 items per (station, cycle): bounded by the calendar
    v = per.select(station, "cycle_start", "hrs",
                   F.explode(F.sequence(F.lit(0), F.lit(visit_hours - 1))).alias("visit_hour"))
    before = F.aggregate(F.filter("hrs", lambda h: h["cycle_offset"] < F.col("visit_hour")),
                         F.lit(0.0), lambda acc, h: acc + h["v"].cast("double"))
    return v.select(station, "cycle_start", "visit_hour", before.alias("demand_before"))
