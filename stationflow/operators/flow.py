"""Station flows and trip aggregates.

All aggregations are ordinary ``groupBy`` with partial (map-side) aggregation, so a
station holding a third of all trips is combined inside every map task before the
shuffle; the shuffle carries at most one row per (map task, group).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import trunc, window_start

from ..util import cut_lineage, id_filter


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# G5 / G6 ---------------------------------------------------------------------
def explode_by_station(trips: DataFrame, ids=None, start: str = "start_id",
                       end: str = "end_id", out: str = "station_id") -> DataFrame:
    """One row per (trip, involved target station) with role both/start/end.

    A loop trip gives one ``both`` row; a trip between two targets gives a
    ``start`` row and an ``end`` row. ``ids`` is a list, a one-column DataFrame
    or None (every station). Map-side only, except a semi join for large id sets.
    """
    s, e = F.col(start), F.col(end)
    x = trips.withColumn(out, F.explode(F.array_distinct(F.array(s, e))))
    x = x.filter(F.col(out).isNotNull())
    x = id_filter(x, out, ids)
    role = (F.when((s == F.col(out)) & (e == F.col(out)), F.lit("both"))
             .when(s == F.col(out), F.lit("start")).otherwise(F.lit("end")))
    return x.withColumn("role", role)


def tag_single_station(trips: DataFrame, station: str, start: str = "start_id",
                       end: str = "end_id") -> DataFrame:
    """Role of each trip relative to one station; uninvolved trips dropped."""
    return explode_by_station(trips, [station], start, end)


# A2 / A3 ---------------------------------------------------------------------
def role_flow(exploded: DataFrame, time_col: str = "ts", station: str = "station_id",
              weight: str | None = None, grain: str | None = "hour") -> DataFrame:
    """inflow = trips with role end/both, outflow = role start/both; per (station, time).

    ``weight`` None counts rows; otherwise sums that column.
    """
    t = trunc(grain, F.col(time_col)) if grain else F.col(time_col)
    is_in = F.col("role").isin("end", "both")
    is_out = F.col("role").isin("start", "both")
    if weight is None:
        aggs = [F.count_if(is_in).alias("inflow"), F.count_if(is_out).alias("outflow")]
    else:
        w = F.col(weight)
        aggs = [F.sum(F.when(is_in, w).otherwise(F.lit(0))).alias("inflow"),
                F.sum(F.when(is_out, w).otherwise(F.lit(0))).alias("outflow")]
    return exploded.groupBy(F.col(station).alias(station), t.alias(time_col)).agg(*aggs)


def add_flow_totals(df: DataFrame, inflow: str = "inflow", outflow: str = "outflow") -> DataFrame:
    """A3: total = in + out, net = in - out."""
    return df.withColumns({"total_flow": F.col(inflow) + F.col(outflow),
                           "net_flow": F.col(inflow) - F.col(outflow)})


# A1 --------------------------------------------------------------------------
def hourly_departures(trips: DataFrame, weather_cols: Iterable[str] = (), station: str = "start_id",
                      time_col: str = "ts", cnt: str = "cnt") -> DataFrame:
    """``sum(cnt)`` and mean weather per (origin, hour)."""
    return (trips.groupBy(F.col(station).alias("station_id"),
                          trunc("hour", F.col(time_col)).alias("ts"))
            .agg(F.sum(cnt).alias("departures"), *[F.avg(c).alias(c) for c in weather_cols]))


# A4 --------------------------------------------------------------------------
def two_sided_flow(trips: DataFrame, time_col: str = "ts", cnt: str = "cnt",
                   start: str = "start_id", end: str = "end_id", basis: str = "basis",
                   dep: str = "dep", arr: str = "arr") -> DataFrame:
    """Rentals by origin on departure rows, returns by destination on arrival rows,
    full outer joined per (station, hour), zeros filled; ``net_out = rentals - returns``."""
    t = trunc("hour", F.col(time_col))
    rent = (trips.filter(F.col(basis) == dep)
            .groupBy(F.col(start).alias("station_id"), t.alias("ts")).agg(F.sum(cnt).alias("rentals")))
    ret = (trips.filter(F.col(basis) == arr)
           .groupBy(F.col(end).alias("station_id"), t.alias("ts")).agg(F.sum(cnt).alias("returns")))
    j = rent.join(ret, ["station_id", "ts"], "full_outer")
    return j.select("station_id", "ts",
                    F.coalesce("rentals", F.lit(0.0)).alias("rentals"),
                    F.coalesce("returns", F.lit(0.0)).alias("returns")) \
            .withColumn("net_out", F.col("rentals") - F.col("returns"))


# A5 / A6 ---------------------------------------------------------------------
def signed_count(trips: DataFrame, keys: list, cnt: str = "cnt", basis: str = "basis",
                 dep: str = "dep") -> DataFrame:
    """Departures count negative, arrivals positive."""
    v = F.when(F.col(basis) == dep, F.lit(0) - F.col(cnt)).otherwise(F.col(cnt))  # 0 - x: no -0.0
    return trips.groupBy(*keys).agg(F.sum(v).alias("signed_cnt"))


def net_by_pivot(trips: DataFrame, keys: list, cnt: str | None = "cnt", basis: str = "basis",
                 values=("arr", "dep")) -> DataFrame:
    """Pivot basis (fixed value list, no discovery job) and take arr - dep."""
    g = trips.groupBy(*keys).pivot(basis, list(values))
    p = g.sum(cnt) if cnt else g.count()
    a, d = values
    return p.select(*keys, F.coalesce(F.col(a), F.lit(0)).alias(a),
                    F.coalesce(F.col(d), F.lit(0)).alias(d)) \
            .withColumn("net", F.col(a) - F.col(d))


# A7 --------------------------------------------------------------------------
def first_non_null(df: DataFrame, keys: list, value: str, order: list[str]) -> DataFrame:
    """First non-null ``value`` in time order per group (pandas ``first``)."""
    ordkey = F.struct(*[F.col(o) for o in order])
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.min_by(F.col(value), ordkey).alias(value)))


# A8 --------------------------------------------------------------------------
def event_deltas(trips: DataFrame, dep_ts: str = "ts", arr_ts: str | None = None,
                 cnt: str = "cnt", start: str = "start_id", end: str = "end_id") -> DataFrame:
    """-cnt at the origin at departure, +cnt at the destination at arrival."""
    at = F.col(arr_ts) if arr_ts else F.col(dep_ts)
    return trips.select(F.explode(F.array(
        F.struct(F.col(start).alias("station_id"), F.col(dep_ts).alias("event_time"),
                 (F.lit(0) - F.col(cnt)).alias("delta")),
        F.struct(F.col(end).alias("station_id"), at.alias("event_time"),
                 F.col(cnt).alias("delta")))).alias("e")).select("e.*")


# A9-A17 generic --------------------------------------------------------------
def group_agg(df: DataFrame, keys: list, spec: dict[str, list[str]]) -> DataFrame:
    """A10: several functions per column with flattened ``col_fn`` names.

    ``first``/``last`` need an ``__order__`` entry: ``spec['__order__'] = ['ts']``.
    """
    order = spec.get("__order__")
    ordkey = F.struct(*[F.col(o) for o in order]) if order else None
    fns = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count,
           "std": F.stddev_samp, "median": F.median}
    aggs = []
    for col, names in spec.items():
        if col == "__order__":
            continue
        for n in names:
            if n == "first":
                aggs.append(F.min_by(F.col(col), ordkey).alias(f"{col}_first"))
            elif n == "last":
                aggs.append(F.max_by(F.col(col), ordkey).alias(f"{col}_last"))
            else:
                aggs.append(fns[n](F.col(col)).alias(f"{col}_{n}"))
    return df.groupBy(*keys).agg(*aggs)


def block_agg(df: DataFrame, hours: int, spec: dict[str, list[str]], station: str = "station_id",
              time_col: str = "ts", start_hour: int = 0) -> DataFrame:
    """N-hour tumbling blocks per station (``start_hour`` offsets the grid)."""
    w = window_start(time_col, f"{hours} hours", f"{start_hour} hours" if start_hour else None)
    x = df.withColumn("block_start", w)
    return group_agg(x, [station, "block_start"], spec)


# A18 -------------------------------------------------------------------------
def daily_resample(df: DataFrame, value: str, station: str = "station_id",
                   time_col: str = "ts") -> DataFrame:
    """Daily sums on a gap-free day spine per station (empty days 0), with month."""
    d = df.groupBy(station, F.to_date(time_col).alias("day")).agg(F.sum(value).alias(value))
    rng = d.groupBy(station).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    spine = rng.select(station, F.explode(F.sequence("lo", "hi")).alias("day"))
    out = spine.join(d, [station, "day"], "left").fillna(0, subset=[value])
    return out.withColumn("month", trunc("month", "day").cast("date"))


# A19 -------------------------------------------------------------------------
def quarter_totals(df: DataFrame, keys, quarter_cols: list[str]) -> DataFrame:
    """Unpivot quarter columns and total them per key (a name or a list of names)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    long = df.unpivot(keys, quarter_cols, "quarter", "value")
    return long.groupBy(*keys).agg(F.sum("value").alias("annual_total"))


# A21 -------------------------------------------------------------------------
def key_usage(df: DataFrame, keys: list, value: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.bround(F.sum(value), 0).cast("bigint").alias("usage"))


# A22-A26 ---------------------------------------------------------------------
def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate rows (whole row) and duplicate keys, one result row."""
    cols = df.columns
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*cols))).alias("dup_rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("dup_keys"))


def value_frequency(df: DataFrame, col: str) -> DataFrame:
    """``value_counts``: count per value, largest first, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


# A27 / A28 -------------------------------------------------------------------
def describe(df: DataFrame, col: str, percentiles=(0.5, 0.9, 0.95, 0.99), keys: list[str] = ()) -> DataFrame:
    """Count, mean, std, min, exact percentiles and max of ``col``, per ``keys`` if given. The
    column is written once, so that ``df`` is not computed again for every pass."""
    from .splits import exact_percentiles, join_null_safe
    c, keys = F.col(col), list(keys)
    df = cut_lineage(df.select(*dict.fromkeys([*keys, col])))
    d = df.groupBy(*keys).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                              F.min(c).alias("min"), F.max(c).alias("max"))
    p = exact_percentiles(df, col, list(percentiles), keys, "_p", written=True)
    if keys:
        d = join_null_safe(d, p, keys, "left")
    else:
        d = d.withColumn("_p", F.lit((p.first() or [None])[0]).cast("array<double>"))   # a scalar per percentile
    return d.select(*keys, "count", "mean", "std", "min",
                    *[F.col("_p")[i].alias(f"p{int(round(q * 100))}") for i, q in enumerate(percentiles)], "max")


# A30 -------------------------------------------------------------------------
def station_profile(df: DataFrame, value: str, peak_hours, station: str = "station_id",
                    hour: str = "hour") -> DataFrame:
    mean = F.avg(value)
    peak = F.avg(F.when(F.col(hour).isin(list(peak_hours)), F.col(value)))
    return (df.groupBy(station).agg(mean.alias("mean_cnt"), peak.alias("peak_mean"))
            .withColumn("peak_ratio", F.when(F.col("mean_cnt") != 0,
                                             F.col("peak_mean") / F.col("mean_cnt"))
                        .otherwise(F.lit(0.0))))


# A34 -------------------------------------------------------------------------
def coverage(df: DataFrame, station: str = "station_id", time_col: str = "ts",
             by_month: bool = False) -> DataFrame:
    """Observed hours vs hours of the full range, missing count, ratio."""
    keys = [station] + ([trunc("month", time_col).alias("month")] if by_month else [])
    g = df.groupBy(*keys).agg(F.count_distinct(trunc("hour", time_col)).alias("observed"),
                              F.min(time_col).alias("t0"), F.max(time_col).alias("t1"))
    full = F.timestamp_diff("HOUR", trunc("hour", "t0"), trunc("hour", "t1")) + 1
    return (g.withColumn("full_hours", full)
            .withColumn("missing", F.col("full_hours") - F.col("observed"))
            .withColumn("coverage", F.col("observed") / F.col("full_hours")).drop("t0", "t1"))


# A35 -------------------------------------------------------------------------
def quality_summary(df: DataFrame, station: str = "station_id") -> DataFrame:
    """Rows, nulls per column and distinct stations in one pass; long form."""
    cols = [c for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(station).alias("stations"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null__{c}") for c in cols])
    return one.unpivot([], one.columns, "metric", "value")


# A36 -------------------------------------------------------------------------
def range_summary(df: DataFrame, split: str, time_col: str, target: str) -> DataFrame:
    return df.groupBy(split).agg(F.min(time_col).alias("start"), F.max(time_col).alias("end"),
                                 F.count(F.lit(1)).alias("rows"), F.avg(target).alias("target_mean"))


# A37 -------------------------------------------------------------------------
def error_table(df: DataFrame, keys: list, y: str = "y", pred: str = "pred") -> DataFrame:
    e = F.col(y) - F.col(pred)
    return df.groupBy(*keys).agg(F.avg(y).alias("mean_actual"), F.avg(pred).alias("mean_pred"),
                                 F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))


# A38 -------------------------------------------------------------------------
def baseline_profile(train: DataFrame, score: DataFrame, keys: list, y: str) -> DataFrame:
    """Group mean of the train rows by keys, global mean where the group is absent, clip 0."""
    prof = train.groupBy(*keys).agg(F.avg(y).alias("_gm"))
    glob = train.agg(F.avg(y)).first()[0]  # one scalar, not data
    out = score.join(prof, keys, "left")
    return out.withColumn("baseline", F.greatest(F.coalesce(F.col("_gm"), F.lit(glob)), F.lit(0.0))) \
              .drop("_gm")


# A39 -------------------------------------------------------------------------
def target_diagnosis(df: DataFrame, y: str, keys: list | None = None) -> DataFrame:
    aggs = [F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
            F.avg((F.col(y) == 0).cast("double")).alias("zero_share")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# A40 / A41 -------------------------------------------------------------------
def pivot_wide(df: DataFrame, keys: list, pivot_col: str, values: list, value: str,
               fill=0) -> DataFrame:
    """Long to wide with a fixed value list (no discovery job); absent cells filled."""
    p = df.groupBy(*keys).pivot(pivot_col, values).agg(F.first(value))
    if fill is not None:
        p = p.fillna(fill, subset=[str(v) for v in values])
    return p


def unpivot_long(df: DataFrame, ids: list, cols: list, name: str = "variable",
                 value: str = "value") -> DataFrame:
    return df.unpivot(ids, cols, name, value)
