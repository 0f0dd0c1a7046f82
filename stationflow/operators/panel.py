"""Gap-free station panels and fills.

A panel spine is made per station with ``sequence`` + ``explode``: its size is the
station's own time range, so a station with a third of all trips has no more spine
rows than its calendar allows. Windows used by the fills are partitioned by
station and ordered by time, over the (calendar-bounded) panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import trunc

def _hour():
    return F.expr("INTERVAL 1 HOUR")


def _fill(df: DataFrame, cols, fill):
    if fill is None or not cols:
        return df
    return df.fillna(fill, subset=list(cols))


def densify(df: DataFrame, station: str = "station_id", time_col: str = "ts",
            fill=0, value_cols: list[str] | None = None, whole_days: bool = False) -> DataFrame:
    """One row per (station, hour) from the station's first to last hour
    (G3: from 00:00 of the first day to 23:00 of the last), values filled.

    Every row fills the hours up to the station's next row, so the input is read once
    and not joined to its own spine. Rows without a time are dropped."""
    w = Window.partitionBy(station).orderBy(time_col)
    here = F.col(time_col)
    # greatest skips nulls: the last row of a station ends at its own hour
    lo, hi = here, F.greatest(here, F.lead(time_col).over(w) - _hour())
    if whole_days:
        lo = F.when(F.lag(time_col).over(w).isNull(), trunc("day", time_col)).otherwise(here)
        hi = F.when(F.lead(time_col).over(w).isNull(), trunc("day", time_col) + F.expr("INTERVAL 23 HOURS")).otherwise(hi)
    rest = [c for c in df.columns if c not in (station, time_col)]
    own = F.col("_t") == F.col(time_col)
    out = df.filter(here.isNotNull()).withColumns({"_lo": lo, "_hi": hi}) \
        .select("*", F.explode(F.sequence("_lo", "_hi", _hour())).alias("_t")) \
        .select(station, F.col("_t").alias(time_col), *[F.when(own, F.col(c)).alias(c) for c in rest])
    return _fill(out, value_cols if value_cols is not None else rest, fill)


def densify_common(df: DataFrame, station: str = "station_id", time_col: str = "ts",
                   fill=0, value_cols: list[str] | None = None,
                   stations: DataFrame | None = None) -> DataFrame:
    """Every station over the global first..last hour. The global range is one
    scalar aggregate (a one-row side); the station list is a distinct projection."""
    # The global range is one scalar row read back to the driver (not data).
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    st = (stations if stations is not None else df).select(station).distinct()
    spine = st.select(station, F.explode(F.sequence(F.lit(lo), F.lit(hi), _hour())).alias(time_col))
    out = spine.join(df, [station, time_col], "left")
    cols = value_cols if value_cols is not None else [c for c in df.columns
                                                      if c not in (station, time_col)]
    return _fill(out, cols, fill)


def densify_by(df: DataFrame, extra: str, values: list, station: str = "station_id",
               time_col: str = "ts", fill=0, value_cols: list[str] | None = None) -> DataFrame:
    """Spine of (hour x fixed values of ``extra``), e.g. the two basis values."""
    rng = df.groupBy(station).agg(F.min(time_col).alias("_lo"), F.max(time_col).alias("_hi"))
    spine = rng.select(station, F.explode(F.sequence("_lo", "_hi", _hour())).alias(time_col)) \
               .withColumn(extra, F.explode(F.array(*[F.lit(v) for v in values])))
    out = spine.join(df, [station, time_col, extra], "left")
    cols = value_cols if value_cols is not None else [c for c in df.columns
                                                      if c not in (station, time_col, extra)]
    return _fill(out, cols, fill)


def hour_spine(df: DataFrame, time_col: str = "ts") -> DataFrame:
    """Hourly spine over a single series (weather-like, no station key)."""
    rng = df.agg(F.min(time_col).alias("_lo"), F.max(time_col).alias("_hi"))
    return rng.select(F.explode(F.sequence("_lo", "_hi", _hour())).alias(time_col))


# W13 / W14 -------------------------------------------------------------------
def ffill_bfill(df: DataFrame, cols: list[str], order: list[str], partition: list[str] | None = None,
                backward: bool = True) -> DataFrame:
    """Forward fill, then (optionally) back fill, per partition in time order."""
    w = Window.partitionBy(*(partition or [])).orderBy(*order)
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    bwd = w.rowsBetween(0, Window.unboundedFollowing)
    new = {}
    for c in cols:
        v = F.last(F.col(c), ignorenulls=True).over(fwd)
        if backward:
            v = F.coalesce(v, F.first(F.col(c), ignorenulls=True).over(bwd))
        new[c] = v
    return df.withColumns(new)


# W15 -------------------------------------------------------------------------
def interpolate_linear(df: DataFrame, cols: list[str], order: str,
                       partition: list[str] | None = None) -> DataFrame:
    """Linear interpolation by row position (pandas ``interpolate(limit_direction='both')``).

    Inside: ``prev + (next - prev) * (i - i_prev) / (i_next - i_prev)``; before the
    first and after the last known value the nearest known value is used.
    """
    part = partition or []
    w = Window.partitionBy(*part).orderBy(order)
    x = df.withColumn("_pos", F.row_number().over(w))
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    bwd = w.rowsBetween(0, Window.unboundedFollowing)
    new = {}
    for c in cols:
        known_pos = F.when(F.col(c).isNotNull(), F.col("_pos"))
        pv = F.last(F.col(c), ignorenulls=True).over(fwd)
        pi = F.last(known_pos, ignorenulls=True).over(fwd)
        nv = F.first(F.col(c), ignorenulls=True).over(bwd)
        ni = F.first(known_pos, ignorenulls=True).over(bwd)
        x = x.withColumns({f"_{c}_pv": pv, f"_{c}_pi": pi, f"_{c}_nv": nv, f"_{c}_ni": ni})
        pvc, pic, nvc, nic = (F.col(f"_{c}_{s}") for s in ("pv", "pi", "nv", "ni"))
        interp = pvc + (nvc - pvc) * (F.col("_pos") - pic) / (nic - pic)
        new[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                   .when(pvc.isNull(), nvc).when(nvc.isNull(), pvc)
                   .when(nic == pic, pvc).otherwise(interp))
    x = x.withColumns(new)
    return x.drop("_pos", *[f"_{c}_{s}" for c in cols for s in ("pv", "pi", "nv", "ni")])
