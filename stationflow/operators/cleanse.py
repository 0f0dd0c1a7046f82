"""Row filters, guards and de-duplication.

All of these are map-side predicates (pushed into the Parquet scan where they
touch raw columns) except the keyed de-duplications, which shuffle on their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..util import bounded_broadcast


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 / F2 / F3 ----------------------------------------------------------------
def filter_station_rows(df: DataFrame, ids, start: str = "start_id", end: str = "end_id") -> DataFrame:
    """Origin or destination in ``ids`` (literal list -> IN predicate pushed down;
    DataFrame -> two left joins against the distinct id set, so a row matching on
    both ends is kept once)."""
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        flag = ids.select(F.col(key).alias("_id"), F.lit(True).alias("_hit")).distinct()
        fb = bounded_broadcast(flag)  # an id list: checked small before the hint
        x = (df.join(fb.withColumnsRenamed({"_id": start, "_hit": "_hs"}), start, "left")
               .join(fb.withColumnsRenamed({"_id": end, "_hit": "_he"}), end, "left"))
        return x.filter(F.coalesce("_hs", F.lit(False)) | F.coalesce("_he", F.lit(False))) \
                .select(*df.columns)
    ids = list(ids)
    return df.filter(F.col(start).isin(ids) | F.col(end).isin(ids))


def filter_station_contains(df: DataFrame, ids, start: str = "start_id", end: str = "end_id") -> DataFrame:
    """substring mode (``ST-48`` also matches ``ST-481``), kept as its own mode."""
    cond = None
    for i in ids:
        c = F.contains(F.col(start), F.lit(i)) | F.contains(F.col(end), F.lit(i))
        cond = c if cond is None else (cond | c)
    return df.filter(F.coalesce(cond, F.lit(False)))


def basis_aware_keep(df: DataFrame, ids, start: str = "start_id", end: str = "end_id",
                     basis: str = "basis", dep: str = "dep", arr: str = "arr") -> DataFrame:
    """origin in list on departure rows, destination in list on arrival rows."""
    ids = list(ids)
    return df.filter(((F.col(basis) == dep) & F.col(start).isin(ids)) |
                     ((F.col(basis) == arr) & F.col(end).isin(ids)))


# F4-F7 -----------------------------------------------------------------------
def distance_guard(df: DataFrame, dist: str = "use_dist", min_m: float = 50.0) -> DataFrame:
    """numeric(dist) > 50; unparsable values dropped."""
    return df.filter(F.col(dist).cast("string").try_cast("double") > F.lit(min_m))


def min_use_guard(df: DataFrame, minutes: str = "use_min", dist: str = "use_dist",
                  min_minutes: float = 5, min_dist: float = 5) -> DataFrame:
    """``min >= 5 and dist >= 5``."""
    return df.filter((F.col(minutes) >= min_minutes) & (F.col(dist) >= min_dist))


def strict_use_guard(df: DataFrame, minutes: str | None = "use_min", dist: str | None = "use_dist",
                     min_minutes: float = 5, min_dist: float = 0) -> DataFrame:
    """``min > 5`` and ``dist > 0``; a guard whose column is absent is skipped."""
    out = df
    if minutes and minutes in df.columns:
        out = out.filter(F.col(minutes) > min_minutes)
    if dist and dist in df.columns:
        out = out.filter(F.col(dist) > min_dist)
    return out


def drop_zero_trips(df: DataFrame, minutes: str = "use_min", dist: str = "use_dist") -> DataFrame:
    """drop rows whose distance and minutes are both zero (missing counts as 0)."""
    z = (F.coalesce(F.col(dist), F.lit(0)) == 0) & (F.coalesce(F.col(minutes), F.lit(0)) == 0)
    return df.filter(~z)


# F8 / F9 ---------------------------------------------------------------------
def drop_unknown_destination(df: DataFrame, end: str = "end_id", unknown: str = "X") -> DataFrame:
    """F8: drop ``upper(trim(end)) == 'X'``; null destinations are kept."""
    return df.filter(F.coalesce(F.upper(F.trim(F.col(end))) != F.lit(unknown), F.lit(True)))


def drop_internal_arrival_duplicates(df: DataFrame, ids, start: str = "start_id", end: str = "end_id",
                                     basis: str = "basis", arr: str = "arr",
                                     observation: Observation | None = None) -> DataFrame:
    """arrival rows whose two ends are both targets are counted twice in the
    source (once per basis); drop them. The removed count is reported through an
    ``Observation`` (metric ``removed``) without a second pass."""
    ids = list(ids)
    dup = (F.col(basis) == arr) & F.col(start).isin(ids) & F.col(end).isin(ids)
    x = df
    if observation is not None:
        x = x.observe(observation, F.count_if(dup).alias("removed"))
    return x.filter(~dup)


def internal_arrival_count(df: DataFrame, ids, start: str = "start_id", end: str = "end_id", basis: str = "basis", arr: str = "arr") -> DataFrame:
    """One row: rows read, removed by :func:`drop_internal_arrival_duplicates` and kept."""
    ids = list(ids)
    dup = F.coalesce((F.col(basis) == arr) & F.col(start).isin(ids) & F.col(end).isin(ids), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(dup).alias("removed"), F.count_if(~dup).alias("kept"))


# F10-F14 ---------------------------------------------------------------------
def date_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """inclusive range; ``lo``/``hi`` are Columns or literals of the column's type."""
    return df.filter(F.col(col).between(lo, hi))


def keep_hours(df: DataFrame, hours, col: str = "hour") -> DataFrame:
    return df.filter(F.col(col).isin(list(hours)))


def exclude_key_and_missing(df: DataFrame, key: str, value, coords=("lat", "lon")) -> DataFrame:
    """drop one key value and rows missing any coordinate."""
    return df.filter(F.col(key) != F.lit(value)).na.drop(subset=list(coords))


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=subset)


def exclude_zero_counts(df: DataFrame, cnt: str = "cnt") -> DataFrame:
    """``round(cnt) != 0`` with half-to-even rounding (Python ``round``)."""
    return df.filter(F.bround(F.col(cnt), 0) != 0)


# F18 -------------------------------------------------------------------------
def calendar_slice(df: DataFrame, col: str, year: int | None = None, month: int | None = None,
                   weekday: int | None = None) -> DataFrame:
    """e.g. year 2024, month 1, Saturday (weekday Mon=0 -> 5)."""
    cond = F.lit(True)
    if year is not None:
        cond = cond & (F.year(col) == year)
    if month is not None:
        cond = cond & (F.month(col) == month)
    if weekday is not None:
        cond = cond & (F.weekday(col) == weekday)
    return df.filter(cond)


# F19 -------------------------------------------------------------------------
def missing_ids(df: DataFrame, col: str, required: DataFrame) -> DataFrame:
    """Required ids absent from ``df`` (left anti join on distinct ids)."""
    key = required.columns[0]
    return required.select(F.col(key).alias(col)).distinct() \
        .join(df.select(col).distinct(), col, "left_anti")


def require_ids(df: DataFrame, col: str, required: DataFrame) -> DataFrame:
    """raise when a required id is missing; otherwise return ``df``."""
    miss = missing_ids(df, col, required).limit(20).collect()
    if miss:
        raise ValueError(f"missing required {col}: {[r[0] for r in miss]}")
    return df


# F20 -------------------------------------------------------------------------
def involvement_label(ids, start: str = "start_id", end: str = "end_id") -> Column:
    ids = list(ids)
    s, e = F.col(start).isin(ids), F.col(end).isin(ids)
    return (F.when(s & e, F.lit("both")).when(s, F.lit("origin_only"))
             .when(e, F.lit("destination_only")).otherwise(F.lit("none")))


# A23 / U2 --------------------------------------------------------------------
def first_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key in the given ascending order (never bare
    dropDuplicates). ``min_by`` over a struct is an aggregate with map-side
    combine, so a key holding a third of all rows is reduced inside every task
    instead of being sorted in one window partition."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    key = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(row, key).alias("_r")).select(*keys, "_r.*")


def union_priority(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union several sources; for each key the earliest source in the list wins."""
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    return first_by_key(u, keys, [F.col("_src")]).drop("_src")
