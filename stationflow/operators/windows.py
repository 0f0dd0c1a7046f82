"""Per-station window features.

Every window is partitioned (by station, or station plus a calendar key) and
ordered by time with a full tie-break, so each window task holds one station's
calendar-bounded panel, never a raw trip stream. "Guarded" frames return null
until they are full, like pandas ``rolling(n)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..util import cut_lineage
from .splits import exact_percentiles


def _w(partition, order):
    part = [partition] if isinstance(partition, str) else list(partition or [])
    ordr = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*part).orderBy(*ordr)


# W1 / W2 ---------------------------------------------------------------------
def add_lags(df: DataFrame, col: str, lags, partition="station_id", order="ts",
             prefix: str | None = None) -> DataFrame:
    """``lag(col, k)`` per station; run on a dense panel so rows equal hours."""
    w = _w(partition, order)
    p = prefix or f"{col}_lag"
    return df.withColumns({f"{p}{k}": F.lag(col, k).over(w) for k in lags})


def add_leads(df: DataFrame, col: str, leads, partition="station_id", order="ts") -> DataFrame:
    w = _w(partition, order)
    return df.withColumns({f"{col}_lead{k}": F.lead(col, k).over(w) for k in leads})


# W3 / W4 / W5 ----------------------------------------------------------------
def guarded(fn, col: str, w, n: int) -> Column:
    """Aggregate over a frame of ``n`` rows, null until the frame is full."""
    return F.when(F.count(F.col(col)).over(w) == n, fn(F.col(col)).over(w))


def add_trailing_means(df: DataFrame, col: str, sizes, partition="station_id", order="ts",
                       shift: int = 1) -> DataFrame:
    """Mean of the previous ``n`` rows (``shift(1).rolling(n).mean()``)."""
    base = _w(partition, order)
    out = {}
    for n in sizes:
        w = base.rowsBetween(-(n + shift - 1), -shift) if shift else base.rowsBetween(-(n - 1), 0)
        out[f"{col}_roll{n}"] = guarded(F.avg, col, w, n)
    return df.withColumns(out)


def add_trailing_std(df: DataFrame, col: str, n: int = 24, partition="station_id", order="ts",
                     shift: int = 1, null_to_zero: bool = False) -> DataFrame:
    base = _w(partition, order)
    w = base.rowsBetween(-(n + shift - 1), -shift) if shift else base.rowsBetween(-(n - 1), 0)
    v = guarded(F.stddev_samp, col, w, n)
    if null_to_zero:
        v = F.coalesce(v, F.lit(0.0))
    return df.withColumn(f"{col}_std{n}", v)


def add_centered_stats(df: DataFrame, col: str, n: int = 3, partition="station_id",
                       order="ts") -> DataFrame:
    """Mean / std of the current and previous n-1 rows; std null -> 0."""
    w = _w(partition, order).rowsBetween(-(n - 1), 0)
    return df.withColumns({
        f"{col}_mean{n}": guarded(F.avg, col, w, n),
        f"{col}_sd{n}": F.coalesce(guarded(F.stddev_samp, col, w, n), F.lit(0.0)),
    })


# W6 --------------------------------------------------------------------------
def add_future_sum(df: DataFrame, col: str, n: int = 12, partition="station_id",
                   order="ts", name: str | None = None) -> DataFrame:
    """Demand of the next ``n`` rows including this one (``rolling(n).sum().shift(-(n-1))``)."""
    w = _w(partition, order).rowsBetween(0, n - 1)
    return df.withColumn(name or f"{col}_next{n}", guarded(F.sum, col, w, n))


# W7 --------------------------------------------------------------------------
def add_expanding_mean(df: DataFrame, col: str, partition, order="ts",
                       name: str | None = None) -> DataFrame:
    """Mean of all earlier rows of the same partition (e.g. station, weekday, hour)."""
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name or f"{col}_expmean", F.avg(col).over(w))


# W8 / W9 / W10 ---------------------------------------------------------------
def add_diff(df: DataFrame, col: str, partition="station_id", order="ts",
             name: str | None = None) -> DataFrame:
    w = _w(partition, order)
    return df.withColumn(name or f"{col}_diff",
                         F.coalesce(F.col(col) - F.lag(col, 1).over(w), F.lit(0)).cast("bigint"))


def add_running_sum(df: DataFrame, col: str, partition="station_id", order="ts",
                    before: bool = False, name: str | None = None) -> DataFrame:
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    v = F.sum(col).over(w)
    if before:
        v = F.coalesce(v, F.lit(0))
    return df.withColumn(name or (f"{col}_cum_before" if before else f"{col}_cum"), v)


def add_running_stock(df: DataFrame, net: str, initial, partition="station_id", order="ts",
                      name: str = "stock") -> DataFrame:
    """``initial + sum(net before this row)``, clipped at 0 (output only)."""
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, -1)
    init = F.col(initial) if isinstance(initial, str) else F.lit(initial)
    return df.withColumn(name, F.greatest(init + F.coalesce(F.sum(net).over(w), F.lit(0)), F.lit(0)))


# W11 / W12 -------------------------------------------------------------------
def add_cycle_lags(df: DataFrame, col: str, partition="station_id", order="cycle_start") -> DataFrame:
    """Previous cycle (lag 1) and same cycle of the previous day (lag 2)."""
    w = _w(partition, order)
    return df.withColumns({f"{col}_prev_cycle": F.lag(col, 1).over(w),
                           f"{col}_prev_day_cycle": F.lag(col, 2).over(w)})


def add_cycle_means(df: DataFrame, col: str, partition="station_id", order="cycle_start",
                    flag: str = "cycle_hour") -> DataFrame:
    """Means of the previous 2/3/7 cycles; same-cycle means over 7/14 previous days;
    change versus the previous cycle."""
    base = _w(partition, order)
    same = _w([partition, flag] if isinstance(partition, str) else list(partition) + [flag], order)
    out = {f"{col}_prev{n}_mean": guarded(F.avg, col, base.rowsBetween(-n, -1), n) for n in (2, 3, 7)}
    out.update({f"{col}_same{n}_mean": guarded(F.avg, col, same.rowsBetween(-n, -1), n) for n in (7, 14)})
    out[f"{col}_change"] = F.col(col) - F.lag(col, 1).over(base)
    return df.withColumns(out)


# W16 / W17 / W18 -------------------------------------------------------------
def add_rank(df: DataFrame, col: str, partition=None, ascending: bool = True,
             name: str | None = None) -> DataFrame:
    """pandas ``rank(method='min')``."""
    o = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    w = Window.partitionBy(*([partition] if isinstance(partition, str) else (partition or []))).orderBy(o)
    return df.withColumn(name or f"{col}_rank", F.rank().over(w))


def top_n(df: DataFrame, partition, order: list[Column], n: int) -> DataFrame:
    """Top-n rows per group; ``order`` must include a full tie-break."""
    w = Window.partitionBy(*([partition] if isinstance(partition, str) else partition)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def arg_best(df: DataFrame, keys: list, metric: str, cols: list[str], largest: bool = False,
             tiebreak: list[str] = ()) -> DataFrame:
    """Row with the min (or max) metric per group, first in ``tiebreak`` order on ties
    (pandas ``idxmin``/``idxmax``): ``min_by`` on a struct key, one pass with
    partial aggregation, no sort of the group."""
    s = F.struct(*[F.col(c) for c in cols])
    m = -F.col(metric) if largest else F.col(metric)
    key = F.struct(m, *[F.col(t) for t in tiebreak])
    return df.groupBy(*keys).agg(F.min_by(s, key).alias("_b")).select(*keys, "_b.*")


def argmax_column(cols: list[str]) -> Column:
    """Name of the column with the largest value in a row (first on ties)."""
    best = F.greatest(*[F.col(c) for c in cols])
    expr = None
    for c in cols:
        expr = F.when(F.col(c) == best, F.lit(c)) if expr is None else expr.when(F.col(c) == best, F.lit(c))
    return expr


# W20 -------------------------------------------------------------------------
def add_average_rank(df: DataFrame, col: str, partition=None, name: str | None = None) -> DataFrame:
    """Rank with ties averaged (``rank(method='average')``)."""
    part = [partition] if isinstance(partition, str) else list(partition or [])
    w = Window.partitionBy(*part).orderBy(F.col(col))
    tie = Window.partitionBy(*part, col)
    return df.withColumn(name or f"{col}_avgrank",
                         F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0)


# W21 -------------------------------------------------------------------------
def quantile_bins(df: DataFrame, col: str, q: int, value: str | None = None,
                  partition: list[str] | None = None) -> DataFrame:
    """``qcut(col, q, duplicates='drop')``: exact linear quantile edges, duplicate
    edges removed, right-closed bins, first bin includes the minimum; then the
    median and mean of ``value`` (default ``col``) per bin. The columns are written
    once, then the binned values, so that no pass computes ``df`` again."""
    value = value or col
    part = partition or []
    df = cut_lineage(df.select(*dict.fromkeys([*part, col, value])))
    probs = [i / q for i in range(q + 1)]
    if part:
        edges = exact_percentiles(df, col, probs, part, "_edges", written=True).withColumn("_edges", F.array_distinct("_edges"))
        x = df.join(edges, part, "inner")  # one edge row per group; AQE sizes it at run time
    else:
        # q+1 numbers: a metric row read back, then used as a literal array
        found = exact_percentiles(df, col, probs, written=True).select(F.array_distinct("percentiles")).first()
        x = df.withColumn("_edges", F.array(*[F.lit(float(e)) for e in (found[0] if found else [])]).cast("array<double>"))
    # bin index: number of inner edges strictly below the value (right-closed bins)
    nbins = F.size("_edges") - 1
    below = F.size(F.filter(F.slice("_edges", F.lit(2), F.size("_edges")), lambda e: e < F.col(col)))
    x = x.withColumn("bin", F.when(F.col(col).isNull(), F.lit(None))
                     .otherwise(F.least(below, nbins - 1)).cast("int"))
    keys = [*part, "bin"]
    x = cut_lineage(x.select(*dict.fromkeys([*keys, value])))
    sums = x.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")).alias("s")
    mid = exact_percentiles(x, value, [0.5], keys, "_mid", written=True).alias("m")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    return sums.join(mid, same, "left").select(*[f"s.{k}" for k in keys], F.col("_mid")[0].alias("median"), "mean", "n")
