"""Time-ordered train / validation / test splits and exact positions.

Row-position splits need each row's place in a total order. A global ``row_number`` would
pull the whole table into one task. Instead sampled splitters cut the order into ranges
(Spark's range partitioning of the whole sort key, so a single hour that holds every row is
cut as well), each range is sorted in its own task, and the ranges' counts become offsets.
Ranges are cut again until none is above a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..util import cut_lineage

RANGE_ROWS = 1_000_000      # rows that one task sorts
_ROW_BITS = 33              # of monotonically_increasing_id


def ordered_ranges(df: DataFrame, order: list, rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_range`` (ranges follow ``order``) and ``_at`` (0-based place inside the
    range), written once so that both stay fixed; and per range its count ``_c``, the rows
    ``_before`` it and the total ``_n`` (one small row per range). A range above ``rows``
    (default RANGE_ROWS) is cut finer, unless its rows are equal in all of ``order``."""
    rows = rows or RANGE_ROWS
    parts, largest = None, None
    place = F.monotonically_increasing_id()
    while True:
        cut = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
        found = cut.sortWithinPartitions(*order).withColumn("_id", place)
        found = cut_lineage(found.withColumns({"_range": F.shiftright("_id", _ROW_BITS), "_at": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)}).drop("_id"))
        counts = cut_lineage(found.groupBy("_range").agg(F.count(F.lit(1)).alias("_c")))
        top, total = counts.agg(F.max("_c"), F.sum("_c")).first()
        if not total or top <= rows or (largest is not None and top >= largest):
            break
        largest, parts = top, 2 * -(-total // rows) if parts is None else 2 * parts
        df = found.drop("_range", "_at")
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    return found, counts.withColumns({"_before": F.coalesce(F.sum("_c").over(w), F.lit(0)), "_n": F.lit(total or 0).cast("long")})


def global_position(df: DataFrame, order: list, rows: int | None = None) -> DataFrame:
    """``df`` with the 0-based position ``_pos`` of each row in ``order`` (a total order) and
    the total row count ``_n``."""
    found, ranges = ordered_ranges(df, order, rows)
    return found.join(ranges.select("_range", "_before", "_n"), "_range").withColumn("_pos", F.col("_before") + F.col("_at")) \
        .drop("_range", "_at", "_before")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null meets null; ``right``'s copies of the keys go."""
    other = right.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = [left[k].eqNullSafe(other[f"_key{i}"]) for i, k in enumerate(keys)]
    return left.join(other, same, how).drop(*[f"_key{i}" for i in range(len(keys))])


def running_total_before(df: DataFrame, order_col: str, weight_col: str, keys: list[str] = (),
                         buckets: int = 1024) -> DataFrame:
    """For each row, the sum of ``weight_col`` over rows of the same ``keys`` with a
    smaller ``order_col`` (rows unique per keys and order value), in ``_before``.

    Exact, without a window over all rows: approximate quantiles of ``order_col``
    cut it into monotone buckets; bucket totals get a running sum over the small
    (keys x buckets) table, and a window inside each bucket adds the rest."""
    keys = list(keys)
    probs = [i / buckets for i in range(1, buckets)]
    pa = F.array_distinct(F.percentile_approx(order_col, probs, 10 * buckets))
    if keys:
        edges = df.groupBy(*keys).agg(pa.alias("_e"))  # one row per key, `buckets` numbers each
        x = join_null_safe(df, edges, keys)  # one edge row per key; AQE sizes it at run time
        x = x.withColumn("_b", F.size(F.filter("_e", lambda e: e < F.col(order_col)))).drop("_e")
    else:
        # one group: literal bucket edges and the JVM Bucketizer (binary search), no join
        from pyspark.ml.feature import Bucketizer
        x = df.withColumn("_ord", _numeric_order(F.col(order_col), dict(df.dtypes)[order_col]))
        pa = F.array_distinct(F.percentile_approx("_ord", probs, 10 * buckets))
        edges = x.agg(pa).first()[0] or [0.0]  # at most `buckets` increasing numbers
        splits = [float("-inf"), *[float(e) for e in edges], float("inf")]
        x = Bucketizer(splits=splits, inputCol="_ord", outputCol="_b", handleInvalid="keep") \
            .transform(x).drop("_ord")
    per = x.groupBy(*keys, "_b").agg(F.sum(weight_col).alias("_bw"))
    per = per.withColumn("_bb", F.coalesce(F.sum("_bw").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = join_null_safe(x, per.drop("_bw"), [*keys, "_b"])
    within = F.sum(weight_col).over(Window.partitionBy(*keys, "_b").orderBy(order_col)
                                    .rowsBetween(Window.unboundedPreceding, -1))
    return x.withColumn("_before", F.col("_bb") + F.coalesce(within, F.lit(0))).drop("_b", "_bb")


CELLS = 1024                # equal parts of a group's range, counted to tell where its percentiles lie
CROWDED = 0.1               # share of the rows between the bounds from which a sketch gives closer ones
SKETCH = 2560               # accuracy of that sketch


def exact_percentiles(df: DataFrame, col: str, probs: list[float], keys: list[str] = (), name: str = "percentiles",
                      written: bool = False) -> DataFrame:
    """Linearly interpolated percentiles of ``col`` per ``keys``, as an array ``name`` (nulls
    are left out). The values are written once (not if ``df`` is ``written``, that is, read from
    files) and gone over three times: for each group's range, for the counts of its CELLS parts,
    which give each percentile bounds and the rows below them, and for the values between these,
    which alone are shuffled, as counts per distinct value with running totals. Where values crowd
    in few parts, a sketch gives bounds (about 6 / SKETCH of a group). No aggregation buffer holds
    all values of a group, as ``percentile`` would. The counts show whether the wanted ranks lie
    between the bounds; if one does not, all values are taken."""
    keys = list(keys)
    rows = df.filter(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("_v"))
    rows = rows if written else cut_lineage(rows)
    each = [*keys, "_i"]
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1)
    for margin in (3 / SKETCH, None):
        bounds, near = _values_near(rows, probs, keys, margin)
        ranks = bounds.select(*keys, "_n", F.posexplode("_below").alias("_i", "_below")).withColumn("_k", prob * (F.col("_n") - 1))
        run = join_null_safe(running_total_before(near, "_v", "_c", each, buckets=256), ranks, each)
        before = F.col("_below") + F.col("_before")

        def value_at(k):
            return F.max(F.when((before <= k) & (k < before + F.col("_c")), F.col("_v")))

        found = run.groupBy(*each, "_k").agg(value_at(F.floor("_k")).alias("_lo"), value_at(F.ceil("_k")).alias("_hi"))
        found = cut_lineage(found.filter("_lo IS NOT NULL AND _hi IS NOT NULL"))
        if margin is None or found.count() == bounds.filter("_n > 0").count() * len(probs):
            break
    k, lo, hi = F.col("_k"), F.col("_lo"), F.col("_hi")
    mixed = F.when(lo == hi, lo).otherwise((F.ceil(k) - k) * lo + (k - F.floor(k)) * hi)
    found = found.withColumn("_p", mixed).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_p"))).alias("_all"))
    return found.filter(F.size("_all") > 0).select(*keys, F.col("_all._p").alias(name))


def _values_near(rows: DataFrame, probs: list[float], keys: list[str], margin: float | None) -> tuple[DataFrame, DataFrame]:
    """Per ``keys`` the row count ``_n`` and, per percentile, the rows ``_below`` its bounds (an
    array); and the counts ``_c`` per keys, percentile ``_i`` and value ``_v`` between the bounds.
    These come from counted cells, or are ``margin`` apart from the percentile in a sketch; None
    sets no bounds."""
    v, each = F.col("_v"), range(len(probs))
    sketch = None if margin is None else _bounds_by_cells(rows, probs, keys)
    if sketch is not None:
        bounds = sketch.select(*keys, "_n", "_below")
    else:
        if margin is None:
            sides = F.array(*[F.lit(x) for _ in probs for x in (float("-inf"), float("nan"))])       # nan sorts last
        else:
            sides = F.percentile_approx("_v", [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))], SKETCH)
        # stored, so that its size is known and ``rows`` are not shuffled to meet a few rows
        sketch = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), sides.alias("_e"))
                             .select(*keys, "_n", *[F.col("_e")[2 * i + side].alias(f"_{name}{i}") for i in each for side, name in enumerate(("lo", "hi"))]))
        below = [F.count_if(v < F.col(f"_lo{i}")) for i in each]
        bounds = cut_lineage(_beside(rows, sketch, keys).groupBy(*keys, "_n").agg(F.array(*below).alias("_below")))
    inside = [(v >= F.col(f"_lo{i}")) & (v <= F.col(f"_hi{i}")) for i in each]
    some = _beside(rows, sketch, keys).filter(F.greatest(*inside) if len(inside) > 1 else inside[0])
    near = some.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    of = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(inside)])))
    return bounds, cut_lineage(_beside(near, sketch, keys).select(*keys, of.alias("_i"), "_v", "_c"))


def _beside(rows: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the row of ``few`` (stored, one per ``keys``, each key of the rows) that has
    their ``keys``. They meet by a hash, the cheapest key of a join, if no two keys share it."""
    if not keys:
        return rows.crossJoin(F.broadcast(few))
    if all(kind in ("string", "tinyint", "smallint", "int", "bigint", "date", "boolean") for kind in dict(few.select(*keys).dtypes).values()):
        hashed = few.withColumn("_hash", F.xxhash64(*keys))
        distinct, n = hashed.agg(F.count_distinct("_hash"), F.count(F.lit(1))).first()
        if distinct == n:
            return rows.join(hashed.drop(*keys), F.xxhash64(*keys) == F.col("_hash")).drop("_hash")
    return join_null_safe(rows, few, keys)


def _bounds_by_cells(rows: DataFrame, probs: list[float], keys: list[str]) -> DataFrame | None:
    """Per ``keys`` the row count ``_n`` and, per percentile, the rows ``_below`` its bounds (an array)
    and the bounds ``_lo0, _hi0, ...``: the least and greatest value of the cells with its ranks.
    None where too many rows lie between bounds."""
    v, top = F.col("_v"), F.lit(float("inf"))
    finite = F.when((v > -top) & (v < top), v)
    ends = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(finite).alias("_min"), F.max(finite).alias("_max")))
    part = F.try_divide(v / 2 - F.col("_min") / 2, F.col("_max") / 2 - F.col("_min") / 2)                # halves do not overflow
    cell = F.when(F.isnan(v), CELLS + 1).when(v == top, CELLS).when(v == -top, -1) \
        .otherwise(F.coalesce(F.least(F.floor(part * CELLS), F.lit(CELLS - 1)), F.lit(0))).cast("int")
    cells = _beside(rows, ends, keys).groupBy(*keys, "_n", cell.alias("_cell")) \
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_a"), F.max("_v").alias("_z"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)      # few cells a group
    cells = cells.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    ranks = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    has = [(F.col("_before") <= F.ceil(k)) & (F.floor(k) < F.col("_before") + F.col("_c")) for k in ranks]
    between = F.sum(F.when((F.greatest(*has) if len(has) > 1 else has[0]) & (F.col("_a") < F.col("_z")), F.col("_c")))
    found = cut_lineage(cells.groupBy(*keys, "_n").agg(
        F.coalesce(between, F.lit(0)).alias("_between"), F.array(*[F.min(F.when(h, F.col("_before"))) for h in has]).alias("_below"),
        *[x for i, h in enumerate(has) for x in (F.min(F.when(h, F.col("_a"))).alias(f"_lo{i}"), F.max(F.when(h, F.col("_z"))).alias(f"_hi{i}"))]))
    between, n = found.agg(F.coalesce(F.sum("_between"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if between > n * max(CROWDED, 2 * 6 / SKETCH * len(probs)) and n > CELLS:
        return None
    return found.drop("_between")


def _numeric_order(col: Column, dtype: str) -> Column:
    """A double that sorts like ``col`` (timestamps as epoch seconds, dates as days)."""
    if dtype.startswith("timestamp"):
        from ..functions.timeparts import epoch_seconds
        return epoch_seconds(col.cast("timestamp_ntz"))
    if dtype == "date":
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("double")
    return col.cast("double")


# M1 / M8 / M9 ----------------------------------------------------------------
def split_by_dates(time_col: str, valid_start, test_start) -> Column:
    t = F.col(time_col)
    return (F.when(t < F.lit(valid_start), F.lit("train"))
             .when(t < F.lit(test_start), F.lit("valid")).otherwise(F.lit("test")))


# M2 --------------------------------------------------------------------------
def split_by_ratio(df: DataFrame, order: list[str], fractions=(0.8,), names=("train", "test")) -> DataFrame:
    """First ``fractions[0]`` of rows in time order -> names[0], and so on
    (cut positions ``int(n * cumulative fraction)``, pandas ``iloc`` style)."""
    x = global_position(df, order)
    cum, expr = 0.0, None
    for f, name in zip(fractions, names):
        cum += f
        cond = F.col("_pos") < F.floor(F.col("_n") * F.lit(cum))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return x.withColumn("split", expr.otherwise(F.lit(names[len(fractions)]))).drop("_pos", "_n")


# M3 --------------------------------------------------------------------------
def split_by_distinct_time(df: DataFrame, time_col: str, ratio: float = 0.8) -> DataFrame:
    """The first ``ratio`` of distinct timestamps train, the rest test. The rank of a
    distinct timestamp is a bucketed running count (no global window); the join back
    is left to the optimizer (AQE broadcasts it when the distinct set is small)."""
    ts = df.select(time_col).distinct().withColumn("_one", F.lit(1))
    n = ts.count()  # one scalar
    r = running_total_before(ts, time_col, "_one")
    r = r.withColumn("split", F.when(F.col("_before") < F.floor(F.lit(n) * ratio), "train").otherwise("test"))
    return df.join(r.select(time_col, "split"), time_col)


# M4 --------------------------------------------------------------------------
def split_by_time_quantile(df: DataFrame, time_col: str, q: float = 0.8) -> DataFrame:
    """Rows at or before the q-quantile of time are train (one scalar, from counts per time)."""
    from ..functions.timeparts import epoch_seconds, from_epoch_seconds
    found = exact_percentiles(df.select(epoch_seconds(time_col).alias("_t")), "_t", [q])
    row = found.select(from_epoch_seconds(F.col("percentiles")[0])).first()
    cut = row[0] if row else None
    return df.withColumn("split", F.when(F.col(time_col) <= F.lit(cut), "train").otherwise("test"))


# M5 --------------------------------------------------------------------------
def split_within_groups(df: DataFrame, groups: list[str], order: list[str], ratio: float = 0.7) -> DataFrame:
    """Inside each group (e.g. station x month) the first ``ratio`` rows train, with
    at least one row on each side when the group has two or more."""
    w = Window.partitionBy(*groups).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*groups))
    k = F.least(F.greatest(F.floor(n * ratio), F.lit(1)), n - 1)
    return df.withColumn("split", F.when(F.row_number().over(w) <= k, "train").otherwise("test"))


# M6 --------------------------------------------------------------------------
def ts_fold_labels(df: DataFrame, order: list[str], k: int = 5, gap: int = 0) -> DataFrame:
    """``TimeSeriesSplit(k, gap)``: test_size = n // (k+1); fold i tests rows
    [n - (k-i)*size, n - (k-i-1)*size) and trains on rows < start - gap.
    One output row per (row, fold) where the row takes part: role train or test."""
    x = global_position(df, order)
    size = F.floor(F.col("_n") / (k + 1))
    x = x.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("_n") - (F.lit(k) - F.col("fold")) * size
    role = (F.when((F.col("_pos") >= start) & (F.col("_pos") < start + size), F.lit("test"))
             .when(F.col("_pos") < start - gap, F.lit("train")))
    return x.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_pos", "_n")


# M7 --------------------------------------------------------------------------
def rolling_month_folds(df: DataFrame, time_col: str, train_end: str, k: int = 3) -> DataFrame:
    """The k months before ``train_end`` each serve once as validation; training is
    everything before that month. Bounds are generated, then a range filter."""
    end = F.to_date(F.lit(train_end))
    x = df.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
    vstart = F.add_months(F.trunc(end, "month"), -F.col("fold"))
    vend = F.add_months(vstart, 1)
    t = F.to_date(time_col)
    role = F.when((t >= vstart) & (t < vend), F.lit("valid")).when(t < vstart, F.lit("train"))
    return x.withColumn("role", role).filter(F.col("role").isNotNull())


# M8 --------------------------------------------------------------------------
# The last train month and the validation months of each fold.
MONTH_FOLDS = ((3, (4, 5)), (5, (6, 7)), (7, (8, 9)), (9, (10, 11, 12)))


def fixed_month_folds(df: DataFrame, time_col: str, year: int, folds=MONTH_FOLDS) -> DataFrame:
    """Folds of one year by fixed months: one row per (row, fold) that it takes part in, with
    ``fold`` (from 1) and ``role``: train up to the fold's last train month, valid in its
    validation months. A fold that lacks either side is left out."""
    month = F.month(time_col)
    parts = [F.when(month <= last, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
             .when(month.isin(list(valid)), F.struct(F.lit(i).alias("fold"), F.lit("valid").alias("role")))
             for i, (last, valid) in enumerate(folds, start=1)]
    x = df.filter(F.year(time_col) == year)
    x = x.select("*", F.explode(F.array_compact(F.array(*parts))).alias("_f")).select(*df.columns, "_f.*")
    sides = df.filter(F.year(time_col) == year).select(month.alias("m")).distinct()            # at most 12 rows
    months = {r["m"] for r in sides.collect()}
    whole = [i for i, (last, valid) in enumerate(folds, start=1) if any(m <= last for m in months) and months & set(valid)]
    return x.filter(F.col("fold").isin(whole))


# O4 / O5 ---------------------------------------------------------------------
def positional_slice(df: DataFrame, partition: list[str], order: list, first: int | None = None,
                     last: int | None = None) -> DataFrame:
    """First / last n rows per group in order (``head``/``tail``/``iloc``), by row
    number ranges rather than a bare ``limit``."""
    w = Window.partitionBy(*partition).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*partition))
    x = df.withColumns({"_rn": F.row_number().over(w), "_cnt": n})
    cond = F.lit(False)
    if first is not None:
        cond = cond | (F.col("_rn") <= first)
    if last is not None:
        cond = cond | (F.col("_rn") > F.col("_cnt") - last)
    return x.filter(cond).drop("_rn", "_cnt")


def seeded_sample(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """The n rows of the smallest seeded hash of the key: the same under retries and for any
    partitioning. The hash is uniform, so a bound slightly above the n-th smallest value is
    known from the row count; only the rows below it are ordered."""
    h = F.xxhash64(*key, F.lit(seed))
    total = df.count()
    if n >= total:
        return df
    share = n / total
    slack = 6 * (n ** 0.5 + 1) / total
    while True:
        bound = min(1.0, share + slack)
        low = df.withColumn("_h", h).filter(F.col("_h") <= F.lit(int(-(2**63) + bound * (2**64 - 1) - 1024) if bound < 1 else 2**63 - 1))
        pos = global_position(low, ["_h", *key])
        r = pos.agg(F.max("_n")).first()[0] or 0
        if r >= n or bound >= 1:
            return pos.filter(F.col("_pos") < n).drop("_pos", "_n", "_h")
        slack *= 4


def shuffled_columns(df: DataFrame, cols: list[str], key: list[str], repeats: int = 1, seed: int = 42) -> DataFrame:
    """``df`` with ``<col>__shuffled1 .. <col>__shuffled<repeats>``: full seeded shuffles of the
    columns, all from one sort. Rows are put in the order of a seeded hash of ``key``; shuffle
    ``r`` gives each row the values of the row ``r`` places further on, around the end. In a
    random order that is a uniformly random cycle, and no row keeps its own value while ``r``
    is no multiple of the number of rows. Only the first rows of a range travel, to the last
    rows of the range before."""
    found, ranges = ordered_ranges(df.withColumn("_h", F.xxhash64(*key, F.lit(seed))), ["_h", *key])
    x = found.join(ranges, "_range").withColumn("_pos", F.col("_before") + F.col("_at"))
    values = F.struct(*[F.col(f"`{c}`").alias(c) for c in cols])
    w = Window.partitionBy("_range").orderBy("_at")
    steps = range(1, repeats + 1)
    x = x.withColumns({f"_s{r}": F.lead(values, r).over(w) for r in steps})
    # the tail of a range: its missing values are heads of later ranges
    heads = found.filter(F.col("_at") < repeats).join(ranges, "_range") \
        .select((F.col("_before") + F.col("_at")).alias("_to"), values.alias("_v"))
    want = found.select("_range", "_at").join(ranges, "_range").filter(F.col("_at") >= F.col("_c") - repeats) \
        .select((F.col("_before") + F.col("_at")).alias("_pos"), "_at", "_c", "_n", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("_r")) \
        .filter(F.col("_at") + F.col("_r") >= F.col("_c")).withColumn("_to", F.pmod(F.col("_pos") + F.col("_r"), F.col("_n")))
    tails = want.join(heads, "_to").groupBy("_pos").agg(*[F.any_value(F.when(F.col("_r") == r, F.col("_v")), ignoreNulls=True).alias(f"_t{r}") for r in steps])
    x = x.join(tails, "_pos", "left")
    out = {}
    for r in steps:
        own = F.when(F.col("_at") + r < F.col("_c"), F.col(f"_s{r}")).otherwise(F.col(f"_t{r}"))
        out |= {f"{c}__shuffled{r}": own[c] for c in cols}
    return x.withColumns(out).drop("_h", "_range", "_at", "_c", "_before", "_n", "_pos", *[f"_{k}{r}" for r in steps for k in "st"])


def permute_column(df: DataFrame, col: str, key: list[str], seed: int = 42) -> DataFrame:
    """Full seeded shuffle of one column."""
    name = f"{col}__shuffled1"
    return shuffled_columns(df, [col], key, 1, seed).withColumn(col, F.col(f"`{name}`")).drop(name)


# M9 --------------------------------------------------------------------------
def leave_years(df: DataFrame, time_col: str, train_year: int, test_year: int, order: list[str]) -> DataFrame:
    """Train on one year, test on the next; when the test year is absent, the last
    20 % of rows (time order) is the test set."""
    has_test = df.filter(F.year(time_col) == test_year).limit(1).count() > 0
    if has_test:
        y = F.year(time_col)
        return df.filter(y.isin(train_year, test_year)).withColumn(
            "split", F.when(y == train_year, "train").otherwise("test"))
    return split_by_ratio(df, order, (0.8,), ("train", "test"))
