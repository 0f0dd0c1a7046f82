"""Feature diagnostics.

All statistics are aggregations: a correlation matrix is one merge of partial pair
moments; per-feature statistics are one ``agg`` returning an array of
structs; rank statistics work on counts per distinct value. Long form
``(feature, x, y)`` lets one ``groupBy(feature)`` handle every feature at once.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import safe_corr
from ..util import cut_lineage
from .moments import pair_correlations
from .splits import exact_percentiles, ordered_ranges, running_total_before


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# X1 / X2 ---------------------------------------------------------------------
def corr_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Upper-triangle Pearson pairs ``(variable_1, variable_2, correlation, abs_correlation)``."""
    out = pair_correlations(df, list(itertools.combinations(cols, 2))).drop("n")
    return out.withColumn("abs_correlation", F.abs("correlation"))


def high_pairs(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    return pairs.filter(F.col("abs_correlation") >= threshold)


# X3 / W20 --------------------------------------------------------------------
def spearman(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Spearman correlation of each feature with the target, on rows where both exist.

    All features at once, on counts per distinct (x, y): a value's average rank is the
    number of rows below it plus half of its ties, from one bucketed running total over
    the distinct values of both sides; the correlation is the count-weighted one."""
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), _q(f).cast("double").alias("x"),
                                                  _q(target).cast("double").alias("y")) for f in features])))
    xy = pairs.filter(F.col("x").isNotNull() & F.col("y").isNotNull()) \
        .groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("c"))
    sides = xy.select("feature", "c", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("v"))
                                                         for s in ("x", "y")])))
    counts = sides.groupBy("feature", "side", "v").agg(F.sum("c").alias("c"))
    ranks = running_total_before(counts, "v", "c", ["feature", "side"], buckets=256) \
        .select("feature", "side", "v", (F.col("_before") + (F.col("c") + 1) / 2.0).alias("rank"))
    n = xy.groupBy("feature").agg(((F.sum("c") + 1) / 2.0).alias("mid"))   # one row per feature
    for s in ("x", "y"):
        side = ranks.filter(F.col("side") == s).select("feature", F.col("v").alias(s), F.col("rank").alias(f"r{s}"))
        xy = xy.join(side, ["feature", s])
    xy = xy.join(F.broadcast(n), "feature")
    dx, dy = F.col("rx") - F.col("mid"), F.col("ry") - F.col("mid")
    sums = xy.groupBy("feature").agg(F.sum(F.col("c") * dx * dy).alias("xy"), F.sum(F.col("c") * dx * dx).alias("xx"),
                                     F.sum(F.col("c") * dy * dy).alias("yy"))
    got = sums.select("feature", F.try_divide("xy", F.nullif(F.sqrt("xx") * F.sqrt("yy"), F.lit(0.0))).alias("spearman"))
    every = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(got, "feature", "left")


# X4 / X5 / X6 / X7 / X9 ------------------------------------------------------
def feature_profile(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """One row per feature: nunique (null counts as a value), missing and zero
    ratios, min, max, mean, std (ddof 1), bias-corrected skew, 0/1 check, and the
    polynomial signal ``|corr((x-mean)^2, y)| - |corr(x-mean, y)|`` when a target is
    given.

    The rows are read once, as counts per feature and value (with the target's moments
    beside them), combined map-side; everything else comes from those counts, so there is
    no distinct aggregate that would copy every row once per feature."""
    y = _q(target).cast("double") if target is not None else F.lit(None).cast("double")
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), _q(f).cast("double").alias("x"), y.alias("y")) for f in features])))
    per = cut_lineage(cells.groupBy("feature", "x").agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.count("y").cast("double").alias("cy"), F.avg("y").alias("my"), F.var_pop("y").alias("vy"),
        F.min("y").alias("ly"), F.max("y").alias("hy")))
    x, c, has = F.col("x"), F.col("c"), F.col("x").isNotNull()
    first = per.groupBy("feature").agg(
        F.sum("c").alias("rows"), F.coalesce(F.sum(F.when(has, c)), F.lit(0.0)).alias("n"), F.count(F.lit(1)).alias("nunique"),
        F.coalesce(F.sum(F.when(x == 0, c)), F.lit(0.0)).alias("zeros"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.try_divide(F.sum(F.when(has, c * x)), F.sum(F.when(has, c))).alias("mean"),
        F.coalesce(F.bool_and(F.when(has, x.isin(0, 1))), F.lit(False)).alias("is_binary"), F.count("x").alias("values"),
        F.coalesce(F.sum(F.when(has, F.col("cy"))), F.lit(0.0)).alias("ny"),
        F.try_divide(F.sum(F.when(has & (F.col("cy") > 0), F.col("cy") * F.col("my"))), F.sum(F.when(has, F.nullif("cy", F.lit(0.0))))).alias("meany"),
        F.min(F.when(has, F.col("ly"))).alias("ly"), F.max(F.when(has, F.col("hy"))).alias("hy"))
    at = per.filter(has).join(first.select("feature", "mean", "meany"), "feature")              # one row per feature on the right
    dx, dy, cy = x - F.col("mean"), F.col("my") - F.col("meany"), F.col("cy")
    both = {"a": dx, "q": dx * dx}
    sums = {"m2": F.sum(c * dx * dx), "m3": F.sum(c * dx * dx * dx), "yy": F.sum(F.when(cy > 0, cy * (F.col("vy") + dy * dy)))}
    for k, v in both.items():
        sums |= {f"s_{k}": F.sum(cy * v), f"ss_{k}": F.sum(cy * v * v), f"sy_{k}": F.sum(F.when(cy > 0, cy * v * dy))}
    g = first.join(at.groupBy("feature").agg(*[e.alias(k) for k, e in sums.items()]), "feature", "left")
    n, m2 = F.col("n"), F.col("m2") / F.nullif("n", F.lit(0.0))
    skew = F.when((n > 2) & (m2 > 0), F.col("m3") / n / F.pow(m2, 1.5) * F.sqrt(n * (n - 1)) / (n - 2))

    def corr(k):
        var = F.col(f"ss_{k}") - F.try_divide(F.col(f"s_{k}") * F.col(f"s_{k}"), F.nullif("ny", F.lit(0.0)))
        return F.abs(F.try_divide(F.col(f"sy_{k}"), F.nullif(F.sqrt(F.greatest(var, F.lit(0.0)) * F.col("yy")), F.lit(0.0))))

    cols = ["feature", "nunique", (1 - n / F.col("rows")).alias("missing_ratio"), (F.col("zeros") / F.col("rows")).alias("zero_ratio"), "min", "max", "mean",
            F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"), skew.alias("skew"), "is_binary"]
    if target is not None:
        enough = (n >= 5) & (F.col("values") >= 3) & (F.col("ly") < F.col("hy"))
        cols.append(F.when(enough, corr("q") - corr("a")).alias("poly_signal"))
    every = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return every.join(g.select(*cols), "feature", "left")


def transform_hint(profile: DataFrame, skew_min: float = 1.0, signal_min: float = 0.05) -> DataFrame:
    """At most 2 values -> keep; skew >= 1 and non-negative -> log; poly signal >= 0.05 ->
    poly; else keep."""
    hint = (F.when(F.col("nunique") <= 2, F.lit("keep"))
             .when((F.col("skew") >= skew_min) & (F.col("min") >= 0), F.lit("log"))
             .when(F.col("poly_signal") >= signal_min, F.lit("poly")).otherwise(F.lit("keep")))
    return profile.withColumn("hint", hint)


# X8 --------------------------------------------------------------------------
def drop_reasons(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Columns to drop with a reason: non-numeric, all missing, constant."""
    from ..schema import numeric_columns
    num = set(numeric_columns(df))
    non_num = [c for c in df.columns if c not in num]
    spark = df.sparkSession
    nn = spark.createDataFrame([(c, "non_numeric") for c in non_num], "feature string, reason string")
    rules = profile.select("feature", F.when(F.col("missing_ratio") == 1, "all_missing")
                           .when(F.col("nunique") <= 1, "constant").alias("reason")).na.drop()
    return nn.unionByName(rules)


# X10 -------------------------------------------------------------------------
def partner_rules(profile: DataFrame, pairs: DataFrame, importance: DataFrame,
                  threshold: float = 0.95) -> DataFrame:
    """High-correlation partners per feature and the must-drop / consider-drop rules."""
    hp = pairs.filter(F.col("abs_correlation") >= threshold)
    both = hp.select(F.col("variable_1").alias("feature"), F.col("variable_2").alias("p")).unionByName(
        hp.select(F.col("variable_2").alias("feature"), F.col("variable_1").alias("p")))
    partners = both.groupBy("feature").agg(F.array_sort(F.collect_list("p")).alias("high_corr_partners"))
    r = profile.select("feature", "nunique", "missing_ratio").join(partners, "feature", "left") \
        .join(importance, "feature", "left")
    imp = F.coalesce(F.col("importance"), F.lit(0.0))
    must = (F.col("nunique") <= 1) | ((imp < 0.001) & (F.col("missing_ratio") >= 0.9))
    npart = F.coalesce(F.size("high_corr_partners"), F.lit(0))
    return r.withColumns({"drop_must": must, "drop_consider": ~must & ((imp < 0.003) | (npart >= 1))})


# X11 -------------------------------------------------------------------------
def derived_rule_drops(pairs: DataFrame, rules: dict[str, set[str]], threshold: float) -> DataFrame:
    """For each high pair: if one side is a derived feature and the other one of its
    bases, drop the base; otherwise manual review."""
    spark = pairs.sparkSession
    rt = spark.createDataFrame([(d, b) for d, bs in rules.items() for b in sorted(bs)],
                               "derived string, base string")
    hp = pairs.filter(F.col("abs_correlation") >= threshold)
    a = hp.join(F.broadcast(rt), (F.col("variable_1") == F.col("derived")) & (F.col("variable_2") == F.col("base")),
                "left").select(*hp.columns, F.col("derived").alias("d1"), F.col("base").alias("b1"))
    b = a.join(F.broadcast(rt), (F.col("variable_2") == F.col("derived")) & (F.col("variable_1") == F.col("base")),
               "left")  # rule table: fixed, a handful of rows
    return b.select(*hp.columns,
                    F.coalesce("d1", "derived").alias("derived_variable"),
                    F.coalesce("b1", "base").alias("base_variable_to_drop"),
                    F.when(F.coalesce("d1", "derived").isNull(), F.lit("manual_review"))
                    .otherwise(F.lit("rule")).alias("rule_applied"))


# X12 -------------------------------------------------------------------------
def top_features(df: DataFrame, features: list[str], targets: list[str], n: int = 3) -> DataFrame:
    long = pair_correlations(df, [(t, f) for t in targets for f in features], ("target", "feature")) \
        .drop("n").withColumn("abs_correlation", F.abs("correlation"))
    w = Window.partitionBy("target").orderBy(F.desc("abs_correlation"), "feature")
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


# X13 -------------------------------------------------------------------------
# greatest() skips nulls, so the log transform guards them explicitly
TRANSFORMS = {"raw": lambda x: x, "log": lambda x: F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0)))),
              "poly": lambda x: x * x}
SIMPLICITY = {"raw": 0, "log": 1, "poly": 2}


def to_long(df: DataFrame, features: list[str], target: str, extra: list[str] = ()) -> DataFrame:
    """(extra..., feature, transform, x, y) rows for every feature and transform."""
    items = [F.struct(F.lit(f).alias("feature"), F.lit(t).alias("transform"), fn(_q(f).cast("double")).alias("x"))
             for f in features for t, fn in TRANSFORMS.items()]
    return df.select(*extra, _q(target).cast("double").alias("y"), F.explode(F.array(*items)).alias("_i")) \
        .select(*extra, "_i.*", "y").filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def _qbin(col: str, edges: str) -> Column:
    below = F.size(F.filter(F.slice(edges, F.lit(2), F.size(edges)), lambda e: e < F.col(col)))
    return F.least(below, F.size(edges) - 2)


def binned_mutual_information(long: DataFrame, bins: int = 10) -> DataFrame:
    """MI (nats) between quantile bins of x and of y, per (feature, transform):
    exact quantile edges with duplicates dropped, right-closed bins, then joint and
    marginal counts."""
    probs = [i / bins for i in range(bins + 1)]
    keys = ["feature", "transform"]
    e = exact_percentiles(long, "x", probs, keys, "ex").join(exact_percentiles(long, "y", probs, keys, "ey"), keys) \
        .select(*keys, F.array_distinct("ex").alias("ex"), F.array_distinct("ey").alias("ey"))
    # one edge row per (feature, transform): a handful of rows
    b = long.join(F.broadcast(e), keys).select(*keys, _qbin("x", "ex").alias("bx"), _qbin("y", "ey").alias("by"))
    joint = b.groupBy(*keys, "bx", "by").agg(F.count(F.lit(1)).alias("nxy"))
    w_all, w_x, w_y = (Window.partitionBy(*keys), Window.partitionBy(*keys, "bx"),
                       Window.partitionBy(*keys, "by"))
    j = joint.withColumns({"n": F.sum("nxy").over(w_all), "nx": F.sum("nxy").over(w_x),
                           "ny": F.sum("nxy").over(w_y)})
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return j.groupBy(*keys).agg(F.sum(term).alias("mi"))


def transform_comparison(df: DataFrame, features: list[str], target: str, bins: int = 10, min_rows: int = 30) -> DataFrame:
    """Per feature the absolute correlation and the binned mutual information of x, of
    log(1 + x) (null where a value is negative) and of x with x^2 (the larger correlation,
    the sum of the informations); the best is the largest mean of the two, the simplest at a
    tie. Features with fewer than ``min_rows`` complete rows are left out."""
    long = to_long(df, features, target)
    stats = long.groupBy("feature", "transform").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.abs(safe_corr("x", "y")).alias("r"))
    s = stats.join(binned_mutual_information(long, bins), ["feature", "transform"])

    def of(transform, col):
        return F.max(F.when(F.col("transform") == transform, F.col(col)))

    ok = of("raw", "low") >= 0
    g = s.groupBy("feature").agg(
        of("raw", "n").alias("n"), of("raw", "r").alias("raw_abs_corr"), of("raw", "mi").alias("raw_mi"),
        F.when(ok, of("log", "r")).alias("log_abs_corr"), F.when(ok, of("log", "mi")).alias("log_mi"),
        F.greatest(of("raw", "r"), of("poly", "r")).alias("poly_abs_corr"),
        (of("raw", "mi") + of("poly", "mi")).alias("poly_mi")).filter(F.col("n") >= min_rows)
    # mean of what is there; the mutual information is always there but for the skipped log
    score = {t: F.round((F.coalesce(f"{t}_abs_corr", F.lit(0.0)) + F.col(f"{t}_mi"))
                        / F.when(F.col(f"{t}_abs_corr").isNull(), 1).otherwise(2), 9) for t in SIMPLICITY}
    best = F.greatest(*score.values())
    choice = F.coalesce(*[F.when(score[t] == best, F.lit(t)) for t in SIMPLICITY])
    return g.withColumn("best_transform", choice).drop("n")


# X14 -------------------------------------------------------------------------
def feature_blocks(df: DataFrame, features: list[str], target: str, order: list[str], k: int = 5) -> DataFrame:
    """Long rows ``(feature, block, x, y)`` of the complete rows of each feature: with ``n``
    of them, the last ``k`` runs of ``n // (k + 1)`` rows in ``order`` are blocks 0 .. k - 1,
    the rows before them block -1. Fold i tests on block i and trains on the blocks before.

    One pass for all features: the rows are cut into ordered ranges, complete rows are
    counted per range, ranges get running totals (a small table), and one window inside each
    range adds the rest."""
    here = {f: (_q(f).isNotNull() & _q(target).isNotNull()).cast("long") for f in features}
    x, _ = ordered_ranges(df, order)
    per = x.groupBy("_range").agg(*[F.sum(c).alias(f"_c_{f}") for f, c in here.items()])
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    per = per.select("_range", *[F.coalesce(F.sum(f"_c_{f}").over(w), F.lit(0)).alias(f"_before_{f}") for f in features],
                     *[F.sum(f"_c_{f}").over(Window.partitionBy()).alias(f"_n_{f}") for f in features])
    inner = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"_p_{f}": F.sum(c).over(inner) - 1 for f, c in here.items()}).join(per, "_range")
    items = [F.struct(F.lit(f).alias("feature"), _q(f).cast("double").alias("x"),
                      (F.col(f"_before_{f}") + F.col(f"_p_{f}")).alias("pos"), F.col(f"_n_{f}").alias("n")) for f in features]
    x = x.select(F.inline(F.array(*items)), _q(target).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    size = F.floor(F.col("n") / (k + 1))
    block = F.greatest(F.lit(-1), F.floor((F.col("pos") - (F.col("n") - k * size)) / size)).cast("int")
    return x.filter(size > 0).select("feature", block.alias("block"), "x", "y")


def cv_transform_choice(blocks: DataFrame, k: int = 5) -> DataFrame:
    """For each feature and fold, fit ``y ~ x`` (raw, log) or ``y ~ x + x^2`` (poly) on the
    blocks before the fold's own, from the blocks' moments, and score its block: mean and
    deviation of r2 and MAE over the folds and the correlation of all out-of-fold
    predictions; ranked by rounded r2 (desc), MAE, correlation (desc), simplicity.
    ``blocks`` comes from :func:`feature_blocks` with the same ``k``."""
    fx = {"raw": F.col("x"), "log": F.log1p(F.greatest(F.col("x"), F.lit(0.0))), "poly": F.col("x")}
    long = blocks.select("feature", "block", "y", F.inline(F.array(*[
        F.struct(F.lit(t).alias("transform"), c.alias("x")) for t, c in fx.items()])))
    keys = ["feature", "transform"]
    # moments about fixed centres, so that the sums stay small
    mid = long.groupBy(*keys).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))   # a row per feature and transform
    u, v = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    terms = {"n": F.lit(1.0), "u": u, "uu": u * u, "uuu": u * u * u, "uuuu": u * u * u * u,
             "v": v, "vv": v * v, "uv": u * v, "uuv": u * u * v}
    sums = long.join(F.broadcast(mid), keys).groupBy(*keys, "block", "cx", "cy") \
        .agg(*[F.sum(c).alias(f"s_{m}") for m, c in terms.items()])
    w = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)   # k + 1 rows
    t = sums.select(*keys, "block", "cx", "cy", *[F.sum(f"s_{m}").over(w).alias(m) for m in terms]).filter("block >= 0")
    n = F.col("n")
    m = {c: F.col(c) / n for c in terms if c != "n"}
    suu, suq = m["uu"] - m["u"] * m["u"], m["uuu"] - m["u"] * m["uu"]
    sqq = m["uuuu"] - m["uu"] * m["uu"]
    suv, sqv = m["uv"] - m["u"] * m["v"], m["uuv"] - m["uu"] * m["v"]
    det = suu * sqq - suq * suq
    varies = suu > 1e-12 * m["uu"]   # what rounding leaves of a constant x is no variance
    # with two values of x the line says it all
    poly = (F.col("transform") == "poly") & varies & (det > 1e-9 * suu * sqq)
    b1 = F.when(poly, (suv * sqq - sqv * suq) / det).when(varies, suv / suu).otherwise(0.0)
    b2 = F.when(poly, (sqv * suu - suv * suq) / det).otherwise(0.0)
    t = t.withColumns({"b1": b1, "b2": b2}).withColumn("b0", m["v"] - F.col("b1") * m["u"] - F.col("b2") * m["uu"])
    fit = t.select(*keys, "block", "cx", "cy", "b0", "b1", "b2")   # k rows per feature and transform
    te = long.join(F.broadcast(fit), [*keys, "block"])
    pred = F.col("cy") + F.col("b0") + F.col("b1") * u + F.col("b2") * u * u
    te = te.select(*keys, "block", "y", "cy", pred.alias("pred"))
    e = F.col("y") - F.col("pred")
    # one pass: a fold's errors, and its moments about the centre of y for the correlation of all folds
    p, q = F.col("pred") - F.col("cy"), F.col("y") - F.col("cy")
    per = te.groupBy(*keys, "block").agg(
        F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"), (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("p"), F.sum(q).alias("q"), F.sum(p * p).alias("pp"),
        F.sum(q * q).alias("qq"), F.sum(p * q).alias("pq"))
    per = per.withColumn("r2", F.when(F.col("sst") == 0, F.lit(0.0)).otherwise(1 - F.col("sse") / F.col("sst")))
    all_n = F.sum("n")

    def cov(ab, a, b):
        return F.sum(ab) - F.sum(a) * F.sum(b) / all_n

    vp, vq = cov("pp", "p", "p"), cov("qq", "q", "q")
    oof = F.when((vp > 1e-12 * F.sum("pp")) & (vq > 1e-12 * F.sum("qq")), cov("pq", "p", "q") / F.sqrt(vp * vq))
    g = per.groupBy(*keys).agg(F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"), F.avg("mae").alias("mae"),
                               F.stddev_pop("mae").alias("mae_std"), oof.alias("oof_corr"))
    simp = F.create_map(*[x for kv in SIMPLICITY.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    w = Window.partitionBy("feature").orderBy(F.desc(F.round("r2", 4)), F.round("mae", 4),
                                              F.desc(F.round("oof_corr", 4)), simp[F.col("transform")])
    return g.withColumn("rank", F.row_number().over(w))


# X15 -------------------------------------------------------------------------
def apply_transforms(df: DataFrame, choice: dict[str, str]) -> DataFrame:
    """Add the chosen transform of each feature as ``<name>_log`` / ``<name>_sq``."""
    new = {}
    for f, t in choice.items():
        if t == "log":
            new[f"{f}_log"] = TRANSFORMS["log"](_q(f).cast("double"))
        elif t == "poly":
            new[f"{f}_sq"] = TRANSFORMS["poly"](_q(f).cast("double"))
    return df.withColumns(new) if new else df


# X16 -------------------------------------------------------------------------
def f_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Univariate F statistic ``r^2 / (1 - r^2) * (n - 2)`` per feature (pairwise
    complete rows), ranked."""
    x = pair_correlations(df, [(f, target) for f in features], ("feature", "_t")) \
        .select("feature", F.col("correlation").alias("r"), "n")
    r2 = F.col("r") * F.col("r")
    x = x.withColumn("f_stat", F.when(r2 < 1, r2 / (1 - r2) * (F.col("n") - 2)))
    # one row per feature: a window without partition over a feature-sized table
    return x.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("f_stat"), "feature")))
