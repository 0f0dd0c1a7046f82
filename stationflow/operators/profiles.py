"""Usage profiles, similarity, clustering of months and weeks, sample weights
(SURVEY 2.11 C1-C15).

Profiles are aggregated first (station x month x slot, or station x week x slot),
so pair comparisons run on profiles, never on trips. Pairs are formed only inside
a station (months of a year: at most 66 pairs; weeks of a year: at most 1,378),
i.e. the pair count is bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import safe_corr

from ..functions.timeparts import week_start_w_mon
from ..util import cut_lineage


# C1 --------------------------------------------------------------------------
def slot_profile(df: DataFrame, keys: list[str], slot: str, value: str) -> DataFrame:
    """Mean ``value`` per (keys, slot): long form (key..., slot, value)."""
    return df.groupBy(*keys, slot).agg(F.avg(value).alias("value"))


# C2 / C3 / J14 ---------------------------------------------------------------
def pair_similarity(profiles: DataFrame, group: list[str], item: str, slot: str = "slot",
                    value: str = "value", zero_norm=0.0) -> DataFrame:
    """Pearson and cosine similarity between every pair (a < b) of items of a group.

    Self join of the long profile on (group, slot) with ``a.item < b.item``; the
    pair count per group is bounded by the calendar (items are months or weeks).
    ``zero_norm`` is the cosine of a pair with a zero vector (0 or None).
    """
    a = profiles.select(*group, F.col(item).alias("item_a"), slot, F.col(value).alias("va"))
    b = profiles.select(*group, F.col(item).alias("item_b"), slot, F.col(value).alias("vb"))
    j = a.join(b, [*group, slot]).filter(F.col("item_a") < F.col("item_b"))
    g = j.groupBy(*group, "item_a", "item_b").agg(
        F.sum(F.col("va") * F.col("vb")).alias("dot"), F.sum(F.col("va") * F.col("va")).alias("na"),
        F.sum(F.col("vb") * F.col("vb")).alias("nb"), safe_corr("va", "vb").alias("pearson"))
    denom = F.sqrt(F.col("na")) * F.sqrt(F.col("nb"))
    cos = F.when(denom == 0, F.lit(zero_norm)).otherwise(F.col("dot") / denom)
    return g.select(*group, "item_a", "item_b", "pearson", cos.alias("cosine"))


# C4 --------------------------------------------------------------------------
def standardize_within(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """z-score per group with the population std (ddof 0); a zero std counts as 1."""
    w = Window.partitionBy(*group)
    out = {}
    for c in cols:
        sd = F.stddev_pop(c).over(w)
        out[c] = (F.col(c) - F.avg(c).over(w)) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return df.withColumns(out)


# C5 --------------------------------------------------------------------------
def ranked_pairs(pairs: DataFrame, group: list[str], score: str = "cosine",
                 threshold: float | None = None) -> DataFrame:
    """Rank a group's pairs by score (descending, ties share the rank); optional
    threshold filter. Ranking stays inside the group (a station's pair table)."""
    x = pairs if threshold is None else pairs.filter(F.col(score) >= threshold)
    return x.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(F.col(score).desc())))


# C6 --------------------------------------------------------------------------
def week_profiles(panel: DataFrame, value: str, station: str = "station_id", time_col: str = "ts") -> DataFrame:
    """168-slot week vectors (slot = weekday*24 + hour, Monday first) over ``W-MON``
    weeks; only weeks with all 168 slots are kept."""
    x = panel.withColumns({"week": week_start_w_mon(F.to_date(time_col)),
                           "slot": F.weekday(time_col) * 24 + F.hour(time_col)})
    full = x.groupBy(station, "week").agg(F.count_distinct("slot").alias("_n")).filter("_n = 168").drop("_n")
    prof = x.groupBy(station, "week", "slot").agg(F.sum(value).alias("value"))
    return prof.join(full, [station, "week"], "left_semi")


# C7 --------------------------------------------------------------------------
def similar_weeks_to_drop(pairs: DataFrame, threshold: float = 0.998, score: str = "cosine", station: str = "station_id") -> DataFrame:
    """Greedy removal, shared by all stations: by falling similarity, the later week of a pair
    with ``threshold`` or more is dropped unless one of the two is dropped already. Returns
    ``removed, kept`` (the week it resembles), ``sim`` and the station of that pair.

    The sequential rule is followed by rounds of local maxima: a pair that comes before all
    other pairs of both its weeks is taken whatever happens elsewhere, so all such pairs are
    taken at once; pairs of a dropped week leave. Ties go by the weeks."""
    key = F.struct((-F.round("sim", 9)).alias("s"), "item_a", "item_b")
    top = F.max_by(F.col(station), F.struct(score, F.col(station))) if station in pairs.columns else F.lit(None).cast("string")
    rest = cut_lineage(pairs.filter(F.col(score) >= threshold).groupBy("item_a", "item_b")
                       .agg(F.max(score).alias("sim"), top.alias(station)).withColumn("_key", key))
    taken = rest.limit(0)
    while not rest.isEmpty():
        ends = rest.select("_key", F.explode(F.array("item_a", "item_b")).alias("w")).groupBy("w").agg(F.min("_key").alias("_first"))
        a, b = (ends.select(F.col("w").alias(f"item_{x}"), F.col("_first").alias(f"_{x}")) for x in "ab")
        best = cut_lineage(rest.join(a, "item_a").join(b, "item_b").filter("_key = _a AND _key = _b").select(*rest.columns))
        taken = taken.unionByName(best)
        gone = best.select(F.col("item_b").alias("w"))
        rest = cut_lineage(rest.join(gone, F.col("w") == F.col("item_a"), "left_anti").join(gone, F.col("w") == F.col("item_b"), "left_anti"))
    return taken.select(F.col("item_b").alias("removed"), F.col("item_a").alias("kept"), "sim", station)


def drop_similar_weeks(panel: DataFrame, removed: DataFrame, time_col: str = "ts") -> DataFrame:
    """``panel`` without the rows of the removed weeks (of any station)."""
    x = panel.withColumn("_week", week_start_w_mon(F.to_date(time_col)))
    return x.join(removed.select(F.col("removed").alias("_week")), "_week", "left_anti").drop("_week")


# C8 --------------------------------------------------------------------------
def ward_labels(x: np.ndarray, k: int) -> np.ndarray:
    """Ward linkage by Lance-Williams updates, cut at k clusters; labels numbered
    1..k by first appearance in row order."""
    n = len(x)
    clusters = {i: [i] for i in range(n)}
    d = {}
    ids = list(range(n))
    for i in ids:
        for j in ids:
            if i < j:
                d[(i, j)] = float(np.sum((x[i] - x[j]) ** 2))  # squared Euclidean
    size = {i: 1 for i in ids}
    nxt = n
    while len(clusters) > k:
        (i, j), _ = min(d.items(), key=lambda kv: (kv[1], kv[0]))
        new = nxt
        nxt += 1
        for m in list(clusters):
            if m in (i, j):
                continue
            dim = d[(min(i, m), max(i, m))]
            djm = d[(min(j, m), max(j, m))]
            dij = d[(i, j)]
            si, sj, sm = size[i], size[j], size[m]
            d[(m, new)] = ((si + sm) * dim + (sj + sm) * djm - sm * dij) / (si + sj + sm)
        clusters[new] = clusters.pop(i) + clusters.pop(j)
        size[new] = size[i] + size[j]
        d = {key: v for key, v in d.items() if i not in key and j not in key}
    labels = np.zeros(n, dtype=int)
    order = sorted(clusters.values(), key=min)
    for lab, members in enumerate(order, start=1):
        labels[members] = lab
    return labels


def ward_clusters(profiles: DataFrame, group: str, item: str, slot: str = "slot", value: str = "value",
                  ks=(2, 3, 4, 5), standardize: bool = False) -> DataFrame:
    """Ward clustering of each group's items (e.g. a station's 12 month vectors) in a
    grouped pandas function; one group is at most 12 short vectors."""
    gtype, itype = dict(profiles.dtypes)[group], dict(profiles.dtypes)[item]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(index=item, columns=slot, values=value, aggfunc="first").sort_index().fillna(0.0)
        x = wide.to_numpy(dtype=float)
        if standardize:
            sd = x.std(axis=0)
            x = (x - x.mean(axis=0)) / np.where(sd == 0, 1.0, sd)
        out = []
        for k in ks:
            if k > len(x):
                continue
            lab = ward_labels(x, k)
            out += [(pdf[group].iloc[0], it, int(k), int(l)) for it, l in zip(wide.index, lab)]
        return pd.DataFrame(out, columns=[group, item, "k", "cluster"])

    return profiles.groupBy(group).applyInPandas(run, schema=f"{group} {gtype}, {item} {itype}, k int, cluster int")


# C9 --------------------------------------------------------------------------
def silhouette(profiles: DataFrame, labels: DataFrame, group: list[str], item: str, slot: str = "slot",
               value: str = "value") -> DataFrame:
    """Mean silhouette (Euclidean distance) per group, from the pair distances of
    the group's items; single-member clusters score 0 (scikit-learn rule)."""
    a = profiles.select(*group, F.col(item).alias("i"), slot, F.col(value).alias("vi"))
    b = profiles.select(*group, F.col(item).alias("j"), slot, F.col(value).alias("vj"))
    d = (a.join(b, [*group, slot]).filter(F.col("i") != F.col("j"))
         .groupBy(*group, "i", "j").agg(F.sqrt(F.sum(F.pow(F.col("vi") - F.col("vj"), 2))).alias("dist")))
    li = labels.select(*group, F.col(item).alias("i"), F.col("cluster").alias("ci"))
    lj = labels.select(*group, F.col(item).alias("j"), F.col("cluster").alias("cj"))
    d = d.join(li, [*group, "i"]).join(lj, [*group, "j"])
    per = d.groupBy(*group, "i", "ci", "cj").agg(F.avg("dist").alias("md"))
    own = per.filter(F.col("ci") == F.col("cj")).select(*group, "i", F.col("md").alias("a"))
    other = per.filter(F.col("ci") != F.col("cj")).groupBy(*group, "i").agg(F.min("md").alias("b"))
    s = li.join(own, [*group, "i"], "left").join(other, [*group, "i"], "left")
    sil = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest(F.col("a"), F.col("b")))
    return s.groupBy(*group).agg(F.avg(sil).alias("silhouette"))


# C10 -------------------------------------------------------------------------
def kmeans_profiles(wide: DataFrame, feature_cols: list[str], k: int = 3, seed: int = 42) -> DataFrame:
    """Scaled k-means of wide profile rows (``StandardScaler`` + ``KMeans``). The rows are
    written once: the fits and the labelling read them again and again."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    pipe = Pipeline(stages=[VectorAssembler(inputCols=feature_cols, outputCol="_raw"),
                            StandardScaler(inputCol="_raw", outputCol="_f", withMean=True, withStd=True),
                            KMeans(k=k, seed=seed, featuresCol="_f", predictionCol="cluster")])
    wide = cut_lineage(wide)
    return pipe.fit(wide).transform(wide).drop("_raw", "_f")


# C11 / C12 -------------------------------------------------------------------
def representatives(profiles: DataFrame, labels: DataFrame, group: list[str], item: str, n: int = 1,
                    slot: str = "slot", value: str = "value") -> DataFrame:
    """Distance of each item to its cluster mean; the n nearest per cluster are the
    representatives (ties by item)."""
    p = profiles.join(labels, [*group, item])
    mean = p.groupBy(*group, "cluster", slot).agg(F.avg(value).alias("_m"))
    d = p.join(mean, [*group, "cluster", slot]).groupBy(*group, "cluster", item).agg(
        F.sqrt(F.sum(F.pow(F.col(value) - F.col("_m"), 2))).alias("dist"))
    w = Window.partitionBy(*group, "cluster").orderBy("dist", item)
    return d.withColumn("rank", F.row_number().over(w)).withColumn(
        "is_representative", (F.col("rank") <= n).cast("int"))


# C13 -------------------------------------------------------------------------
def week_weights(panel: DataFrame, value: str, station: str = "station_id", time_col: str = "ts") -> DataFrame:
    """``exp(log1p(week total) - log1p(station mean week total))`` per ISO week."""
    from ..functions.timeparts import iso_year_week
    wk = panel.groupBy(station, iso_year_week(time_col).alias("year_week")).agg(F.sum(value).alias("week_total"))
    w = Window.partitionBy(station)
    lw = F.log1p("week_total") - F.log1p(F.avg("week_total").over(w))
    return wk.withColumn("log_weight", lw).withColumn("week_weight", F.exp("log_weight"))


def sample_weight(df: DataFrame, weights: DataFrame, station: str = "station_id", time_col: str = "ts",
                  lo: float = 0.3, hi: float = 3.0) -> DataFrame:
    """Attach week weights (missing week -> 1, log 0) and the clipped sample weight."""
    from ..functions.timeparts import iso_year_week
    x = df.withColumn("year_week", iso_year_week(time_col)).join(
        weights.select(station, "year_week", "week_weight", "log_weight"), [station, "year_week"], "left")
    x = x.fillna({"week_weight": 1.0, "log_weight": 0.0})
    return x.withColumn("sample_weight", F.least(F.greatest(F.col("week_weight"), F.lit(lo)), F.lit(hi)))


# C14 -------------------------------------------------------------------------
def peak_weight(hour: str, weekday: str, am=(7, 8, 9), pm=(17, 18, 19)):
    """1 + 0.5 in a peak hour + 0.5 on a weekday peak."""
    peak = F.col(hour).isin(list(am) + list(pm))
    return F.lit(1.0) + F.when(peak, 0.5).otherwise(0.0) + \
        F.when(peak & (F.col(weekday) < 5), 0.5).otherwise(0.0)


# C15 -------------------------------------------------------------------------
def keep_selected(df: DataFrame, selected: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(selected.select(*keys).distinct(), keys, "left_semi")
