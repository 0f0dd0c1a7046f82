"""Area and transit context features.

Dimensions here (districts, subway exits, points of interest) are matched to
stations through the grid joins of ``spatial``; every aggregate is a ``groupBy``
and the one global scalar (the busiest subway day) is a one-row aggregate read
back as a literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import safe_ratio
from ..util import cut_lineage
from . import spatial


def _pdiv(a, b):
    """Division with a zero denominator giving null (population 0 -> null)."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


# A31 -------------------------------------------------------------------------
def region_indices(region_month: DataFrame, key: str = "dong", month: str = "month",
                   pop: str = "pop_total", classes=("pop_c1", "pop_c2", "pop_c3", "pop_c4")) -> DataFrame:
    """Residential ``(a+b)/(2*pop)``, business ``c/pop``, tourism ``d/pop`` per
    (district, month); population 0 gives null."""
    a, b, c, d = classes
    g = region_month.groupBy(key, month).agg(*[F.sum(x).alias(x) for x in (pop, a, b, c, d)])
    return g.select(key, month, F.col(pop).alias("population"),
                    _pdiv(F.col(a) + F.col(b), 2 * F.col(pop)).alias("residential"),
                    _pdiv(F.col(c), F.col(pop)).alias("business"),
                    _pdiv(F.col(d), F.col(pop)).alias("tourism"))


# G12 -------------------------------------------------------------------------
def build_region_features(stations: DataFrame, region_month: DataFrame, radius_m: float = 200.0) -> DataFrame:
    """J11 + A31: per (station, month) the mean indices of the best-tier districts.
    The district table feeds four branches (three tiers and the indices), so it is
    written once (a dimension: one row per district and month)."""
    region_month = cut_lineage(region_month)
    idx = region_indices(region_month)
    match = spatial.three_tier_match(stations, region_month, radius_m)
    j = match.join(idx, ["dong", "month"])
    return j.groupBy("station_id", "month").agg(
        F.min("tier").alias("tier"), F.avg("residential").alias("residential"),
        F.avg("business").alias("business"), F.avg("tourism").alias("tourism"))


# A32 / G13 -------------------------------------------------------------------
BANDS = ("dawn", "am_peak", "daytime", "pm_peak")


SUBWAY = ("transit_index", "commute_in_index", "commute_out_index")


def subway_indices(daily: DataFrame) -> DataFrame:
    """Per (day, name): riders over the global busiest (day, name), the morning share of
    alighting riders (commute in) and the evening share of boarding riders (commute out)."""
    total = sum(F.col(b) for b in BANDS)
    share = lambda way, band: F.avg(F.when(F.col("direction") == way, safe_ratio(F.col(band), total)))
    per = daily.groupBy("day", "name").agg(F.sum(total).alias("riders"),
                                           share("alight", "am_peak").alias("commute_in_index"),
                                           share("board", "pm_peak").alias("commute_out_index"))
    top = per.agg(F.max("riders")).first()[0] or 1.0  # one scalar
    return per.withColumn("transit_index", F.col("riders") / F.lit(float(top))).drop("riders")


def subway_daily_features(stations: DataFrame, points: DataFrame, daily: DataFrame,
                          radius_m: float = 200.0) -> DataFrame:
    """J9 + A32: per station and day of the subway table, the sum of the transit index of
    the subway stops within ``radius_m`` and the mean of their commute indices; 0 where
    there is none."""
    near = spatial.within_radius(stations.select("station_id", "lat", "lon"), points, radius_m,
                                 "station_id", "name").select("station_id", "name").distinct()
    per_day = near.join(subway_indices(daily), "name").groupBy("station_id", "day").agg(
        F.sum("transit_index").alias("transit_index"), *[F.avg(c).alias(c) for c in SUBWAY[1:]])
    lo, hi = (F.lit(d).cast("date") for d in daily.agg(F.min("day"), F.max("day")).first())  # two scalars
    grid = stations.select("station_id", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("day")) \
        .join(daily.select("day").distinct(), "day", "left_semi")
    return grid.join(per_day, ["station_id", "day"], "left").fillna(0.0, subset=list(SUBWAY))


def build_subway_features(stations: DataFrame, points: DataFrame, daily: DataFrame,
                          radius_m: float = 200.0) -> DataFrame:
    """G13 by station: the means of the daily features, for tables whose days differ."""
    means = subway_daily_features(stations, points, daily, radius_m).groupBy("station_id").agg(
        *[F.avg(c).alias(c) for c in SUBWAY])
    return stations.select("station_id").join(means, "station_id", "left").fillna(0.0, subset=list(SUBWAY))


# A33 -------------------------------------------------------------------------
def peak_means(df: DataFrame, keys: list, hour: str, value: str, sets: dict[str, list[int]]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(F.when(F.col(hour).isin(h), F.col(value))).alias(n)
                                   for n, h in sets.items()])


# G11 -------------------------------------------------------------------------
def nearest_distance_km(stations: DataFrame, points: DataFrame, key: str = "station_id",
                        point_key: str = "name", default: float = 1.0) -> DataFrame:
    """Distance to the nearest point in km; stations that cannot be placed get ``default``."""
    nn = spatial.nearest(stations.select(key, "lat", "lon"), points, key, point_key)
    return stations.select(key).join(nn.select(key, (F.col("dist_m") / 1000).alias("near_km")), key, "left") \
        .fillna(default, subset=["near_km"])


# G14 -------------------------------------------------------------------------
def poi_features(stations: DataFrame, pois: DataFrame, features: list[str], key: str = "station_id",
                 poi_key: str = "poi_id", radius_m: float = 200.0) -> DataFrame:
    """Mean of each feature over points within ``radius_m``; null when there is none."""
    near = spatial.within_radius(stations.select(key, "lat", "lon"), pois, radius_m, key, poi_key)
    agg = near.groupBy(key).agg(*[F.avg(f).alias(f) for f in features])
    return stations.select(key).join(agg, key, "left")
