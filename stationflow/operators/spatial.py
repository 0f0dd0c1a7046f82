"""Distance joins and spatial grouping.

Range joins never compare every station with every point. Both sides get a grid
cell whose size is at least the search radius; the point side is replicated into
its 3x3 neighbourhood and the join is an equi join on the cell, followed by the
exact haversine filter. The work is proportional to the true candidate pairs, and
the join shuffles on the cell like any other equi join (AQE splits hot cells).

Nearest-one search descends a pyramid of occupied cells, all rows at once and a fixed
number of levels; cells that can't hold the nearest point are left out by a bound on
the distance, so the answer is exact.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, haversine_m
from ..util import cut_lineage

# A cell is a hair wider than the radius, so that rounding never loses a pair.
_MARGIN = 1.000001


def _band(lat, radius_m: float):
    return F.floor(F.col(lat) / F.lit(math.degrees(radius_m / EARTH_RADIUS_M) * _MARGIN)).cast("bigint")


def _columns(band, radius_m: float):
    """Number of cells around the globe in a latitude band: each is at least as wide as
    the largest longitude difference within the radius from any point of the band; one
    cell where the radius reaches over a pole."""
    angle = radius_m / EARTH_RADIUS_M
    if angle >= math.pi / 2:
        return F.lit(1).cast("bigint")
    height = F.lit(angle * _MARGIN)
    top = F.least(F.lit(math.pi / 2), F.greatest(F.abs(band * height), F.abs((band + 1) * height)))
    share = F.lit(math.sin(angle)) / F.greatest(F.cos(top), F.lit(1e-12))
    width = F.degrees(F.asin(F.least(share, F.lit(1.0)))) * F.lit(_MARGIN)
    return F.when(share < 1, F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(360.0) / width))) \
        .otherwise(F.lit(1).cast("bigint"))


def _column(lon, count):
    return F.pmod(F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) * count / 360.0).cast("bigint"), count)


def within_radius(left: DataFrame, right: DataFrame, radius_m: float, left_key: str, right_key: str,
                  lat: str = "lat", lon: str = "lon", by: tuple = ()) -> DataFrame:
    """All (left, right) pairs within ``radius_m`` metres, with ``dist_m``; ``by``
    names columns that must be equal on both sides.

    Right-side columns other than the key keep their names with an ``r_`` prefix
    for the coordinates. Cells follow the latitude band and wrap at longitude 180, so
    the join is exact on the whole globe.
    """
    there = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    L = left.filter(there).withColumn("_ci", _band(lat, radius_m)) \
        .withColumn("_cj", _column(lon, _columns(F.col("_ci"), radius_m)))
    near = [F.lit(x).cast("bigint") for x in (-1, 0, 1)]
    R = right.filter(there).withColumn("_ci", F.explode(F.array(*[_band(lat, radius_m) + x for x in near])))
    R = R.withColumn("_n", _columns(F.col("_ci"), radius_m)).withColumn("_cj", _column(lon, F.col("_n")))
    R = R.withColumn("_cj", F.explode(F.array_distinct(F.array(*[F.pmod(F.col("_cj") + x, F.col("_n")) for x in near])))) \
        .drop("_n").withColumnsRenamed({lat: "r_lat", lon: "r_lon"})
    j = L.join(R, ["_ci", "_cj", *by]).drop("_ci", "_cj")
    j = j.withColumn("dist_m", haversine_m(lat, lon, "r_lat", "r_lon"))
    return j.filter(F.col("dist_m") <= radius_m)


# Cells of the pyramid: level 0 has 45 degrees a side, each further level a sixteenth of that.
_TOP_DEG, _LEVELS, _FAN_BITS = 45.0, 4, 4


def _leaf(lat: str, lon: str) -> tuple:
    """Cell numbers at the finest level; a level above is them shifted right."""
    size = F.lit(_TOP_DEG / 2 ** (_FAN_BITS * (_LEVELS - 1)))
    return F.floor((F.col(lat) + 90.0) / size).cast("bigint"), F.floor(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) / size).cast("bigint")


def _least_distance(lat, lon, box):
    """A lower bound of the distance from a point to any point of a box of latitudes and
    longitudes (``lon`` and the box's from 0 to 360): along the meridian to its latitudes and
    to the nearer of its meridians."""
    south, north = box["s"], box["n"]
    d_lat = F.greatest(south - F.col(lat), F.col(lat) - north, F.lit(0.0))
    east = F.pmod(box["w"] - F.col(lon), F.lit(360.0))                    # degrees to go east to its western edge
    west = F.pmod(F.col(lon) - box["e"], F.lit(360.0))
    d_lon = F.when((F.col(lon) >= box["w"]) & (F.col(lon) <= box["e"]), F.lit(0.0)).otherwise(F.least(east, west, F.lit(90.0)))
    across = F.asin(F.least(F.lit(1.0), F.cos(F.radians(lat)) * F.sin(F.radians(d_lon))))
    return F.greatest(F.radians(d_lat), across) * EARTH_RADIUS_M


def nearest(left: DataFrame, right: DataFrame, left_key: str, right_key: str, lat: str = "lat", lon: str = "lon",
            by: tuple = ()) -> DataFrame:
    """Nearest right point for every left point (ties: smallest right key),
    among those with equal ``by`` columns. Rows without coordinates are dropped.

    One pass over the points builds a pyramid: per level and occupied cell, the box of its
    points and one of them. Every row descends it, all rows at once and a fixed number of
    levels: of the cells below those it holds, it keeps the ones that can be as near as the
    nearest point seen so far. So a row meets a bounded number of cells a level, wherever its
    nearest point is, and compares itself only with the points of the finest cells left."""
    keys = [left_key, *by]
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    rcols = [c for c in right.columns if c not in (lat, lon, *by)]
    fi, fj = _leaf(lat, lon)
    # points of one place count once, by the smallest key
    pts = right.filter(placed).groupBy(*by, lat, lon).agg(F.min_by(F.struct(*rcols), right_key).alias("_r")) \
        .withColumns({"_fi": fi, "_fj": fj, "_l": F.pmod(F.col(lon) + 180.0, F.lit(360.0))})
    pts = cut_lineage(pts)
    at = [F.struct(F.lit(k).alias("_k"), *[F.shiftright(c, _FAN_BITS * (_LEVELS - 1 - k)).alias(n) for c, n in (("_fi", "_ci"), ("_fj", "_cj"))])
          for k in range(_LEVELS)]
    cells = cut_lineage(pts.select(*by, lat, lon, "_l", F.inline(F.array(*at))).groupBy("_k", *by, "_ci", "_cj").agg(
        F.struct(F.min(lat).alias("s"), F.max(lat).alias("n"), F.min("_l").alias("w"), F.max("_l").alias("e")).alias("_box"),
        F.min(F.struct(lat, lon)).alias("_one")))

    def level(k: int) -> DataFrame:
        """The cells of a level; as a written table its size is known, so a small one is broadcast."""
        above = [F.shiftright(c, _FAN_BITS).alias(n) for c, n in (("_ci", "_pi"), ("_cj", "_pj"))] if k else []
        return cells.filter(F.col("_k") == k).select(*by, "_ci", "_cj", "_box", "_one", *above)

    rows = left.filter(placed).select(*keys, F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct() \
        .withColumns({"_x": F.pmod(F.col("_lon") + 180.0, F.lit(360.0)), "_u": F.lit(float("inf"))})
    carried = [*keys, "_lat", "_lon", "_x", "_u"]
    row = Window.partitionBy(*keys, "_lat", "_lon")
    tops = [F.struct(F.lit(i).cast("bigint").alias("_ci"), F.lit(j).cast("bigint").alias("_cj")) for i in range(5) for j in range(8)]   # 5: the pole itself
    here = rows.select(*carried, F.inline(F.array(*tops))).join(level(0), [*by, "_ci", "_cj"])
    for k in range(_LEVELS):
        if k:
            here = here.select(*carried, F.col("_ci").alias("_pi"), F.col("_cj").alias("_pj")).join(level(k), [*by, "_pi", "_pj"])
        seen = haversine_m(F.col("_lat"), F.col("_lon"), F.col("_one")[lat], F.col("_one")[lon])
        here = here.withColumn("_u", F.least(F.col("_u"), F.min(seen).over(row))) \
            .filter(_least_distance("_lat", "_x", F.col("_box")) <= F.col("_u") * (1 + 1e-9) + 1e-3)
    near = here.select(*keys, "_lat", "_lon", F.col("_ci").alias("_fi"), F.col("_cj").alias("_fj")).join(
        pts.withColumnsRenamed({lat: "r_lat", lon: "r_lon"}).drop("_l"), [*by, "_fi", "_fj"]) \
        .withColumn("dist_m", haversine_m("_lat", "_lon", "r_lat", "r_lon"))
    best = near.groupBy(*keys, "_lat", "_lon").agg(
        F.min_by(F.struct("_r.*", "r_lat", "r_lon", "dist_m"), F.struct("dist_m", F.col("_r")[right_key])).alias("_b")) \
        .select(*keys, "_lat", "_lon", "_b.*")
    own = {k: f"_key{i}" for i, k in enumerate(keys)}
    best = best.withColumnsRenamed(own)
    same = [left[k] == best[n] for k, n in own.items()] + [left[lat] == best["_lat"], left[lon] == best["_lon"]]
    return left.join(best, same).drop(*own.values(), "_lat", "_lon")


def three_tier_match(stations: DataFrame, regions: DataFrame, radius_m: float = 200.0,
                     station_key: str = "station_id", region_key: str = "dong",
                     district: str = "dong", month: str = "month") -> DataFrame:
    """For each station and month, the regions with data in the month within
    ``radius_m`` (tier 1); else the regions of its own district (tier 2); else the
    nearest region (tier 3). Returns (station, month, region key, tier)."""
    keys = [station_key, month]
    pts = cut_lineage(regions.select(month, region_key, "lat", "lon").distinct())        # a dimension: one row per region and month
    t1 = within_radius(stations.select(station_key, "lat", "lon"), pts, radius_m, station_key, region_key) \
        .select(*keys, region_key, F.lit(1).alias("tier"))
    t2 = stations.select(station_key, F.col(district).alias(region_key)).join(pts.select(month, region_key), region_key) \
        .select(*keys, region_key, F.lit(2).alias("tier"))
    close = cut_lineage(t1.unionByName(t2).distinct().withColumn("_best", F.min("tier").over(Window.partitionBy(*keys)))
                        .filter("tier = _best").drop("_best"))
    # only the stations of a month without either are searched further
    months = sorted(r[0] for r in pts.select(month).distinct().collect())                # calendar-sized
    kind = regions.schema[month].dataType.simpleString()
    every = stations.withColumn(month, F.explode(F.array(*[F.lit(m) for m in months]).cast(f"array<{kind}>")))
    left = every.select(*keys, "lat", "lon").join(close.select(*keys).distinct(), keys, "left_anti")
    t3 = nearest(left, pts.withColumnRenamed(region_key, "_rk"), station_key, "_rk", by=(month,)) \
        .select(*keys, F.col("_rk").alias(region_key), F.lit(3).alias("tier"))
    return close.unionByName(t3)


def _grams(text: str, k: int):
    """Distinct pieces of k characters; shorter texts have none."""
    return F.when(F.length(text) >= k, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - k + 1, F.lit(1))),
                                                                    lambda p: F.substr(F.col(text), p, F.lit(k))))).otherwise(F.array().cast("array<string>"))


def substring_match(left: DataFrame, registry: DataFrame, text: str, reg_text: str, reg_order: str,
                    k: int = 3) -> DataFrame:
    """Each left row's text contained in a registry text; the first registry
    row (by ``reg_order``, then text) wins. Null and empty texts match nothing.

    A registry text that holds a text holds all of its grams, so one gram is enough to find it:
    each distinct text takes the one that the fewest registry rows have (grams of k
    characters, or the whole text where it is shorter), ``contains`` verifies. A gram that a
    whole city shares is taken only by a text that has no rarer one; a text with a gram that
    no registry row has is not looked up at all."""
    texts = left.select(F.col(text).alias("_t")).filter(F.length("_t") > 0).distinct()
    own = texts.withColumn("_g", F.explode(F.when(F.length("_t") >= k, _grams("_t", k)).otherwise(F.array("_t"))))
    pieces = F.array_distinct(F.flatten(F.array(*[_grams(reg_text, n) for n in range(1, k + 1)])))
    index = registry.withColumn("_g", F.explode(pieces))
    often = index.groupBy("_g").agg(F.count(F.lit(1)).alias("_c"))
    ranked = own.join(often, "_g", "left").groupBy("_t").agg(
        F.bool_and(F.col("_c").isNotNull()).alias("_all"), F.min_by("_g", F.struct("_c", "_g")).alias("_g")).filter("_all").drop("_all")
    ranked = cut_lineage(ranked)                                            # a row per distinct text
    found = index.join(ranked.select("_g").distinct(), "_g", "left_semi").join(ranked, "_g").filter(F.contains(F.col(reg_text), F.col("_t")))
    first = found.groupBy("_t").agg(F.min_by(F.struct(*registry.columns), F.struct(reg_order, reg_text)).alias("_r"))
    return left.join(first, left[text] == first["_t"]).select(*[left[c] for c in left.columns], "_r.*")


# G15-G19 -----------------------------------------------------------------------
def kmeans_clusters(points: DataFrame, k: int, key: str = "station_id", seed: int = 42,
                    lat: str = "lat", lon: str = "lon") -> DataFrame:
    """K-means on (lat, lon); cluster ids 1..k numbered by the centre's (lat, lon)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    pts = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    va = VectorAssembler(inputCols=[lat, lon], outputCol="features")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="raw").fit(va.transform(pts))
    centers = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    order = {raw: n + 1 for n, (raw, _, _) in enumerate(sorted(centers, key=lambda t: (t[1], t[2])))}
    relabel = F.create_map(*[x for kv in order.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = model.transform(va.transform(pts)).withColumn("cluster", relabel[F.col("raw")])
    return out.drop("features", "raw")


def k_search(points: DataFrame, ks=range(4, 13), seed: int = 42, lat: str = "lat",
             lon: str = "lon") -> DataFrame:
    """Inertia (training cost) and silhouette (Spark's squared-Euclidean form)
    per k; each fit is a distributed job, the loop is over k only."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=[lat, lon], outputCol="features")
    data = va.transform(points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())).cache()
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    rows = []
    for k in ks:
        m = KMeans(k=k, seed=seed).fit(data)
        rows.append((int(k), float(m.summary.trainingCost), float(ev.evaluate(m.transform(data)))))
    data.unpersist()
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def apply_override(df: DataFrame, cluster: str, key: str, overrides: dict) -> DataFrame:
    """Manual cluster ids win over automatic ones."""
    m = F.create_map(*[x for kv in overrides.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return df.withColumn(cluster, F.coalesce(m[F.col(key)], F.col(cluster)))


def bounds(df: DataFrame, keys: list, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Bounding box and centre."""
    return df.groupBy(*keys).agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                                 F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"),
                                 F.avg(lat).alias("lat_center"), F.avg(lon).alias("lon_center"))


def hull(points) -> list[tuple[float, float]]:
    """Vertices of the convex hull of ``(lon, lat)`` pairs, counter-clockwise from the smallest;
    points on an edge are left out. One or two points are their own hull."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def half(ordered):
        out: list = []
        for p in ordered:
            while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(pts[::-1])


# Corners that a partition holds for a cluster before it reduces them to their hull again.
_HULL_BUFFER = 4096


def convex_hulls(df: DataFrame, cluster: str = "cluster", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Hull vertices per cluster: ``cluster, kind, vertex, lon, lat``. The hull of hulls
    is the hull, so every partition reduces its points to one hull per cluster, and only
    the corners travel, first within groups of partitions, then to the cluster's last merge."""
    pts = df.select(F.col(cluster).alias("cluster"), F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat")) \
        .na.drop(subset=["cluster", "lon", "lat"])
    corner = f"cluster {dict(pts.dtypes)['cluster']}, lon double, lat double"

    def rows_of(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(c, *p) for c, ps in held.items() for p in hull(ps)], columns=["cluster", "lon", "lat"])

    def partial(batches):
        held: dict = {}
        for pdf in batches:
            for c, g in pdf.groupby("cluster", sort=False):
                own = held.setdefault(c, [])
                own += zip(g["lon"].tolist(), g["lat"].tolist())
                if len(own) > _HULL_BUFFER:
                    held[c] = hull(own)
        if held:
            yield rows_of(held)

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return rows_of({pdf["cluster"].iloc[0]: zip(pdf["lon"], pdf["lat"])})

    def finish(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = hull(zip(pdf["lon"], pdf["lat"]))
        kind = "polygon" if len(found) > 2 else "line" if len(found) == 2 else "point"
        return pd.DataFrame({"cluster": [pdf["cluster"].iloc[0]] * len(found), "kind": kind, "vertex": range(len(found)),
                             "lon": [p[0] for p in found], "lat": [p[1] for p in found]})

    some = pts.mapInPandas(partial, corner).groupBy("cluster", (F.spark_partition_id() % 64).alias("_part")).applyInPandas(merge, corner)
    schema = corner.replace(", lon double, lat double", ", kind string, vertex int, lon double, lat double")
    return some.groupBy("cluster").applyInPandas(finish, schema)
