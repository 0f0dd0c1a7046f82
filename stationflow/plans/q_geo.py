"""Spatial and context queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import haversine_km, haversine_m, hav_m_sql
from ..operators import context as cx
from ..operators import spatial as sp
from ..sources import adapter as ad
from ..sources.tables import read_table
from .catalog import register

V = ad.with_views
HAV = hav_m_sql("s.lat", "s.lon", "p.lat", "p.lon")
# The point the G9/G10 distance query measures from.
REF_LAT, REF_LON = 37.5665, 126.9780


@register("g09_haversine", "G9 G10", V("stations") + f"""
SELECT station_id,
       round({hav_m_sql('lat', 'lon', REF_LAT, REF_LON)}, 4) AS dist_m,
       round(6371.0 * 2 * atan2(sqrt(pow(sin((radians({REF_LAT}) - radians(lat)) / 2), 2)
             + cos(radians(lat)) * cos(radians({REF_LAT})) * pow(sin((radians({REF_LON}) - radians(lon)) / 2), 2)),
             sqrt(1 - (pow(sin((radians({REF_LAT}) - radians(lat)) / 2), 2)
             + cos(radians(lat)) * cos(radians({REF_LAT})) * pow(sin((radians({REF_LON}) - radians(lon)) / 2), 2)))), 6)
         AS dist_km
FROM stations""", check="T")
def g09(spark, sf_dir):
    s = ad.stations(spark, sf_dir)
    return s.select("station_id",
                    F.round(haversine_m("lat", "lon", F.lit(REF_LAT), F.lit(REF_LON)), 4).alias("dist_m"),
                    F.round(haversine_km("lat", "lon", F.lit(REF_LAT), F.lit(REF_LON)), 6).alias("dist_km"))


@register("j09_within_200m", "J9", V("stations", "subway_points") + f"""
SELECT s.station_id, p.name, round({HAV}, 3) AS dist_m
FROM stations s, subway_points p WHERE {HAV} <= 200""", check="T")
def j09(spark, sf_dir):
    j = sp.within_radius(ad.stations(spark, sf_dir).select("station_id", "lat", "lon"),
                         ad.subway_points(spark, sf_dir), 200.0, "station_id", "name")
    return j.select("station_id", "name", F.round("dist_m", 3).alias("dist_m"))


@register("j10_nearest_subway", "J10", V("stations", "subway_points") + f"""
SELECT s.station_id, arg_min(p.name, ({HAV}, p.name)) AS name, round(min({HAV}), 3) AS dist_m
FROM stations s, subway_points p GROUP BY 1""", check="T")
def j10(spark, sf_dir):
    nn = sp.nearest(ad.stations(spark, sf_dir).select("station_id", "lat", "lon"),
                    ad.subway_points(spark, sf_dir), "station_id", "name")
    return nn.select("station_id", "name", F.round("dist_m", 3).alias("dist_m"))


@register("g11_nearest_subway_km", "G11", V("stations", "subway_points") + f""",
s2 AS (SELECT station_id, CASE WHEN region = 2 THEN NULL ELSE lat END AS lat, lon FROM stations),
nn AS (SELECT s.station_id, min({HAV}) / 1000 AS near_km FROM s2 s, subway_points p
       WHERE s.lat IS NOT NULL GROUP BY 1)
SELECT s2.station_id, round(coalesce(nn.near_km, 1.0), 6) AS near_km FROM s2 LEFT JOIN nn USING (station_id)""",
          check="T")
def g11(spark, sf_dir):
    s = ad.stations(spark, sf_dir).select(
        "station_id", F.when(F.col("region") == 2, F.lit(None)).otherwise(F.col("lat")).alias("lat"), "lon")
    out = cx.nearest_distance_km(s, ad.subway_points(spark, sf_dir))
    return out.select("station_id", F.round("near_km", 6).alias("near_km"))


IDX_SQL = """idx AS (SELECT dong, month, pop_total AS population,
                CASE WHEN pop_total = 0 THEN NULL ELSE (pop_c1 + pop_c2) / (2 * pop_total) END AS residential,
                CASE WHEN pop_total = 0 THEN NULL ELSE pop_c3 / pop_total END AS business,
                CASE WHEN pop_total = 0 THEN NULL ELSE pop_c4 / pop_total END AS tourism
         FROM region_month)"""


@register("a31_region_indices", "A31", V("region_month") + ", " + IDX_SQL + """
SELECT dong, month, round(population, 2) AS population, round(residential, 6) AS residential,
       round(business, 6) AS business, round(tourism, 6) AS tourism FROM idx""", check="T")
def a31(spark, sf_dir):
    out = cx.region_indices(ad.region_month(spark, sf_dir))
    return out.select("dong", "month", F.round("population", 2).alias("population"),
                      *[F.round(c, 6).alias(c) for c in ("residential", "business", "tourism")])


G12_CTES = IDX_SQL + f""",
pts AS (SELECT DISTINCT month, dong, lat, lon FROM region_month),
sm AS (SELECT s.*, m.month FROM stations s, (SELECT DISTINCT month FROM region_month) m),
t1 AS (SELECT DISTINCT s.station_id, s.month, p.dong, 1 AS tier FROM sm s JOIN pts p ON p.month = s.month
       WHERE {HAV} <= 200),
r1 AS (SELECT * FROM sm WHERE (station_id, month) NOT IN (SELECT (station_id, month) FROM t1)),
t2 AS (SELECT DISTINCT r1.station_id, r1.month, pts.dong, 2 AS tier
       FROM r1 JOIN pts ON r1.dong = pts.dong AND r1.month = pts.month),
r2 AS (SELECT * FROM r1 WHERE (station_id, month) NOT IN (SELECT (station_id, month) FROM t2)),
t3 AS (SELECT s.station_id, s.month, arg_min(p.dong, ({HAV}, p.dong)) AS dong, 3 AS tier
       FROM r2 s JOIN pts p ON p.month = s.month GROUP BY 1, 2),
m AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3),
regf AS (SELECT m.station_id, m.month, min(tier) AS tier, avg(residential) AS residential,
                avg(business) AS business, avg(tourism) AS tourism
         FROM m JOIN idx ON m.dong = idx.dong AND m.month = idx.month GROUP BY 1, 2)"""


@register("g12_region_features", "G12 J11 A31", V("stations", "region_month") + ", " + G12_CTES + """
SELECT station_id, month, tier, round(residential, 6) AS residential, round(business, 6) AS business,
       round(tourism, 6) AS tourism FROM regf""", check="T")
def g12(spark, sf_dir):
    out = cx.build_region_features(ad.stations(spark, sf_dir), ad.region_month(spark, sf_dir))
    return out.select("station_id", "month", "tier",
                      *[F.round(c, 6).alias(c) for c in ("residential", "business", "tourism")])


G13_CTES = f"""
near AS (SELECT DISTINCT s.station_id, p.name FROM stations s, subway_points p WHERE {HAV} <= 200),
shares AS (SELECT day, name, direction, dawn + am_peak + daytime + pm_peak AS tot, am_peak, pm_peak FROM subway_daily),
names AS (SELECT day, name, sum(tot) AS riders,
                 avg(CASE WHEN tot = 0 THEN 0.0 ELSE am_peak / tot END) FILTER (WHERE direction = 'alight') AS ci,
                 avg(CASE WHEN tot = 0 THEN 0.0 ELSE pm_peak / tot END) FILTER (WHERE direction = 'board') AS co
          FROM shares GROUP BY 1, 2),
top AS (SELECT max(riders) AS m FROM names),
pd AS (SELECT near.station_id, names.day, sum(riders / m) AS ti, avg(ci) AS ci, avg(co) AS co
       FROM near JOIN names ON near.name = names.name, top GROUP BY 1, 2),
sdays AS (SELECT DISTINCT day FROM subway_daily),
subd AS (SELECT s.station_id, d.day, coalesce(pd.ti, 0.0) AS transit_index, coalesce(pd.ci, 0.0) AS commute_in_index,
                coalesce(pd.co, 0.0) AS commute_out_index
         FROM stations s CROSS JOIN sdays d LEFT JOIN pd ON pd.station_id = s.station_id AND pd.day = d.day),
subf AS (SELECT station_id, avg(transit_index) AS transit_index, avg(commute_in_index) AS commute_in_index,
                avg(commute_out_index) AS commute_out_index FROM subd GROUP BY 1)"""


@register("g13_subway_features", "G13 A32 J9", V("stations", "subway_points", "subway_daily") + "," + G13_CTES + """
SELECT station_id, day, round(transit_index, 6) AS transit_index, round(commute_in_index, 6) AS commute_in_index,
       round(commute_out_index, 6) AS commute_out_index FROM subd""", check="T")
def g13(spark, sf_dir):
    out = cx.subway_daily_features(ad.stations(spark, sf_dir), ad.subway_points(spark, sf_dir),
                                   ad.subway_daily(spark, sf_dir))
    return out.select("station_id", "day", *[F.round(c, 6).alias(c) for c in cx.SUBWAY])


# Pseudo hour of each subway time band, and the peak hour sets.
BAND_HOUR = {"dawn": 5, "am_peak": 8, "daytime": 13, "pm_peak": 18}
PEAKS = {"am_mean": [7, 8, 9], "pm_mean": [17, 18, 19]}


@register("a33_subway_peak_means", "A33 A41", V("subway_daily") + """,
long AS (SELECT name, hour, value FROM (
  SELECT name, 5 AS hour, dawn AS value FROM subway_daily UNION ALL SELECT name, 8, am_peak FROM subway_daily
  UNION ALL SELECT name, 13, daytime FROM subway_daily UNION ALL SELECT name, 18, pm_peak FROM subway_daily) u)
SELECT name, round(avg(value) FILTER (WHERE hour IN (7, 8, 9)), 6) AS am_mean,
       round(avg(value) FILTER (WHERE hour IN (17, 18, 19)), 6) AS pm_mean
FROM long GROUP BY 1""", check="T")
def a33(spark, sf_dir):
    d = ad.subway_daily(spark, sf_dir)
    long = d.unpivot(["name"], list(BAND_HOUR), "band", "value")
    hour = F.create_map(*[x for kv in BAND_HOUR.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    long = long.withColumn("hour", hour[F.col("band")])
    out = cx.peak_means(long, ["name"], "hour", "value", PEAKS)
    return out.select("name", *[F.round(c, 6).alias(c) for c in PEAKS])


@register("g14_poi_features", "G14", V("stations", "region_month") + f""",
p AS (SELECT dong AS poi_id, lat, lon, avg(pop_c1 / pop_total) AS pop_c1, avg(pop_c2 / pop_total) AS pop_c2
      FROM region_month WHERE pop_total > 0 GROUP BY 1, 2, 3),
near AS (SELECT s.station_id, p.pop_c1, p.pop_c2 FROM stations s, p WHERE {HAV} <= 200),
agg AS (SELECT station_id, avg(pop_c1) AS pop_c1, avg(pop_c2) AS pop_c2 FROM near GROUP BY 1)
SELECT s.station_id, round(agg.pop_c1, 6) AS pop_c1, round(agg.pop_c2, 6) AS pop_c2
FROM stations s LEFT JOIN agg ON s.station_id = agg.station_id""", check="T")
def g14(spark, sf_dir):
    rm = ad.region_month(spark, sf_dir)
    pois = rm.filter("pop_total > 0").groupBy(F.col("dong").alias("poi_id"), "lat", "lon").agg(
        F.avg(F.col("pop_c1") / F.col("pop_total")).alias("pop_c1"),
        F.avg(F.col("pop_c2") / F.col("pop_total")).alias("pop_c2"))
    out = cx.poi_features(ad.stations(spark, sf_dir), pois, ["pop_c1", "pop_c2"])
    return out.select("station_id", F.round("pop_c1", 6).alias("pop_c1"), F.round("pop_c2", 6).alias("pop_c2"))


@register("j12_substring_match", "J12", V("stations") + """,
reg AS (SELECT n_nationkey AS reg_order, r_name || ' ' || n_name || ' BLOCK' AS reg_addr
        FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT station_id, addr, arg_min(reg_addr, reg_order) AS reg_addr, min(reg_order) AS reg_order
FROM stations JOIN reg ON contains(reg_addr, addr) GROUP BY 1, 2""")
def j12(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    reg = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("reg_order"),
        F.concat_ws(" ", "r_name", "n_name", F.lit("BLOCK")).alias("reg_addr"))
    st = ad.stations(spark, sf_dir).select("station_id", "addr")
    return sp.substring_match(st, reg, "addr", "reg_addr", "reg_order")


@register("g15_kmeans_stations", "G15", check="R")
def g15(spark, sf_dir):
    return sp.kmeans_clusters(ad.stations(spark, sf_dir).select("station_id", "lat", "lon"), 10)


@register("g16_k_search", "G16", check="R")
def g16(spark, sf_dir):
    return sp.k_search(ad.stations(spark, sf_dir).select("station_id", "lat", "lon"), range(4, 13))


# Manual cluster overrides of the G17 query.
OVERRIDES = {"ST-3": 11, "ST-7": 12, "ST-9": 3}


@register("g17_cluster_override", "G17 P32", V("stations") + """
SELECT station_id, CASE station_id WHEN 'ST-3' THEN 11 WHEN 'ST-7' THEN 12 WHEN 'ST-9' THEN 3
                                   ELSE region + 1 END AS cluster
FROM stations""")
def g17(spark, sf_dir):
    s = ad.stations(spark, sf_dir).select("station_id", (F.col("region") + 1).alias("cluster"))
    return sp.apply_override(s, "cluster", "station_id", OVERRIDES)


@register("g18_bounds_centre", "G18 A20", V("stations") + """
SELECT region, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
       round(avg(lat), 6) AS lat_center, round(avg(lon), 6) AS lon_center
FROM stations GROUP BY 1""", check="T")
def g18(spark, sf_dir):
    b = sp.bounds(ad.stations(spark, sf_dir), ["region"])
    return b.withColumns({"lat_center": F.round("lat_center", 6), "lon_center": F.round("lon_center", 6)})


_CROSS = "(q.lon - p.lon) * (r.lat - p.lat) {} (q.lat - p.lat) * (r.lon - p.lon)"
_ALONG = "(r.lon - p.lon) * (q.lon - p.lon) + (r.lat - p.lat) * (q.lat - p.lat)"


@register("g19_convex_hull", "G19 D8", "WITH RECURSIVE " + V("stations")[5:] + f""",
pts AS (SELECT DISTINCT region AS cluster, lon, lat FROM stations),
edge AS (SELECT p.cluster, p.lon, p.lat, q.lon AS to_lon, q.lat AS to_lat
         FROM pts p JOIN pts q ON p.cluster = q.cluster AND (p.lon <> q.lon OR p.lat <> q.lat)
         WHERE NOT EXISTS (SELECT 1 FROM pts r WHERE r.cluster = p.cluster AND ({_CROSS.format("<")}
               OR {_CROSS.format("=")} AND ({_ALONG} < 0 OR {_ALONG} > pow(q.lon - p.lon, 2) + pow(q.lat - p.lat, 2))))),
first_p AS (SELECT cluster, min((lon, lat)) AS p FROM pts GROUP BY 1),
walk AS (SELECT cluster, 0 AS vertex, p[1] AS lon, p[2] AS lat, p FROM first_p
         UNION ALL
         SELECT w.cluster, w.vertex + 1, e.to_lon, e.to_lat, w.p FROM walk w
         JOIN edge e ON e.cluster = w.cluster AND e.lon = w.lon AND e.lat = w.lat WHERE (e.to_lon, e.to_lat) <> w.p AND w.vertex < 1000)
SELECT cluster, CASE count(*) OVER (PARTITION BY cluster) WHEN 1 THEN 'point' WHEN 2 THEN 'line' ELSE 'polygon' END AS kind,
       CAST(vertex AS INTEGER) AS vertex, lon, lat FROM walk""")
def g19(spark, sf_dir):
    s = ad.stations(spark, sf_dir).withColumnRenamed("region", "cluster")
    return sp.convex_hulls(s)
