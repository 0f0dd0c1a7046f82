"""Test-table adapter.

The driver's tables carry no stations, so the station-flow data model is laid
over them by fixed rules. Every view exists twice: as a DataFrame builder (used by
the library and ``queries()``) and as a DuckDB CTE body (used by ``oracle_sql()``).
Both are written from the same rules and must stay equal column for column.

Only the columns each view needs are read, so the Parquet scans stay pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import trunc

from ..util import bounded_broadcast
from .tables import read_table

N_STATIONS = 25
FEW_ORDERS = 200_000        # about 10 MB, Spark's own bound for a broadcast


def _st(expr):
    return F.concat(F.lit("ST-"), expr.cast("string"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event as a trip: origin by user, destination by event id."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        "event_id",
        _st(F.col("user_id") % N_STATIONS).alias("start_id"),
        _st((F.col("event_id") * 7 + 3) % N_STATIONS).alias("end_id"),
        F.when(F.col("event_type").isin("click", "view", "signup"), F.lit("dep"))
         .otherwise(F.lit("arr")).alias("basis"),
        (F.col("event_id") % 3 + 1).cast("double").alias("cnt"),
        F.col("value").alias("use_min"),
        (F.col("value") * 10).alias("use_dist"),
        F.col("ts"),
        F.to_date("ts").alias("base_date"),
        F.hour("ts").alias("hour"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: coordinates, dock counts, address, district."""
    k = F.col("n_nationkey")
    return read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]).select(
        _st(k).alias("station_id"),
        (F.lit(37.55) + F.lit(0.003) * k).alias("lat"),
        (F.lit(126.90) + F.lit(0.002) * ((k * 7) % N_STATIONS)).alias("lon"),
        (k % 5 + 3).alias("lcd"),
        (k % 7).alias("qr"),
        F.col("n_name").alias("addr"),
        F.concat(F.lit("D-"), k.cast("string")).alias("dong"),
        F.col("n_regionkey").alias("region"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather from error events; hours without one are the gaps."""
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    return (ev.filter(F.col("event_type") == "error")
            .groupBy(trunc("hour", "ts").alias("ts"))
            .agg(F.avg("value").alias("temp"), F.max("value").alias("humidity"),
                 F.min("value").alias("rain")))


def subway_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third station has a subway exit about 142 m away."""
    st = stations(spark, sf_dir)
    return (st.filter(F.substring("station_id", 4, 3).cast("int") % 3 == 0)
            .select(F.concat(F.lit("SUB-"), F.substring("station_id", 4, 3)).alias("name"),
                    (F.col("lat") + F.lit(0.001)).alias("lat"),
                    (F.col("lon") + F.lit(0.001)).alias("lon")))


def subway_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Riders per (day, subway name, direction) in four time bands."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    band = F.col("o_orderkey") % 4
    riders = F.col("o_totalprice") / 1000
    return (j.groupBy(F.to_date("o_orderdate").alias("day"),
                      F.concat(F.lit("SUB-"), F.col("c_nationkey").cast("string")).alias("name"),
                      F.when(F.col("o_orderstatus") == "F", F.lit("board"))
                       .otherwise(F.lit("alight")).alias("direction"))
            .agg(*[F.sum(F.when(band == i, riders).otherwise(F.lit(0.0))).alias(n)
                   for i, n in enumerate(["dawn", "am_peak", "daytime", "pm_peak"])]))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


def region_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population classes per (district, month). District k sits within 200 m of
    station k when k%3==0, 2.2 km away but in the same district when k%3==1, and
    under a district name no station has when k%3==2."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("c_nationkey")
    m = F.month("o_orderdate")
    agg = j.groupBy(k.alias("k"), m.alias("month")).agg(
        F.sum("o_totalprice").alias("pop_total"),
        *[F.sum(F.when(F.col("c_mktsegment") == s, F.col("o_totalprice")).otherwise(F.lit(0.0)))
           .alias(f"pop_c{i + 1}") for i, s in enumerate(SEGMENTS)])
    kk = F.col("k")
    return agg.select(
        F.when(kk % 3 == 2, F.concat(F.lit("E-"), kk.cast("string")))
         .otherwise(F.concat(F.lit("D-"), kk.cast("string"))).alias("dong"),
        "month",
        (F.lit(37.55) + F.lit(0.003) * kk +
         F.when(kk % 3 == 0, F.lit(0.0012)).otherwise(F.lit(0.02))).alias("lat"),
        (F.lit(126.90) + F.lit(0.002) * ((kk * 7) % N_STATIONS)).alias("lon"),
        F.when((F.col("month") == 2) & (kk % 5 == 0), F.lit(0.0))
         .otherwise(F.col("pop_total")).alias("pop_total"),
        "pop_c1", "pop_c2", "pop_c3", "pop_c4")


def od_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large case: one origin-destination row per line item and ship day.

    Line items meet the suppliers where they are read (a small dimension, broadcast after its
    rows are counted) and the orders meet the customers first, so that the line items are
    shuffled once, by order; few orders are broadcast, too."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber",
                                                "l_quantity", "l_extendedprice", "l_discount",
                                                "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    oc = o.join(c, F.col("o_custkey") == c.c_custkey)
    if o.limit(FEW_ORDERS + 1).count() <= FEW_ORDERS:
        oc = bounded_broadcast(oc, FEW_ORDERS)       # customers may repeat: the joined rows are counted, too
    j = li.join(bounded_broadcast(s), F.col("l_suppkey") == s.s_suppkey).join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        _st(F.col("s_nationkey")).alias("start_id"),
        _st(F.col("c_nationkey")).alias("end_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit("dep")).otherwise(F.lit("arr")).alias("basis"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").alias("cnt"),
        F.col("l_extendedprice").alias("use_dist"),
        (F.col("l_discount") * 100).alias("use_min"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of the embeddings: (vec_id, slot, value, cluster)."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return e.select("vec_id", F.col("label").alias("cluster"),
                    F.posexplode("embedding").alias("slot", "value")) \
            .select("vec_id", "slot", F.col("value").cast("double").alias("value"), "cluster")


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text per event (S7-type parsing input)."""
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "props"])


# ---------------------------------------------------------------------------
# DuckDB twins (CTE bodies). Keep in step with the builders above.
# ---------------------------------------------------------------------------

SQL = {
    "trips": """
      SELECT event_id,
             'ST-' || CAST(user_id % 25 AS VARCHAR) AS start_id,
             'ST-' || CAST((event_id * 7 + 3) % 25 AS VARCHAR) AS end_id,
             CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'dep' ELSE 'arr' END AS basis,
             CAST(event_id % 3 + 1 AS DOUBLE) AS cnt,
             value AS use_min, value * 10 AS use_dist, ts,
             CAST(ts AS DATE) AS base_date, CAST(hour(ts) AS INTEGER) AS hour
      FROM events""",
    "stations": """
      SELECT 'ST-' || CAST(n_nationkey AS VARCHAR) AS station_id,
             CAST(37.55 AS DOUBLE) + CAST(0.003 AS DOUBLE) * n_nationkey AS lat,
             CAST(126.90 AS DOUBLE) + CAST(0.002 AS DOUBLE) * ((n_nationkey * 7) % 25) AS lon,
             CAST(n_nationkey % 5 + 3 AS INTEGER) AS lcd, CAST(n_nationkey % 7 AS INTEGER) AS qr,
             n_name AS addr, 'D-' || CAST(n_nationkey AS VARCHAR) AS dong, n_regionkey AS region
      FROM nation""",
    "weather": """
      SELECT date_trunc('hour', ts) AS ts, avg(value) AS temp, max(value) AS humidity,
             min(value) AS rain
      FROM events WHERE event_type = 'error' GROUP BY 1""",
    "subway_points": """
      SELECT 'SUB-' || substr(station_id, 4, 3) AS name, lat + CAST(0.001 AS DOUBLE) AS lat,
             lon + CAST(0.001 AS DOUBLE) AS lon
      FROM stations WHERE CAST(substr(station_id, 4, 3) AS INTEGER) % 3 = 0""",
    "subway_daily": """
      SELECT CAST(o_orderdate AS DATE) AS day, 'SUB-' || CAST(c_nationkey AS VARCHAR) AS name,
             CASE WHEN o_orderstatus = 'F' THEN 'board' ELSE 'alight' END AS direction,
             sum(CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice / 1000 ELSE 0.0 END) AS dawn,
             sum(CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice / 1000 ELSE 0.0 END) AS am_peak,
             sum(CASE WHEN o_orderkey % 4 = 2 THEN o_totalprice / 1000 ELSE 0.0 END) AS daytime,
             sum(CASE WHEN o_orderkey % 4 = 3 THEN o_totalprice / 1000 ELSE 0.0 END) AS pm_peak
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "region_month": """
      SELECT CASE WHEN k % 3 = 2 THEN 'E-' ELSE 'D-' END || CAST(k AS VARCHAR) AS dong, month,
             CAST(37.55 AS DOUBLE) + CAST(0.003 AS DOUBLE) * k
               + CASE WHEN k % 3 = 0 THEN CAST(0.0012 AS DOUBLE) ELSE CAST(0.02 AS DOUBLE) END AS lat,
             CAST(126.90 AS DOUBLE) + CAST(0.002 AS DOUBLE) * ((k * 7) % 25) AS lon,
             CASE WHEN month = 2 AND k % 5 = 0 THEN 0.0 ELSE pop_total END AS pop_total,
             pop_c1, pop_c2, pop_c3, pop_c4
      FROM (SELECT c_nationkey AS k, CAST(month(o_orderdate) AS INTEGER) AS month,
                   sum(o_totalprice) AS pop_total,
                   sum(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN o_totalprice ELSE 0.0 END) AS pop_c1,
                   sum(CASE WHEN c_mktsegment = 'BUILDING' THEN o_totalprice ELSE 0.0 END) AS pop_c2,
                   sum(CASE WHEN c_mktsegment = 'FURNITURE' THEN o_totalprice ELSE 0.0 END) AS pop_c3,
                   sum(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN o_totalprice ELSE 0.0 END) AS pop_c4
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) g""",
    "od_daily": """
      SELECT l_orderkey AS order_id, l_linenumber AS line,
             'ST-' || CAST(s_nationkey AS VARCHAR) AS start_id,
             'ST-' || CAST(c_nationkey AS VARCHAR) AS end_id,
             CASE WHEN l_linenumber % 2 = 1 THEN 'dep' ELSE 'arr' END AS basis,
             CAST(l_shipdate AS DATE) AS day, l_quantity AS cnt, l_extendedprice AS use_dist,
             l_discount * 100 AS use_min
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "vectors": """
      SELECT vec_id, CAST(s.i - 1 AS INTEGER) AS slot, CAST(embedding[s.i] AS DOUBLE) AS value,
             label AS cluster
      FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i) s""",
}

# Dependencies between the CTEs above (a view must come after what it reads).
_DEPS = {"subway_points": ["stations"]}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named adapter views (and their inputs)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
