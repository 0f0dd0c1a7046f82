"""Source and sink queries. Each writes data derived from the driver
tables in the format under test (into a fresh folder below the session's
checkpoint directory), reads it back with the reader under test, and returns the
result; the oracle computes the same rows from the original tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import adapter as ad
from ..sources import readers as rd
from ..sources.tables import table_path
from .catalog import register

V = ad.with_views

TRIP_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("event_id", T.LongType()), ("start_id", T.StringType()), ("end_id", T.StringType()),
    ("basis", T.StringType()), ("cnt", T.DoubleType()), ("use_min", T.DoubleType()),
    ("ts", T.TimestampNTZType()))])


def _trips_small(spark, sf_dir):
    return ad.trips(spark, sf_dir).select(*TRIP_SCHEMA.fieldNames())


@register("s01_read_parquet_pruned", "S1", """
SELECT event_id, ts, value FROM events WHERE event_type = 'error'""")
def s01(spark, sf_dir):
    df = rd.read_parquet(spark, table_path(sf_dir, "events"), ["event_id", "ts", "value", "event_type"])
    return df.filter(F.col("event_type") == "error").select("event_id", "ts", "value")


@register("s02_csv_header_index", "S2 S14 S10", V("trips") + """
SELECT event_id, start_id, end_id, basis, cnt, use_min, ts FROM trips""")
def s02(spark, sf_dir):
    path = rd.scratch_path(spark, "s02")
    t = _trips_small(spark, sf_dir)
    # written like pandas to_csv with its index: a first column without a name
    rd.csv_writer(t.select(F.monotonically_increasing_id().alias("_c0"), *t.columns)).csv(path)
    schema = T.StructType([T.StructField("_c0", T.LongType())] + TRIP_SCHEMA.fields)
    return rd.drop_unnamed_index(rd.read_csv(spark, path, schema))


@register("s03_cp949_csv", "S3", V("stations") + """
SELECT station_id, '서울특별시 ' || addr || ' 대여소' AS addr_ko FROM stations""")
def s03(spark, sf_dir):
    path = rd.scratch_path(spark, "s03")
    s = ad.stations(spark, sf_dir).select(
        "station_id", F.concat(F.lit("서울특별시 "), F.col("addr"), F.lit(" 대여소")).alias("addr_ko"))
    s.write.option("header", True).option("encoding", "cp949").csv(path)
    return rd.read_csv(spark, path, "station_id string, addr_ko string", encoding="cp949")


@register("s04_glob_scan_lineage", "S4 U1", V("od_daily") + """
SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS n, sum(cnt) AS cnt FROM od_daily GROUP BY 1""")
def s04(spark, sf_dir):
    base = rd.scratch_path(spark, "s04")
    od = ad.od_daily(spark, sf_dir).select("order_id", "line", "day", "cnt")
    # one folder per year, like one file per year and station
    od.withColumn("year", F.year("day")).write.partitionBy("year").option("header", True).csv(base)
    df = rd.read_csv(spark, f"{base}/year=*/*.csv", "order_id long, line int, day date, cnt double",
                     lineage=True)
    yr = F.regexp_extract("source_file", r"year=(\d+)", 1).cast("int")
    return df.groupBy(yr.alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


@register("s05_csv_to_parquet_narrow", "S5 S6", V("trips") + """
SELECT event_id, start_id, end_id, basis, CAST(coalesce(cnt, 0) AS TINYINT) AS cnt, use_min, ts,
       CAST(coalesce(hour(ts), 0) AS TINYINT) AS hour FROM trips""")
def s05(spark, sf_dir):
    src, dst = rd.scratch_path(spark, "s05csv"), rd.scratch_path(spark, "s05pq")
    t = _trips_small(spark, sf_dir).withColumn("hour", F.hour("ts"))
    rd.csv_writer(t).csv(src)
    schema = T.StructType(TRIP_SCHEMA.fields + [T.StructField("hour", T.IntegerType())])
    return rd.csv_to_parquet(spark, src, dst, schema, {"cnt": "tinyint", "hour": "tinyint"}, "zstd")


@register("s07_weather_json_payload", "S7", V("weather") + """
SELECT ts, temp, humidity, rain, CAST(NULL AS DOUBLE) AS snow FROM weather""")
def s07(spark, sf_dir):
    path = rd.scratch_path(spark, "s07")
    w = ad.weather(spark, sf_dir).withColumn("snow", F.lit(None).cast("double"))
    rd.weather_to_json(w, path)
    return rd.read_weather_json(spark, path)


@register("s08_cache_or_build", "S8", V("weather") + " SELECT ts, temp FROM weather")
def s08(spark, sf_dir):
    path = rd.scratch_path(spark, "s08")
    build = lambda: ad.weather(spark, sf_dir).select("ts", "temp")
    rd.cache_or_build(spark, path, build)          # first call builds and writes
    return rd.cache_or_build(spark, path, build)   # second call reads the landed copy


@register("s09_partitioned_store_keys", "S9 S11 S12", V("od_daily") + """
SELECT DISTINCT start_id AS station_id, CAST(month(day) % 3 AS INTEGER) AS k FROM od_daily""")
def s09(spark, sf_dir):
    path = rd.scratch_path(spark, "s09")
    od = ad.od_daily(spark, sf_dir).select(F.col("start_id").alias("station_id"),
                                           (F.month("day") % 3).alias("k"), "day", "cnt")
    rd.write_partitioned(od, path, ["station_id", "k"], fmt="parquet")
    return rd.list_keys(spark, path, ["station_id", "k"])


@register("s09_station_csv", "S9 S2 S4", V("od_daily") + """
SELECT start_id AS station_id, count(*) AS n, CAST(sum(cnt) AS DOUBLE) AS cnt, min(day) AS first_day, max(day) AS last_day
FROM od_daily GROUP BY 1""")
def s09_csv(spark, sf_dir):
    """One marked CSV per station, read back with the station taken from the file's folder."""
    path = rd.scratch_path(spark, "s09csv")
    od = ad.od_daily(spark, sf_dir).select("order_id", F.col("start_id").alias("station_id"), "day", "cnt")
    rd.write_station_csv(od, path)
    df = rd.read_csv(spark, f"{path}/station_id=*/*.csv", "order_id long, day date, cnt double", lineage=True)
    return df.groupBy(F.regexp_extract("source_file", r"station_id=([^/]+)", 1).alias("station_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@register("s11_keyed_store", "S11 S10 S12", V("od_daily") + """
SELECT start_id AS station_id, CAST(month(day) % 3 AS INTEGER) AS k, count(*) AS n,
       CAST(sum(CASE WHEN start_id IN ('ST-1', 'ST-4') THEN 2 * cnt ELSE cnt END) AS DOUBLE) AS cnt
FROM od_daily WHERE start_id IN ('ST-1', 'ST-2') GROUP BY 1, 2""")
def s11(spark, sf_dir):
    """A store of all stations, two of them written again, two read back by key."""
    path = rd.scratch_path(spark, "s11")
    od = ad.od_daily(spark, sf_dir).select(F.col("start_id").alias("station_id"), (F.month("day") % 3).alias("k"), "cnt")
    rd.write_keyed(od, path, ["station_id", "k"])
    rd.write_keyed(od.filter(F.col("station_id").isin("ST-1", "ST-4")).withColumn("cnt", F.col("cnt") * 2), path, ["station_id", "k"])
    one, two = (rd.read_keyed(spark, path, station_id=s) for s in ("ST-1", "ST-2"))
    return one.unionByName(two).groupBy("station_id", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").cast("double").alias("cnt"))


@register("s13_xml_error_log", "S13", """
SELECT CAST(ts AS VARCHAR) AS measured_at, CAST(500 + event_id % 3 AS INTEGER) AS status_code,
       'E' || CAST(event_id % 7 AS VARCHAR) AS xml_code, 'failure ' || props AS xml_message
FROM events WHERE event_type = 'error'""")
def s13(spark, sf_dir):
    path = rd.scratch_path(spark, "s13")
    ev = rd.read_parquet(spark, table_path(sf_dir, "events"), ["event_id", "ts", "event_type", "props"]) \
        .filter(F.col("event_type") == "error")
    code = F.concat(F.lit("E"), (F.col("event_id") % 7).cast("string"))
    msg = F.concat(F.lit("failure "), F.col("props"))
    xml = F.concat(F.lit("<RESULT>\n  <CODE>"), code, F.lit("</CODE>\n  <MESSAGE>"), msg,
                   F.lit("</MESSAGE>\n</RESULT>"))
    log = ev.select(F.col("ts").cast("string").alias("measured_at"),
                    (F.col("event_id") % 3 + 500).cast("int").alias("status_code"),
                    code.alias("code"), msg.alias("message"), xml.alias("error_text"))
    log.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    out = rd.read_error_log(spark, path)
    return out.select("measured_at", "status_code", "xml_code", "xml_message")
