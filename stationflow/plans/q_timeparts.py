"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..functions import weather as wx
from ..sources import adapter as ad
from .catalog import register
from .q_flow import PANEL, hourly_flow_panel

V = ad.with_views


def r6(c):
    return F.round(c, 6)


# P1 / P39 / P8 ---------------------------------------------------------------------
@register("p01_ts_from_parts", "P1 P39 P11", V("trips") + """
SELECT event_id, base_date + to_hours(hour) AS ts_hour,
       make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) AS ts_parts,
       date_trunc('day', ts) AS ts_day, time_bucket(INTERVAL 3 HOUR, ts) AS ts_3h
FROM trips""")
def p01(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    return t.select("event_id", tp.ts_from_date_hour("base_date", "hour").alias("ts_hour"),
                    tp.ts_from_parts(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"))
                    .alias("ts_parts"),
                    tp.floor_day("ts").alias("ts_day"), tp.floor_hours("ts", 3).alias("ts_3h"))


# P2 / P3 --------------------------------------------------------------------------
RAW_SQL = """raw AS (
  SELECT event_id,
         CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS BIGINT) AS date_num,
         CASE WHEN event_id % 17 = 0 THEN 2599.0
              ELSE CAST(hour(ts) * 100 + minute(ts) AS DOUBLE) END AS hhmm
  FROM trips)"""


def _raw(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    return t.select("event_id",
                    (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("bigint")
                    .alias("date_num"),
                    F.when(F.col("event_id") % 17 == 0, F.lit(2599.0))
                    .otherwise((F.hour("ts") * 100 + F.minute("ts")).cast("double")).alias("hhmm"))


@register("p02_parse_date_hhmm", "P2 P3", V("trips") + "," + RAW_SQL + """
SELECT event_id,
       try_strptime(lpad(regexp_replace(CAST(date_num AS VARCHAR), '\\.0+$', ''), 8, '0')
                    || lpad(regexp_replace(CAST(hhmm AS VARCHAR), '\\.0+$', ''), 4, '0'), '%Y%m%d%H%M') AS ts,
       CAST(try_strptime(lpad(CAST(date_num AS VARCHAR), 8, '0'), '%Y%m%d') AS DATE) AS base_date,
       CAST(floor(hhmm / 100) AS INTEGER) AS hh, CAST(CAST(floor(hhmm) AS BIGINT) % 100 AS INTEGER) AS mm
FROM raw""")
def p02(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select("event_id", tp.parse_date_hhmm("date_num", "hhmm").alias("ts"),
                    tp.parse_yyyymmdd("date_num").alias("base_date"),
                    tp.hhmm_hour("hhmm").alias("hh"), tp.hhmm_minute("hhmm").alias("mm"))


# P4 / P7 --------------------------------------------------------------------------
@register("p04_departure_normalize", "P4 P7", V("trips") + """
SELECT event_id, dep_ts, 'dep' AS basis,
       round(date_diff('microsecond', dep_ts, ts) / 60000000.0, 6) AS shift_min
FROM (SELECT *, CASE WHEN basis = 'arr'
                     THEN ts - to_microseconds(CAST(round(use_min * 60000000.0) AS BIGINT)) ELSE ts END AS dep_ts
      FROM trips) t""", check="T")
def p04(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    x = t.withColumn("dep_ts", tp.departure_ts("ts", "basis", "use_min"))
    return x.select("event_id", "dep_ts", F.lit("dep").alias("basis"),
                    r6(F.timestamp_diff("MICROSECOND", F.col("dep_ts"), F.col("ts")) / 6e7)
                    .alias("shift_min"))


# P5 -------------------------------------------------------------------------------
@register("p05_align_end_time", "P5", V("trips") + """
SELECT event_id, CAST(base_date + to_days(CAST(floor(floor(hour - use_min / 60) / 24) AS INTEGER)) AS DATE) AS end_date,
       CAST(floor(hour - use_min / 60) - floor(floor(hour - use_min / 60) / 24) * 24 AS INTEGER) AS end_hour
FROM trips""")
def p05(spark, sf_dir):
    # every trip aligned to its own end station (the reference runs one station at a time)
    t = ad.trips(spark, sf_dir)
    return t.select("event_id",
                    F.date_add("base_date", tp.end_day_shift("hour", "use_min")).alias("end_date"),
                    tp.end_hour("hour", "use_min").alias("end_hour"))


# P6 -------------------------------------------------------------------------------
@register("p06_arrival_hour", "P6", V("trips") + """
SELECT event_id, date_trunc('hour', ts + to_microseconds(CAST(round(use_min * 60000000.0) AS BIGINT))) AS arr_hour
FROM trips""")
def p06(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    return t.select("event_id", tp.arrival_hour("ts", "use_min").alias("arr_hour"))


# P8 / P9 / P10 / P20 -----------------------------------------------------------------
@register("p08_date_parts", "P8 P9 P10 P20", V("trips") + """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
       CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(week(ts) AS INTEGER) AS week,
       CAST(isoyear(ts) AS VARCHAR) || '-' || lpad(CAST(week(ts) AS VARCHAR), 2, '0') AS iso_week,
       CAST(floor((day(ts) - 1) / 7) + 1 AS INTEGER) AS week_of_month,
       strftime(ts, '%Y-%m') AS ym, CAST(floor(((month(ts) % 12) + 3) / 3) AS INTEGER) AS season,
       ['월', '화', '수', '목', '금', '토', '일'][isodow(ts)] AS weekday_ko,
       CAST(base_date - to_days(CAST((isodow(base_date) - 1 - 1 + 7) % 7 AS INTEGER)) AS DATE) AS week_start
FROM trips""")
def p08(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    parts = tp.date_parts("ts")
    return t.select("event_id", *[v.alias(k) for k, v in parts.items()],
                    tp.iso_year_week("ts").alias("iso_week"), tp.week_of_month("ts").alias("week_of_month"),
                    tp.year_month_label("ts").alias("ym"), tp.season(F.month("ts")).alias("season"),
                    tp.weekday_name_ko("ts").alias("weekday_ko"),
                    tp.week_start_w_mon("base_date").alias("week_start"))


# P12 / P13 / P14 / P19 ---------------------------------------------------------------
@register("p12_cyclic_onehot", "P12 P13 P14 P19 D6", V("trips") + """
SELECT event_id, round(sin(2 * pi() * hour / 24.0), 6) AS hour_sin,
       round(cos(2 * pi() * hour / 24.0), 6) + 0.0 AS hour_cos,  -- + 0.0: -0.0 as 0.0, as Spark's round gives
       round(sin(2 * pi() * (month(ts) - 1) / 12.0), 6) AS month_sin0,
       round(cos(2 * pi() * dayofyear(ts) / 366.0), 6) AS doy_cos,
       """ + ", ".join(f"CAST(isodow(ts) - 1 = {i} AS INTEGER) AS dow_{i}" for i in range(7)) + """,
       CASE WHEN hour BETWEEN 7 AND 9 THEN 1 WHEN hour BETWEEN 18 AND 20 THEN 2
            WHEN hour BETWEEN 0 AND 5 THEN 3 ELSE 0 END AS time_group
FROM trips""", check="T")
def p12(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    hs, hc = tp.cyclic("hour", 24)
    ms, _ = tp.cyclic(F.month("ts"), 12, 1)
    _, dc = tp.cyclic(F.dayofyear("ts"), 366)
    return t.select("event_id", r6(hs).alias("hour_sin"), r6(hc).alias("hour_cos"),
                    r6(ms).alias("month_sin0"), r6(dc).alias("doy_cos"),
                    *[v.alias(k) for k, v in tp.weekday_one_hot("ts").items()],
                    tp.time_group("hour").alias("time_group"))


# P16 / P17 / P18 ----------------------------------------------------------------------
# Holiday dates are input data (2.X.17); this list is the query's parameter.
HOLIDAYS = ["2024-01-01"]


@register("p16_calendar_flags", "P16 P17 P18 J1", V("trips") + """,
hol AS (SELECT DATE '2024-01-01' AS d)
SELECT event_id, CAST(isodow(base_date) >= 6 OR hol.d IS NOT NULL AS INTEGER) AS resting_day,
       CAST(hour IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS rush,
       CAST(hour IN (7, 8, 9, 17, 18, 19) AND isodow(base_date) < 6 AS INTEGER) AS weekday_rush,
       CAST(hour >= 12 AS INTEGER) AS noon, CAST(hour >= 22 OR hour <= 5 AS INTEGER) AS night,
       CAST(hour BETWEEN 6 AND 21 AS INTEGER) AS daytime
FROM trips LEFT JOIN hol ON trips.base_date = hol.d""")
def p16(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    hol = spark.createDataFrame([(h,) for h in HOLIDAYS], "d string").select(F.to_date("d").alias("hd"))
    x = t.join(F.broadcast(hol), t.base_date == hol.hd, "left")  # parameter list, size known
    rest = ((F.weekday("base_date") >= 5) | F.col("hd").isNotNull()).cast("int")
    rush = tp.hour_in("hour", [7, 8, 9, 17, 18, 19])
    return x.select("event_id", rest.alias("resting_day"), rush.alias("rush"),
                    (rush * (F.weekday("base_date") < 5).cast("int")).alias("weekday_rush"),
                    (F.col("hour") >= 12).cast("int").alias("noon"),
                    ((F.col("hour") >= 22) | (F.col("hour") <= 5)).cast("int").alias("night"),
                    tp.hour_between("hour", 6, 21).alias("daytime"))


# P21 / P22 / P23 / P25 ----------------------------------------------------------------
@register("p21_weather_features", "P21 P22 P23 P25", V("weather") + """
SELECT ts, CAST(coalesce(rain, 0) > 1 AS INTEGER) AS rain_flag,
       CAST(coalesce(humidity - 400, 0) > 0 AS INTEGER) AS snow_flag,
       CAST(coalesce(humidity - 400, 0) > 0 OR coalesce(rain, 0) > 0 AS INTEGER) AS wet_flag,
       round(0.81 * temp + 0.01 * humidity * (0.99 * temp - 14.3) + 46.3, 6) AS discomfort,
       round(ln(1 + coalesce(rain, 0)), 6) AS rain_log1p,
       round(sign(temp - 50) * ln(1 + abs(temp - 50)), 6) AS temp_slog,
       round(exp(ln(1 + rain)) - 1, 6) AS rain_back, greatest(temp - 50, 0) AS temp_clip0
FROM weather""", check="T")
def p21(spark, sf_dir):
    w = ad.weather(spark, sf_dir)
    snow = F.col("humidity") - 400
    return w.select("ts", wx.rain_flag(F.col("rain") - 1).alias("rain_flag"),
                    wx.snow_flag(snow).alias("snow_flag"),
                    wx.snow_flag(snow, "rain", either=True).alias("wet_flag"),
                    r6(wx.discomfort_index("temp", "humidity")).alias("discomfort"),
                    r6(wx.rain_log1p("rain")).alias("rain_log1p"),
                    r6(tp.signed_log1p(F.col("temp") - 50)).alias("temp_slog"),
                    r6(F.expm1(F.log1p("rain"))).alias("rain_back"),
                    tp.clip(F.col("temp") - 50, lo=0).alias("temp_clip0"))


# P24 / P26 / P27 / P28 ------------------------------------------------------------------
@register("p24_interactions_ratios", "P24 P26 P27 P28", PANEL + """,
pl AS (SELECT *, lag(total_flow, 24) OVER w AS lag24, lag(total_flow, 168) OVER w AS lag168
       FROM panel WINDOW w AS (PARTITION BY station_id ORDER BY ts))
SELECT station_id, ts,
       CAST(hour(ts) * CAST(isodow(ts) < 6 AS INTEGER) AS INTEGER) AS hour_x_workday,
       CAST(hour(ts) * (1 - CAST(isodow(ts) < 6 AS INTEGER)) AS INTEGER) AS hour_x_weekend,
       least(greatest(net_flow, -3), 3) AS net_clip,
       round(CASE WHEN outflow = 0 THEN 0.0 ELSE inflow / outflow END, 6) AS in_out_ratio,
       round(lag168 / (lag24 + 0.1), 6) AS smooth_ratio,
       total_flow * total_flow AS total_sq
FROM pl""", check="T")
def p24(spark, sf_dir):
    p = hourly_flow_panel(spark, sf_dir)
    w = Window.partitionBy("station_id").orderBy("ts")
    p = p.withColumns({"lag24": F.lag("total_flow", 24).over(w), "lag168": F.lag("total_flow", 168).over(w),
                       "workday": (F.weekday("ts") < 5).cast("int"), "hour": F.hour("ts")})
    it = tp.interactions("hour", "workday", "total_flow", "total_flow", "net_flow", "workday")
    return p.select("station_id", "ts", it["hour_x_workday"].alias("hour_x_workday"),
                    it["hour_x_weekend"].alias("hour_x_weekend"),
                    tp.clip("net_flow", -3, 3).alias("net_clip"),
                    r6(tp.safe_ratio("inflow", "outflow")).alias("in_out_ratio"),
                    r6(tp.smoothed_ratio("lag168", "lag24")).alias("smooth_ratio"),
                    it["temp_sq"].alias("total_sq"))


# P29-P33 ------------------------------------------------------------------------------
ADDR_SQL = """addr AS (
  SELECT station_id, region,
         CASE WHEN CAST(substr(station_id, 4) AS INTEGER) % 4 = 0 THEN NULL
              ELSE '서울특별시 마포구 합정' || substr(station_id, 4) || '동 ' || substr(station_id, 4) END AS addr1,
         '서교동 ' || CASE WHEN region = 3 THEN '공항철도' ELSE 'KTX' END AS addr2
  FROM stations)"""


def _addr(spark, sf_dir):
    s = ad.stations(spark, sf_dir)
    n = F.substring("station_id", 4, 10)
    return s.select("station_id", "region",
                    F.when(n.cast("int") % 4 == 0, F.lit(None))
                    .otherwise(F.concat(F.lit("서울특별시 마포구 합정"), n, F.lit("동 "), n)).alias("addr1"),
                    F.concat(F.lit("서교동 "), F.when(F.col("region") == 3, F.lit("공항철도"))
                             .otherwise(F.lit("KTX"))).alias("addr2"))


# Region code -> label used by the P32 mapping query.
REGION_LABELS = {0: "africa", 1: "america", 2: "asia", 3: "europe"}


@register("p29_text_rules", "P29 P30 P31 P32 P33 D5", V("stations") + "," + ADDR_SQL + """
SELECT station_id,
       coalesce(nullif(regexp_extract(addr1, '([가-힣0-9]+동)', 1), ''),
                nullif(regexp_extract(addr2, '([가-힣0-9]+동)', 1), '')) AS dong,
       regexp_replace(replace(replace(addr1, '서울특별시', ''), '마포구', ''), '\\s+', '', 'g') AS addr_clean,
       CAST(coalesce(contains(addr2, '공항'), false) AS INTEGER) AS airport_line,
       CASE region WHEN 0 THEN 'africa' WHEN 1 THEN 'america' WHEN 2 THEN 'asia' WHEN 3 THEN 'europe'
                   ELSE 'other' END AS region_label,
       CASE WHEN addr1 IS NULL THEN 'no_address' WHEN region >= 3 THEN 'far' WHEN region = 0 THEN 'base'
            ELSE 'near' END AS rule_label,
       region + 1 AS region_plus1
FROM addr""")
def p29(spark, sf_dir):
    a = _addr(spark, sf_dir)
    return a.select("station_id", tp.extract_dong("addr1", "addr2").alias("dong"),
                    tp.strip_words("addr1", ["서울특별시", "마포구"]).alias("addr_clean"),
                    tp.contains_flag("addr2", "공항").alias("airport_line"),
                    tp.map_values("region", REGION_LABELS, "other").alias("region_label"),
                    tp.select_rules([(F.col("addr1").isNull(), "no_address"), (F.col("region") >= 3, "far"),
                                     (F.col("region") == 0, "base")], "near").alias("rule_label"),
                    (F.col("region") + 1).alias("region_plus1"))


# P34-P38 ------------------------------------------------------------------------------
@register("p34_numeric_codes", "P34 P35 P36 P37 P38", V("trips", "stations") + """,
tx AS (SELECT event_id, end_id, ts, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE CAST(use_min AS VARCHAR) END AS txt
       FROM trips),
first_seen AS (SELECT end_id, min((ts, event_id)) AS f FROM tx GROUP BY 1),
codes AS (SELECT end_id, CAST(dense_rank() OVER (ORDER BY f) - 1 AS INTEGER) AS code_first,
                 CAST(dense_rank() OVER (ORDER BY end_id) - 1 AS INTEGER) AS code_sorted FROM first_seen)
SELECT tx.event_id, coalesce(TRY_CAST(txt AS DOUBLE), -1.0) AS num,
       ceil(TRY_CAST(txt AS DOUBLE)) AS num_ceil, floor(TRY_CAST(txt AS DOUBLE)) AS num_floor,
       round_even(TRY_CAST(txt AS DOUBLE), 1) AS num_round,
       s.lcd + CASE WHEN s.region = 2 THEN 0 ELSE s.qr END AS capacity,
       codes.code_first, codes.code_sorted
FROM tx JOIN codes USING (end_id) JOIN stations s ON s.station_id = tx.end_id""")
def p34(spark, sf_dir):
    t = ad.trips(spark, sf_dir)
    tx = t.select("event_id", "end_id", "ts",
                  F.when(F.col("event_id") % 9 == 0, F.lit("n/a"))
                  .otherwise(F.col("use_min").cast("string")).alias("txt"))
    first = tx.groupBy("end_id").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    codes = first.select("end_id",
                         (F.dense_rank().over(Window.orderBy("f")) - 1).alias("code_first"),
                         (F.dense_rank().over(Window.orderBy("end_id")) - 1).alias("code_sorted"))
    s = ad.stations(spark, sf_dir).select(
        F.col("station_id").alias("end_id"),
        tp.capacity("lcd", F.when(F.col("region") == 2, F.lit(None)).otherwise(F.col("qr"))).alias("capacity"))
    num = tp.to_number("txt")
    x = tx.join(codes, "end_id").join(F.broadcast(s), "end_id")  # station dim: one row per station
    return x.select("event_id", F.coalesce(num, F.lit(-1.0)).alias("num"),
                    F.ceil(num).cast("double").alias("num_ceil"), F.floor(num).cast("double").alias("num_floor"),
                    F.bround(num, 1).alias("num_round"), "capacity", "code_first", "code_sorted")
