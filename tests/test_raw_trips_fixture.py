"""The raw trip fixture of FIXTURES F1 through resolution, parsing and guards, and
the ML sanity rule of SURVEY 5 (a model beats the mean on a synthetic signal)."""

import datetime as dt

from pyspark.sql import functions as F

from stationflow import schema
from stationflow.functions import timeparts as tp
from stationflow.operators import cleanse, evaluate as ev, flow, models as md

DEP, ARR = "출발시간", "도착시간"


def raw_fixture(spark):
    rows = [
        (20240105, DEP, 800.0, "A", "A", "A", "A", 1.0, 10.0, "1200"),     # loop trip
        (20240105, DEP, 900.0, "A", "A", "B", "B", 1.0, 12.0, "900"),      # between two targets, departure row
        (20240105, ARR, 1000.0, "A", "A", "B", "B", 1.0, 12.0, "900"),     # same trip, arrival row
        (20240106, ARR, 5.0, "C", "C", "A", "A", 1.0, 20.0, "3000"),       # arrival 00:05, left the day before
        (20240105, DEP, 1100.0, "A", "A", " x ", "X", 1.0, 5.0, "700"),    # unknown destination, blanks, lower case
        (20240105, DEP, 1200.0, "A", "A", "C", "C", 1.0, None, "800"),     # null minutes
        (20240105, DEP, 1300.0, "B", "B", "C", "C", 1.0, 3.0, "50"),       # distance exactly 50
        (20240105, DEP, 1400.0, "B", "B", "C", "C", 1.0, 3.0, "50.1"),     # just above
        (20240105, DEP, 1500.0, "B", "B", "C", "C", 1.0, 3.0, "n/a"),      # not a number
        (20240105, DEP, 1600.0, "B", "B", "C", "C", 1.0, 0.0, "0"),        # zero distance and minutes
        (20240105, DEP, 1700.0, "C", "C", "A", "A", 2.0, 8.0, "600"),      # exact duplicate ...
        (20240105, DEP, 1700.0, "C", "C", "A", "A", 2.0, 8.0, "600")]      # ... of this row
    cols = ["기준_날짜", "집계_기준", "기준_시간대", "시작_대여소_ID", "시작_대여소명", "종료_대여소_ID",
            "종료_대여소명", "전체_건수", "전체_이용_분", "전체_이용_거리"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in zip(
        cols, ["bigint", "string", "double", "string", "string", "string", "string", "double", "double",
               "string"])))


def test_raw_trips_pipeline(spark):
    df = schema.resolve_columns(raw_fixture(spark))
    df = df.withColumn("basis", tp.map_values("basis", schema.BASIS_CODES, None))
    df = df.withColumn("ts", tp.parse_date_hhmm("base_date", "hour"))
    assert df.filter(F.col("ts").isNull()).count() == 0
    assert cleanse.drop_unknown_destination(df).count() == 11
    guarded = cleanse.distance_guard(df)
    assert sorted(r.use_dist for r in guarded.select("use_dist").collect()) == sorted(
        ["1200", "900", "900", "3000", "700", "800", "50.1", "600", "600"])
    assert cleanse.drop_zero_trips(df.withColumn("use_dist", tp.to_number("use_dist"))).count() == 11
    assert df.dropDuplicates().count() == 11
    dep = df.withColumn("dep_ts", tp.departure_ts("ts", "basis", "use_min"))
    r = dep.filter(F.col("base_date") == 20240106).first()
    assert r.dep_ts == dt.datetime(2024, 1, 5, 23, 45)   # arrival 00:05 minus 20 minutes
    ex = flow.explode_by_station(df.filter(F.col("basis") == "dep"), ["A", "B"])
    roles = {(r.start_id, r.end_id, r.station_id): r.role for r in ex.collect()}
    assert roles[("A", "A", "A")] == "both" and roles[("A", "B", "A")] == "start" and roles[("A", "B", "B")] == "end"
    internal = cleanse.drop_internal_arrival_duplicates(df, ["A", "B"])
    assert internal.count() == 11                          # the arrival copy of the A->B trip is gone


def test_model_beats_mean_on_signal(spark):
    rows = [(i, float(i % 50), float(2 * (i % 50) + (i % 7) * 0.3)) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    tr, te = df.filter("i < 400"), df.filter("i >= 400")
    for kind, params in (("linear", {}), ("gbt", {"maxIter": 10, "maxDepth": 3})):
        p = md.predict(md.fit(tr, ["x"], "y", kind, scale=False, **params), te)
        assert ev.regression_metrics(p, "y", "pred").first().r2 > 0.9
