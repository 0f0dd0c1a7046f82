"""Flow, panel and window operators on hand fixtures (FIXTURES F1, F2, F10)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from stationflow.operators import flow, panel, windows

T0 = dt.datetime(2024, 1, 1, 0, 0)


def _ts(h, m=0):
    return T0 + dt.timedelta(hours=h, minutes=m)


def trips_fixture(spark):
    rows = [  # loop trip, trip between two targets, one-sided trips
        (1, "A", "A", _ts(0, 5)), (2, "A", "B", _ts(0, 30)), (3, "B", "C", _ts(2, 10)),
        (4, "C", "A", _ts(3, 0)), (5, "A", "B", _ts(3, 59))]
    return spark.createDataFrame(rows, "event_id long, start_id string, end_id string, ts timestamp_ntz")


def test_explode_roles(spark):
    ex = flow.explode_by_station(trips_fixture(spark), ["A", "B"]).orderBy("event_id", "station_id").collect()
    got = [(r.event_id, r.station_id, r.role) for r in ex]
    assert got == [(1, "A", "both"), (2, "A", "start"), (2, "B", "end"), (3, "B", "start"),
                   (4, "A", "end"), (5, "A", "start"), (5, "B", "end")]


def test_role_flow_totals_add_up(spark):
    ex = flow.explode_by_station(trips_fixture(spark))
    hf = flow.add_flow_totals(flow.role_flow(ex))
    tot = hf.agg(F.sum("inflow"), F.sum("outflow"), F.sum("total_flow")).first()
    n_in = ex.filter(F.col("role").isin("end", "both")).count()
    n_out = ex.filter(F.col("role").isin("start", "both")).count()
    assert (tot[0], tot[1], tot[2]) == (n_in, n_out, n_in + n_out)
    loop = hf.filter((F.col("station_id") == "A") & (F.col("ts") == _ts(0))).first()
    assert (loop.inflow, loop.outflow) == (1, 2)  # loop trip counts once each way


def test_densify_one_row_per_hour_and_idempotent(spark):
    hf = flow.role_flow(flow.explode_by_station(trips_fixture(spark)))
    d1 = panel.densify(hf, value_cols=["inflow", "outflow"])
    d2 = panel.densify(d1, value_cols=["inflow", "outflow"])
    assert d1.count() == d1.select("station_id", "ts").distinct().count()
    assert sorted(d1.collect()) == sorted(d2.collect())
    a = d1.filter("station_id = 'A'").orderBy("ts").collect()
    assert [r.ts.hour for r in a] == [0, 1, 2, 3]       # gap hours filled
    assert a[1].inflow == 0 and a[1].outflow == 0


def test_densify_whole_days_and_common(spark):
    hf = flow.role_flow(flow.explode_by_station(trips_fixture(spark)))
    assert panel.densify(hf, whole_days=True).filter("station_id = 'C'").count() == 24
    common = panel.densify_common(hf)
    assert common.count() == 3 * 4                       # 3 stations x global 00..03


def test_interpolate_linear_ends_and_middle(spark):
    rows = [(_ts(h), v) for h, v in [(0, None), (1, 10.0), (2, None), (3, None), (4, 40.0), (5, None)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, temp double")
    out = [r.temp for r in panel.interpolate_linear(df, ["temp"], "ts").orderBy("ts").collect()]
    assert out == [10.0, 10.0, 20.0, 30.0, 40.0, 40.0]


def test_ffill_bfill_per_station(spark):
    rows = [("A", _ts(0), None), ("A", _ts(1), 1.0), ("A", _ts(2), None),
            ("B", _ts(0), None), ("B", _ts(1), None), ("B", _ts(2), 5.0)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, v double")
    out = panel.ffill_bfill(df, ["v"], ["ts"], ["station_id"]).orderBy("station_id", "ts")
    assert [r.v for r in out.collect()] == [1.0, 1.0, 1.0, 5.0, 5.0, 5.0]  # no cross-station bleed


def test_guarded_rolling_and_future_sum(spark):
    rows = [("A", _ts(h), float(h)) for h in range(6)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, x double")
    r = windows.add_trailing_means(df, "x", [2]).orderBy("ts").collect()
    assert [x.x_roll2 for x in r] == [None, None, 0.5, 1.5, 2.5, 3.5]
    f = windows.add_future_sum(df, "x", 3).orderBy("ts").collect()
    assert [x.x_next3 for x in f] == [3.0, 6.0, 9.0, 12.0, None, None]


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "v double")
    r = sorted(x.v_avgrank for x in windows.add_average_rank(df, "v").collect())
    assert r == [1.0, 2.5, 2.5, 4.0]


def test_quantile_bins_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    b = {r.bin: r.n for r in windows.quantile_bins(df, "v", 4).collect()}
    assert sum(b.values()) == 10 and min(b) == 0 and max(b) == 3


def test_arg_best_first_on_ties(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 5.0), ("A", 3, 1.0)], "k string, d int, v double")
    r = windows.arg_best(df, ["k"], "v", ["d"], largest=True, tiebreak=["d"]).first()
    assert r.d == 1


def test_event_deltas_and_two_sided(spark):
    t = trips_fixture(spark).withColumns({"cnt": F.lit(1.0), "basis": F.lit("dep")})
    d = flow.event_deltas(t)
    assert d.agg(F.sum("delta")).first()[0] == 0.0
    ts = flow.two_sided_flow(t)
    assert math.isclose(ts.agg(F.sum("rentals")).first()[0], 5.0)


def test_internal_arrival_duplicates_observed(spark):
    from pyspark.sql import Observation
    from stationflow.operators import cleanse
    rows = [(1, "A", "B", "arr"), (2, "A", "B", "dep"), (3, "A", "C", "arr"), (4, "B", "A", "arr")]
    df = spark.createDataFrame(rows, "event_id long, start_id string, end_id string, basis string")
    obs = Observation("dups")
    kept = cleanse.drop_internal_arrival_duplicates(df, ["A", "B"], observation=obs)
    assert sorted(r.event_id for r in kept.collect()) == [2, 3]
    assert obs.get["removed"] == 2
