"""Context features on fixtures (FIXTURES F5, F6): tiered district match,
population 0, transit index with one-direction names and stations without exits."""

import datetime as dt
import math

from stationflow.operators import context, spatial


def test_three_tier_match_and_zero_population(spark):
    stations = spark.createDataFrame([
        ("A", 37.500, 127.000, "D1"),   # a district point 110 m away -> tier 1
        ("B", 37.600, 127.000, "D2"),   # nothing near, own district D2 exists -> tier 2
        ("C", 37.700, 127.300, "D9")],  # nothing near, district unknown -> nearest
        "station_id string, lat double, lon double, dong string")
    rm = spark.createDataFrame([
        ("D1", 1, 37.501, 127.000, 100.0, 10.0, 20.0, 30.0, 40.0),
        ("D2", 1, 37.650, 127.000, 0.0, 0.0, 0.0, 0.0, 0.0),
        ("D3", 1, 37.690, 127.290, 50.0, 5.0, 5.0, 10.0, 30.0)],
        "dong string, month int, lat double, lon double, pop_total double, "
        "pop_c1 double, pop_c2 double, pop_c3 double, pop_c4 double")
    m = {r.station_id: (r.dong, r.tier) for r in spatial.three_tier_match(stations, rm).collect()}
    assert m == {"A": ("D1", 1), "B": ("D2", 2), "C": ("D3", 3)}
    f = {r.station_id: r for r in context.build_region_features(stations, rm).collect()}
    assert math.isclose(f["A"].residential, (10 + 20) / 200) and math.isclose(f["A"].tourism, 0.4)
    assert f["B"].residential is None                       # population 0 -> null
    assert math.isclose(f["C"].business, 10 / 50)


def test_tiers_run_inside_each_month(spark):
    """A's near district lacks month 2 and its own district has it; nothing is lost."""
    stations = spark.createDataFrame([("A", 37.500, 127.000, "D2")], "station_id string, lat double, lon double, dong string")
    rows = [("D1", 1, 37.501, 127.0), ("D2", 1, 37.60, 127.0), ("D2", 2, 37.60, 127.0), ("D3", 2, 37.52, 127.0),
            ("D3", 3, 37.52, 127.0), ("D4", 3, 37.90, 127.0)]
    rm = spark.createDataFrame([(*r, 100.0, 10.0, 20.0, 30.0, 40.0) for r in rows],
                               "dong string, month int, lat double, lon double, pop_total double, "
                               "pop_c1 double, pop_c2 double, pop_c3 double, pop_c4 double")
    got = {(r.month, r.dong, r.tier) for r in spatial.three_tier_match(stations, rm).collect()}
    assert got == {(1, "D1", 1), (2, "D2", 2), (3, "D3", 3)}
    assert {r.month for r in context.build_region_features(stations, rm).collect()} == {1, 2, 3}


def test_subway_features_near_and_absent(spark):
    stations = spark.createDataFrame([("A", 37.5, 127.0), ("B", 37.9, 127.5)],
                                     "station_id string, lat double, lon double")
    pts = spark.createDataFrame([("S1", 37.5005, 127.0005)], "name string, lat double, lon double")
    d, later = dt.date(2024, 1, 2), dt.date(2024, 1, 4)
    daily = spark.createDataFrame([(d, "S1", "board", 1.0, 3.0, 4.0, 2.0),
                                   (d, "S9", "alight", 1.0, 1.0, 1.0, 7.0),   # S9: far away, one direction
                                   (later, "S1", "alight", 1.0, 2.0, 1.0, 1.0)],
                                  "day date, name string, direction string, dawn double, am_peak double, "
                                  "daytime double, pm_peak double")
    got = {(r.station_id, r.day): (r.transit_index, r.commute_in_index, r.commute_out_index)
           for r in context.subway_daily_features(stations, pts, daily).collect()}
    none = (0.0, 0.0, 0.0)
    # in: morning share of those who alight; out: evening share of those who board; other way 0
    assert got == {("A", d): (1.0, 0.0, 0.2), ("A", later): (0.5, 0.4, 0.0), ("B", d): none, ("B", later): none}
    f = {r.station_id: r for r in context.build_subway_features(stations, pts, daily).collect()}
    assert math.isclose(f["A"].transit_index, 0.75) and math.isclose(f["A"].commute_in_index, 0.2)
    assert (f["B"].transit_index, f["B"].commute_in_index) == (0.0, 0.0)   # no stop within 200 m
    assert context.subway_daily_features(stations, pts, daily.limit(0)).count() == 0
