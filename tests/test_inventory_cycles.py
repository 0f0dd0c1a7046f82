"""Inventory recurrences against direct Python loops (SURVEY 5: I6 closed form equals
a loop; I3 stays in [0, cap]) and cycle boundaries (FIXTURES F11)."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from stationflow.functions.timeparts import cycle_start
from stationflow.operators import cycles, inventory as inv

T0 = dt.datetime(2024, 1, 1)


def loop_refill(needs, nets):
    stock, out = 0, []
    for g, n in zip(needs, nets):
        add = max(0, g - stock)
        start = stock + add
        end = start + n
        out.append((start, end, add))
        stock = max(end, 0)
    return out


def test_carried_refill_matches_loop(spark):
    rng = random.Random(3)
    rows, expect = [], {}
    for s in range(40):
        needs = [rng.randint(0, 9) for _ in range(15)]
        nets = [rng.randint(-6, 6) for _ in range(15)]
        needs = [max(g, -n) for g, n in zip(needs, nets)]  # a cycle needs at least its own deficit
        for t, (g, n) in enumerate(zip(needs, nets)):
            rows.append((f"S{s}", T0 + dt.timedelta(hours=12 * t), g, n))
        expect[f"S{s}"] = loop_refill(needs, nets)
    df = spark.createDataFrame(rows, "station_id string, cycle_start timestamp_ntz, need long, net long")
    got = {}
    for r in inv.carried_refill(df).orderBy("station_id", "cycle_start").collect():
        got.setdefault(r.station_id, []).append((r.start, r.end, r.add))
    assert got == expect


def test_simulate_stock_two_barriers(spark):
    rng = random.Random(5)
    rows, expect = [], []
    for s in range(5):
        cap = rng.randint(2, 8)
        stock = cap
        for h in range(24):
            i, o = rng.randint(0, 5), rng.randint(0, 5)
            stock = min(max(stock + i - o, 0), cap)
            rows.append((f"S{s}", T0 + dt.timedelta(hours=h), i, o, cap))
            expect.append((f"S{s}", h, stock))
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, i long, o long, cap int")
    out = inv.simulate_stock(df, "i", "o", "cap").collect()
    got = sorted((r.station_id, r.ts.hour, r.stock) for r in out)
    assert got == sorted(expect)


def test_cycle_need_orders_out_before_in(spark):
    rows = [("A", dt.datetime(2024, 1, 1, 5, 0), 1), ("A", dt.datetime(2024, 1, 1, 5, 0), -1),
            ("A", dt.datetime(2024, 1, 1, 6, 0), -2), ("A", dt.datetime(2024, 1, 1, 3, 59), -1),
            ("A", dt.datetime(2024, 1, 1, 4, 0), 0)]
    df = spark.createDataFrame(rows, "station_id string, event_time timestamp_ntz, delta int")
    got = {r.cycle_start.isoformat(): (r.need, r.net) for r in inv.cycle_need(df).collect()}
    # 03:59 belongs to the 16:00 cycle of the day before
    assert got["2023-12-31T16:00:00"] == (1, -1)
    # same minute: -1 before +1 -> running -1, 0, then -2 -> need 2
    assert got["2024-01-01T04:00:00"] == (2, -2)


def test_cycle_start_grid(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3, 59),), (dt.datetime(2024, 1, 1, 4, 0),),
                                (dt.datetime(2024, 1, 1, 16, 0),), (dt.datetime(2024, 1, 2, 0, 30),)],
                               "ts timestamp_ntz")
    got = [r[0].isoformat() for r in df.select(cycle_start("ts")).collect()]
    assert got == ["2023-12-31T16:00:00", "2024-01-01T04:00:00", "2024-01-01T16:00:00", "2024-01-01T16:00:00"]


def test_simulate_stock_keeps_fractions(spark):
    rows = [("A", T0 + dt.timedelta(hours=h), 0.0, 0.4, 10) for h in range(4)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, i double, o double, cap int")
    out = inv.simulate_stock(df, "i", "o", "cap").orderBy("ts").collect()
    assert [round(r.stock, 6) for r in out] == [9.6, 9.2, 8.8, 8.4]
    assert [round(r.stock_start, 6) for r in out] == [10, 9.6, 9.2, 8.8]


def test_projection_12h_matches_loop(spark):
    rng = random.Random(9)
    flows = [(rng.randint(0, 6) / 2, rng.randint(0, 6) / 2) for _ in range(60)]
    rows = [("A", T0 + dt.timedelta(hours=h), i, o, float(h % 7)) for h, (i, o) in enumerate(flows)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, inflow double, outflow double, stock_start double")
    proj = inv.projection_12h(df)
    got = {r.cycle_start.hour + 24 * (r.cycle_start.day - 1): r for r in proj.collect()}
    needs = []
    for h in range(len(flows) - 11):
        if h % 24 not in (4, 16):
            continue
        stock, path = float(h % 7), []
        for i, o in flows[h:h + 12]:
            stock += i - o
            path.append(stock)
        needs.append(math.ceil(max(0, -min(path))))
        r = got.pop(h)
        assert (r.start_stock, r.proj_end, r.proj_min, r.need, r.risk) == (
            float(h % 7), path[-1], min(path), needs[-1], int(min(path) <= 0))
        assert (r.total_inflow, r.total_outflow) == tuple(map(sum, zip(*flows[h:h + 12])))
    assert not got
    s = inv.risk_summary(proj).first()
    assert s.priority == ("act_now" if max(needs) >= 3 else "review" if max(needs) >= 1 else "watch")


def test_demand_before_visit_keeps_fractions(spark):
    rows = [("A", dt.datetime(2024, 1, 1, 4 + h), 0.5) for h in range(12)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, outflow double")
    got = {r.visit_hour: r.demand_before for r in cycles.demand_before_visit(df, "outflow").collect()}
    assert got[0] == 0 and got[3] == 1.5 and got[11] == 5.5


def test_demand_before_visit(spark):
    rows = [("A", dt.datetime(2024, 1, 1, 4 + h), h + 1) for h in range(12)]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, outflow long")
    got = {r.visit_hour: r.demand_before for r in cycles.demand_before_visit(df, "outflow").collect()}
    assert got[0] == 0 and got[1] == 1 and got[3] == 1 + 2 + 3 and got[11] == sum(range(1, 12))


def test_estimated_stock_clip(spark):
    rows = [("A", T0 + dt.timedelta(hours=h), n, 3) for h, n in enumerate([-2, -2, 5, 1])]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, net long, capacity int")
    r = inv.estimated_stock(df, "net", "capacity").orderBy("ts").collect()
    assert [x.stock_start for x in r] == [3, 1, -1, 4]
    assert [x.stock_start_clip for x in r] == [3, 1, 0, 3]
    assert all(0 <= x.stock_end_clip <= 3 for x in r)


def test_hot_minute_need_and_visits_match_loops(spark):
    rng = random.Random(21)
    rows = [("A", T0 + dt.timedelta(seconds=rng.randint(0, 59)), rng.choice([-2, -1, 1])) for _ in range(400)] + \
        [(rng.choice("AB"), T0 + dt.timedelta(seconds=rng.randint(0, 3 * 86400)), rng.choice([-1, 1])) for _ in range(600)]
    df = spark.createDataFrame(rows, "station_id string, event_time timestamp_ntz, delta int")
    cycles = {}
    for s, t, d in sorted(rows):
        c = t.replace(minute=0, second=0)
        while c.hour not in (4, 16):
            c -= dt.timedelta(hours=1)
        cycles.setdefault((s, c), []).append((t, d))
    needs = inv.cycle_need(df)
    want = {}
    for k, items in cycles.items():
        run, low = 0, 0
        for _, d in items:
            run += d
            low = min(low, run)
        want[k] = (-low, run)
    assert {(r.station_id, r.cycle_start): (r.need, r.net) for r in needs.collect()} == want

    starts = inv.carried_refill(inv.full_cycle_grid(needs)).select("station_id", "cycle_start", "start")
    share = {}
    for r in starts.collect():
        for h in range(12):
            at = r.cycle_start + dt.timedelta(hours=h)
            stock = r.start + sum(d for t, d in cycles.get((r.station_id, r.cycle_start), []) if t < at)
            share.setdefault((r.station_id, at.hour), []).append(stock)
    got = {(r.station_id, r.visit_hour): (round(r.available_share, 9), round(r.mean_stock, 9))
           for r in inv.visit_availability(df, starts).collect()}
    assert got == {k: (round(sum(x > 0 for x in v) / len(v), 9), round(sum(v) / len(v), 9)) for k, v in share.items()}
    assert {h for _, h in got} == set(range(24))
