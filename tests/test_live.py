"""Live projection against a plain loop."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import live

START = dt.datetime(2024, 3, 2, 16)
MODELS = {"outflow": live.FlowModel(0.2, {"temp": (0.03, 10.0), "rush": (0.4, 0.2)}, {"lag_1h": (0.05, 2.0), "lag_24h": (0.02, 2.0), "rolling_3h": (0.1, 2.0)}),
          "inflow": live.FlowModel(-0.1, {"temp": (0.01, 10.0), "rush": (0.1, 0.2)}, {"lag_1h": (0.08, 1.5), "lag_24h": (0.01, 1.5), "rolling_3h": (0.05, 1.5)})}


def loop(past, stock, known, steps=12):
    """``past``: flow -> {hour: value}; the reference walk with dictionaries."""
    seen = {f: dict(past[f]) for f in live.FLOWS}
    out = []
    for s in range(steps):
        t = START + dt.timedelta(hours=s)
        pred = {}
        for f, m in MODELS.items():
            get = lambda h: seen[f].get(t - dt.timedelta(hours=h))  # noqa: B023, E731
            v = m.intercept + sum(c * (mean if known.get(t, {}).get(k) is None else known[t][k]) for k, (c, mean) in m.known.items())
            three = [x for x in (get(1), get(2), get(3)) if x is not None]
            for name, value in (("lag_1h", get(1)), ("lag_24h", get(24)), ("rolling_3h", np.mean(three) if three else None)):
                c, mean = m.lags[name]
                v += c * (mean if value is None else value)
            pred[f] = math.expm1(v)
        for f in live.FLOWS:
            seen[f][t] = pred[f]
        after = stock + pred["inflow"] - pred["outflow"]
        out.append((s + 1, stock, pred["inflow"], pred["outflow"], after, int(after <= 0)))
        stock = after
    return out


def tables(spark):
    rng = np.random.default_rng(4)
    rows, past = [], {}
    for g in ("a", "b", "c"):
        past[g] = {f: {} for f in live.FLOWS}
        for h in range(1, 40):
            if g == "b" and h in (1, 2, 3, 24, 20):
                continue                                            # missing hours
            t = START - dt.timedelta(hours=h)
            values = [int(v) for v in rng.integers(0, 9, 2)]
            rows.append((g, t, *values))
            for f, v in zip(live.FLOWS, values):
                past[g][f][t] = v
    rows.append(("a", START, 99, 99))                              # not yet known at the start
    past["d"] = {f: {} for f in live.FLOWS}                        # no history at all
    history = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, outflow int, inflow int")
    known = {START + dt.timedelta(hours=s): {"temp": 8.0 + s, "rush": float(s in (1, 2))} for s in range(12) if s != 5}
    known[START + dt.timedelta(hours=7)]["temp"] = None
    future = spark.createDataFrame([(t, v["temp"], v["rush"]) for t, v in known.items()], "ts timestamp_ntz, temp double, rush double")
    stock = spark.createDataFrame([("a", 6), ("b", 0), ("c", 30), ("d", 2)], "station_id string, live_stock int")
    return history, stock, future, past, known


def test_projection_equals_the_loop(spark):
    history, stock, future, past, known = tables(spark)
    with pytest.warns(UserWarning, match="1 of 12"):
        got = live.live_projection(history, stock, future, MODELS, START.isoformat(sep=" "))
    rows = {}
    for r in got.orderBy("station_id", "step").collect():
        assert r.ts == START + dt.timedelta(hours=r.step - 1)
        rows.setdefault(r.station_id, []).append((r.step, r.stock_before, r.pred_inflow, r.pred_outflow, r.stock_after, r.risk_zero_stock))
    for g, s in (("a", 6), ("b", 0), ("c", 30), ("d", 2)):
        assert np.allclose(rows[g], loop(past[g], s, known))
    summary = {r.station_id: r for r in live.live_summary(got).collect()}
    for g, path in rows.items():
        low = min(p[4] for p in path)
        need = math.ceil(max(0, -low))
        risk = int(low <= 0)
        r = summary[g]
        assert (r.start_stock, r.need, r.risk_zero_stock) == (path[0][1], need, risk) and math.isclose(r.end_stock, path[-1][4])
        assert r.priority == ("act_now" if risk and need >= 3 else "review" if risk and need >= 1 else "watch")
    assert summary["c"].priority == "watch" and {r.priority for r in summary.values()} != {"watch"}


def test_null_stock_raises(spark):
    history, stock, future, _, _ = tables(spark)
    with pytest.raises(ValueError):
        live.live_projection(history, stock.withColumn("live_stock", F.lit(None).cast("int")), future, MODELS, START.isoformat(sep=" "))


def test_fitted_models_recover_a_signal(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(3):
        out, inn = [3.0] * 30, [2.0] * 30
        for h in range(30, 700):
            temp = math.sin(h / 9)
            out.append(math.expm1(0.5 + 0.3 * temp + 0.02 * out[-1] + 0.01 * out[-24] + 0.05 * np.mean(out[-3:]) + rng.normal(0, 0.01)))
            inn.append(math.expm1(0.3 - 0.2 * temp + 0.05 * inn[-1] + rng.normal(0, 0.01)))
        rows += [(str(g), dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), out[h], inn[h], math.sin(h / 9)) for h in range(700)]
    panel = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, outflow double, inflow double, temp double")
    models = live.fit_flow_models(live.flow_lags(panel).filter(F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz")), ["temp"])
    assert abs(models["outflow"].known["temp"][0] - 0.3) < 0.02 and abs(models["inflow"].known["temp"][0] + 0.2) < 0.02
