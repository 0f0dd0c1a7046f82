"""Live projection of dock stock.

From the stock that is in the docks now, the next hours are forecast one after the other:
inflow and outflow by a model each, whose lags and 3-hour means take the forecasts of the
hours before, and the stock path they make. The whole recursion of a station is one fold
over its steps inside one expression: the state holds the last 24 hours of both flows and
the stock, the models' coefficients are literals. No job, join or checkpoint per step, and
stations never meet.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import moments as mo

LAGS = ("lag_1h", "lag_24h", "rolling_3h")
FLOWS = ("outflow", "inflow")
DAY = 24


@dataclass(frozen=True)
class FlowModel:
    """``log1p(flow)`` as a linear function; a missing value counts as its training mean."""

    intercept: float
    known: dict[str, tuple[float, float]]      # feature known ahead -> (coefficient, training mean)
    lags: dict[str, tuple[float, float]]       # of LAGS


def flow_lags(panel: DataFrame, station: str = "station_id", time_col: str = "ts") -> DataFrame:
    """``panel`` (gap-free hours) with the three history features of both flows."""
    w = Window.partitionBy(station).orderBy(time_col)
    last3 = w.rowsBetween(-3, -1)
    out = {}
    for f in FLOWS:
        out |= {f"{f}_lag_1h": F.lag(f, 1).over(w).cast("double"), f"{f}_lag_24h": F.lag(f, DAY).over(w).cast("double"),
                f"{f}_rolling_3h": F.avg(F.col(f).cast("double")).over(last3)}
    return panel.withColumns(out)


def fit_flow_models(train: DataFrame, known: list[str], alpha: float = 0.0) -> dict[str, FlowModel]:
    """Both models from one pass over the rows (those without nulls) of ``train``, which has
    the columns ``known``, those of :func:`flow_lags` and the two flows."""
    cols = [*known, *(f"{f}_{x}" for f in FLOWS for x in LAGS)]
    rows = train.withColumns({f"_log_{f}": F.log1p(F.col(f).cast("double")) for f in FLOWS})
    m = mo.read_moments(mo.moments(rows, [*cols, *(f"_log_{f}" for f in FLOWS)])).get((), mo.Moment.empty(len(cols) + 2))
    models = {}
    for i, f in enumerate(FLOWS):
        own = [*known, *(f"{f}_{x}" for x in LAGS)]
        at = [cols.index(c) for c in own]
        fit = mo.solve(m, at, len(cols) + i, alpha)
        pairs = [(float(c), float(m.mean[a])) for c, a in zip(fit.coef, at)]
        models[f] = FlowModel(fit.intercept, dict(zip(known, pairs)), dict(zip(LAGS, pairs[len(known):])))
    return models


def _weighted(coef_mean: tuple[float, float], value: Column) -> Column:
    coef, mean = coef_mean
    return F.lit(coef) * F.coalesce(value, F.lit(mean))


def _by_key(values: Column, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.element_at(values, k))


def live_projection(history: DataFrame, live_stock: DataFrame, future: DataFrame, models: dict[str, FlowModel], start_ts, steps: int = 12,
                    station: str = "station_id", time_col: str = "ts", stock: str = "live_stock") -> DataFrame:
    """Hour by hour for every station of ``live_stock``: ``step`` (from 1), ``stock_before,
    pred_inflow, pred_outflow, stock_after`` and ``risk_zero_stock`` (stock after the hour
    is 0 or less). ``history`` has the flows of past hours; ``future`` the models' known
    features by ``time_col`` (an hour that it lacks counts as average). A station without
    history is projected from average lags. A null stock raises."""
    start = F.lit(start_ts).cast("timestamp_ntz")
    if live_stock.filter(F.col(stock).isNull()).limit(1).count():
        raise ValueError("a station has no live stock")
    # the 24 hours before the start, by age in hours: at most 24 entries a station
    age = F.timestamp_diff("HOUR", F.col(time_col), start).cast("int")
    past = history.filter((F.col(time_col) < start) & (F.col(time_col) >= start - F.make_dt_interval(hours=F.lit(DAY)))) \
        .groupBy(station).agg(*[F.map_from_entries(F.collect_list(F.struct(age.alias("k"), F.col(f).cast("double").alias("v")))).alias(f"_{f}") for f in FLOWS])
    ages = F.sequence(F.lit(DAY), F.lit(1), F.lit(-1))
    rows = live_stock.select(station, F.col(stock).cast("double").alias("_stock")).join(past, station, "left")
    for f in FLOWS:
        rows = rows.withColumn(f"_{f}", _by_key(F.col(f"_{f}"), ages))
    # what the models know ahead, step by step: one row for all stations
    known = sorted({k for m in models.values() for k in m.known})
    ahead = future.filter((F.col(time_col) >= start) & (F.col(time_col) < start + F.make_dt_interval(hours=F.lit(steps)))) \
        .select((F.timestamp_diff("HOUR", start, F.col(time_col)) + 1).cast("int").alias("step"), *[F.col(k).cast("double").alias(k) for k in known])
    of_step = {r["step"]: r.asDict() for r in ahead.collect()}                 # steps rows
    if len(of_step) < steps:
        warnings.warn(f"{steps - len(of_step)} of {steps} hours have no known features", stacklevel=2)

    def fixed(f: str, step: int) -> float:
        m, row = models[f], of_step.get(step, {})
        return m.intercept + sum(c * (mean if row.get(k) is None else row[k]) for k, (c, mean) in m.known.items())

    plan = F.array(*[F.struct(F.lit(s).alias("step"), *[F.lit(float(fixed(f, s))).alias(f) for f in FLOWS]) for s in range(1, steps + 1)])

    def forecast(f: str, state: Column, hour: Column) -> Column:
        past_f, lags = state[f], models[f].lags
        seen = F.filter(F.slice(past_f, -3, 3), lambda v: v.isNotNull())
        mean3 = F.when(F.size(seen) > 0, F.aggregate(seen, F.lit(0.0), lambda a, v: a + v) / F.size(seen))
        return F.expm1(hour[f] + _weighted(lags["lag_1h"], F.element_at(past_f, -1)) + _weighted(lags["lag_24h"], F.element_at(past_f, -DAY))
                       + _weighted(lags["rolling_3h"], mean3))

    hour_type = "array<struct<step:int,stock_before:double,pred_inflow:double,pred_outflow:double,stock_after:double>>"
    first = F.struct(*[F.col(f"_{f}").alias(f) for f in FLOWS], F.col("_stock").alias("stock"), F.array().cast(hour_type).alias("hours"))

    def step(state: Column, hour: Column) -> Column:
        pred = {f: forecast(f, state, hour) for f in FLOWS}
        with_pred = {f: F.array_append(F.slice(state[f], 2, DAY - 1), p) for f, p in pred.items()}
        made = {f: F.element_at(with_pred[f], -1) for f in FLOWS}
        after = state["stock"] + made["inflow"] - made["outflow"]
        line = F.struct(hour["step"].alias("step"), state["stock"].alias("stock_before"), made["inflow"].alias("pred_inflow"),
                        made["outflow"].alias("pred_outflow"), after.alias("stock_after"))
        return F.struct(*[with_pred[f].alias(f) for f in FLOWS], after.alias("stock"), F.array_append(state["hours"], line).alias("hours"))

    path = rows.select(station, F.inline(F.aggregate(plan, first, step)["hours"]))
    return path.withColumns({time_col: start + F.make_dt_interval(hours=F.col("step") - 1), "risk_zero_stock": (F.col("stock_after") <= 0).cast("int")})


def live_summary(projection: DataFrame, station: str = "station_id", act_now: int = 3, review: int = 1) -> DataFrame:
    """Per station: stock at the start, totals, lowest and last stock, risk, the bikes needed
    now (``ceil(max(0, -lowest))``) and the label: at risk and ``act_now`` bikes or more, at
    risk and ``review`` or more, or only watched."""
    need = F.ceil(F.greatest(F.lit(0.0), -F.min("stock_after"))).cast("long")
    g = projection.groupBy(station).agg(
        F.min_by("stock_before", "step").alias("start_stock"), F.sum("pred_inflow").alias("total_inflow"), F.sum("pred_outflow").alias("total_outflow"),
        F.min("stock_after").alias("min_stock"), F.max_by("stock_after", "step").alias("end_stock"), F.max("risk_zero_stock").alias("risk_zero_stock"),
        need.alias("need"))
    at_risk = F.col("risk_zero_stock") == 1
    return g.withColumn("priority", F.when(at_risk & (F.col("need") >= act_now), "act_now").when(at_risk & (F.col("need") >= review), "review")
                        .otherwise("watch"))
