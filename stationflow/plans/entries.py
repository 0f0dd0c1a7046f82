"""End-to-end feature builds.

Each is a composition of the operators: one lazy plan, dimensions broadcast after a
size check, the only wide steps being the trip aggregation, the panel join and the
per-station windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparts as tp
from ..operators import cleanse, context, flow, panel, windows
from ..sources import adapter as ad
from ..util import bounded_broadcast


def hourly_panel(trips: DataFrame, ids=None) -> DataFrame:
    """G5 -> A2 -> G1 -> A3: gap-free station-hour flow."""
    hf = flow.role_flow(flow.explode_by_station(trips, ids))
    return flow.add_flow_totals(panel.densify(hf, value_cols=["inflow", "outflow"]))


def station_feature_table(spark: SparkSession, sf_dir: str, temp_lookup: DataFrame) -> DataFrame:
    """G20 / entry A: station-hour flow with calendar, time, lagged temperature,
    district indices (by month) and transit features; absent context filled with 0."""
    p = hourly_panel(ad.trips(spark, sf_dir))
    ms, mc = tp.cyclic(F.month("ts"), 12, 1)
    p = p.withColumns({**tp.weekday_one_hot("ts"),
                       "resting_day": tp.weekend_flag("ts"),
                       "rush": tp.hour_in(F.hour("ts"), [7, 8, 9, 17, 18, 19]),
                       "month_sin": ms, "month_cos": mc, "month": F.month("ts")})
    look = temp_lookup.select(F.col("ts").alias("_lts"), F.col("temp").alias("temp_lag_1h"))
    p = p.join(look, F.col("_lts") == F.col("ts") - F.expr("INTERVAL 1 HOUR"), "left").drop("_lts")
    st = ad.stations(spark, sf_dir)
    reg = context.build_region_features(st, ad.region_month(spark, sf_dir)).drop("tier")
    sub = context.build_subway_features(st, ad.subway_points(spark, sf_dir), ad.subway_daily(spark, sf_dir))
    # derived context tables (one row per station x month): no hint, so no extra job to
    # size them; AQE broadcasts them at run time from their materialised size
    p = p.join(reg, ["station_id", "month"], "left").join(sub, "station_id", "left")
    ctx = ["residential", "business", "tourism", "transit_index", "commute_in_index", "commute_out_index"]
    return p.fillna(0.0, subset=ctx).drop("month")


CONTEXT = ["temp_lag_1hr", "residential", "business", "tourism", *context.SUBWAY]


def trip_station_features(trips: DataFrame, ids, stations: DataFrame, temp_lookup: DataFrame, region_month: DataFrame, subway_points: DataFrame,
                          subway_daily: DataFrame, holidays=(), min_m: float = 50.0) -> DataFrame:
    """G20 / entry A at its own grain: one row per trip and involved target station, with the
    trip's role there, the station's place and district, calendar (zero-based month angle,
    weekday one-hot, resting day with ``holidays``), time (hour angle, noon, rush hour), the
    temperature an hour before, district indices of the month, transit and commute indices of
    the day, and a snow flag. Trips of ``min_m`` metres or less, or without a number there, go;
    absent context is 0. ``trips`` has ``start_id, end_id, ts, use_dist, snow`` and whatever
    else is to be carried; ``cnt``, ``snow`` and ``discomfort`` are dropped at the end.

    The trip rows are exploded map-side and meet only dimension tables (a row per station and
    month or day, an hourly series), whose size decides how they are joined."""
    x = flow.explode_by_station(cleanse.distance_guard(cleanse.filter_station_rows(trips, ids), min_m=min_m), ids)
    hour, day = F.hour("ts"), F.to_date("ts")
    ms, mc = tp.cyclic(F.month("ts"), 12, 1)
    hs, hc = tp.cyclic(hour, 24)
    x = x.withColumns({
        "hour_ts": tp.trunc("hour", "ts"), "base_date": day, "hour": hour, "year": F.year("ts"), "month": F.month("ts"), "month_sin": ms, "month_cos": mc,
        **tp.weekday_one_hot("ts", "weekday_"),
        "is_restingday": F.greatest(tp.weekend_flag("ts"), day.isin([F.lit(d).cast("date") for d in holidays]).cast("int") if holidays else F.lit(0)),
        "hour_sin": hs, "hour_cos": hc, "is_noon": (hour >= 12).cast("int"), "is_rushhour": tp.hour_in(hour, [7, 8, 9, 17, 18, 19]),
        "snow_flag": F.coalesce((F.col("snow") > 0).cast("int"), F.lit(0))})
    look = temp_lookup.select((F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("hour_ts"), F.col("temp").alias("temp_lag_1hr"))
    place = stations.select("station_id", F.col("lat").alias("station_lat"), F.col("lon").alias("station_lon"), F.col("dong").alias("station_dong"))
    region = context.build_region_features(stations, region_month).drop("tier")
    subway = context.subway_daily_features(stations, subway_points, subway_daily).withColumnRenamed("day", "base_date")
    x = x.join(look, "hour_ts", "left").join(place, "station_id", "left").join(region, ["station_id", "month"], "left") \
        .join(subway, ["station_id", "base_date"], "left")
    return x.fillna(0.0, subset=CONTEXT).drop("cnt", "snow", "discomfort", "hour_ts")


def hourly_station_dataset(features: DataFrame, trips: DataFrame, time_col: str = "ts") -> DataFrame:
    """Hourly features (first row per station-hour), usage = rounded departures
    of the feature stations (semi join), left joined, zero filled, and the change
    of usage from the previous hour."""
    feats = cleanse.first_by_key(features, ["station_id", time_col], [F.col(time_col)])
    ids = feats.select("station_id").distinct()
    raw = trips.select(F.col("start_id").alias("station_id"), tp.trunc("hour", time_col).alias(time_col), "cnt")
    raw = raw.join(ids, "station_id", "left_semi")
    usage = flow.key_usage(raw, ["station_id", time_col])
    out = feats.join(usage, ["station_id", time_col], "left").fillna(0, subset=["usage"])
    return windows.add_diff(out, "usage", name="delta_usage")


def forecasting_dataset(features: DataFrame, stations: DataFrame) -> DataFrame:
    """The station-hour feature frame with station metadata (capacity, region)
    and cyclic hour / weekday encodings."""
    meta = stations.select("station_id", tp.capacity("lcd", "qr").alias("capacity"), "region")
    hs, hc = tp.cyclic(F.hour("ts"), 24)
    ws, wc = tp.cyclic(F.weekday("ts"), 7)
    return features.join(bounded_broadcast(meta), "station_id", "left") \
        .withColumns({"hour_sin": hs, "hour_cos": hc, "dow_sin": ws, "dow_cos": wc})


def entry_b_train_frame(panel_df: DataFrame, selected_months: DataFrame) -> DataFrame:
    """Entry B: keep the representative months per station (C15) and attach the
    week sample weights (C13)."""
    from ..operators import profiles as pf
    x = panel_df.withColumn("month", F.month("ts"))
    kept = pf.keep_selected(x, selected_months, ["station_id", "month"])
    return pf.sample_weight(kept, pf.week_weights(panel_df, "total_flow"))


def entry_c_risk(panel_df: DataFrame) -> DataFrame:
    """Entry C: 12-hour projections from each cycle start and the priority label
    (``panel_df`` has the flows and ``capacity``)."""
    from ..operators import inventory as inv
    return inv.risk_summary(inv.projection_12h(inv.estimated_stock(panel_df, "net_flow", "capacity")))


__all__ = ["hourly_panel", "station_feature_table", "trip_station_features", "hourly_station_dataset", "forecasting_dataset",
           "entry_b_train_frame", "entry_c_risk"]
