"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print
one JSON line with the seconds per query.

Each query is executed in full through the ``noop`` sink (every row computed, none
collected). A small warm-up run on sf0.001 keeps JVM start-up out of the numbers.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationflow.plans.catalog import load_all  # noqa: E402
from stationflow.session import build_session  # noqa: E402

HEADLINE = [
    "g1_hourly_flow_panel",       # trips -> roles -> hourly flow -> dense panel -> lags
    "a21_key_usage",              # large origin-destination aggregate (lineitem scale)
    "a16_month_weekday_profile",  # month profiles over the large table
    "c02_month_pair_similarity",  # profile pairs, Pearson + cosine
    "w03_trailing_stats",         # guarded rolling windows
    "i03_simulate_stock",         # two-barrier clamp per station-day
    "i06_carried_refill",         # closed-form carried refill over cycles
    "g12_region_features",        # grid range join + three-tier match
    "x01_corr_pairs",             # correlation matrix in one pass
    "m02_split_by_ratio",         # row-ratio split without a global window
    "x14_cv_transform_choice",    # per-fold regressions for all features at once
    "st1_stream_hourly_flow",     # structured streaming, availableNow
    "m04_split_time_quantile",    # exact time quantile from counts per value
    "i05_cycle_need",             # lowest prefix per cycle, minute by minute
    "j12_substring_match",        # rarest-gram match
    "m26_per_station_vs_pooled",  # the same ridge apart and pooled from one pass of moments
    "m28_flow_models_stock_choice",
    "x18_rfe_cv",                 # recursive elimination, nested folds, all features
    "x20_permutation_importance",  # all shuffles from one sort
    "i12_live_summary",           # recursive projection as one fold
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    reg = load_all()
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        reg["g1_hourly_flow_panel"].build(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
