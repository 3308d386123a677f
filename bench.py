"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "group_stats",
    "calendar_stats",
    "quantile_table",
    "box_stats",
    "rate_join",
    "lag_features",
    "panel_features",
    "roll_triang",
    "ewm_features",
    "segmented_features",
    "decompose",
    "ses_grid",
    "des_grid",
    "tes_grid",
    "final_forecast",
    "arima_best",
    "sarima_best",
    "adf_test",
    "gbt_forecast",
)


def main() -> None:
    from seriesloom.plans import QUERIES
    from seriesloom.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1)), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # One small job first, so that the first query is not charged for starting up.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderpriority").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # Every row and column is computed, none is brought to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))


if __name__ == "__main__":
    main()
