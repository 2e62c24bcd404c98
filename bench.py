"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full execution,
nothing collected to the driver): one warm-up, then the median of
$BENCH_REPEATS timed runs. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "query_cost_attribution", "daily_cost_rollup", "query_patterns", "team_cost_attribution",
    "idle_warehouse_periods", "warehouse_sizing_analysis", "ap_union", "storage_breakdown",
    "cost_seasonality_baseline", "all_recommendations", "alert_state_tracker", "cost_by_user",
    "weekly_executive_report", "dq_schema_report", "wl_health_scorecard", "wl_customer_segments",
    "wl_demand_signals", "wl_category_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from costlens.plans import registry
    from costlens.plans.registry import queries
    from costlens.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="costlens-bench")
    qs = queries()
    times = {}
    for name in HEADLINE:
        def run():
            registry._PIPELINES.clear()  # rebuild the plan from the raw tables every run
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm-up
        samples = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "repeats": repeats,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
