"""Benchmark of the headline queries; prints one JSON line.

Each query runs into Spark's no-op sink, so the whole result is computed and nothing is
collected. Every query is timed once, after a warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millwright.session import local_session  # noqa: E402
from workload.registry import ALL  # noqa: E402

HEADLINE = (
    "oee_product_day", "oee_machine_day", "useful_time_detail", "stop_detail", "cycle_detail", "quality_loss_detail",
    "run_stop_intersections", "latest_line_per_key", "silver_stops_merged", "silver_cycles_merged", "gold_stops",
    "gold_stops_merged", "staged_gains", "gains_wide", "gains_long", "gains_fact", "improvements_realised",
    "adherence_fact", "target_fact", "improvements_in_progress", "log_areas", "repaired_dates", "quality_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        ALL[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
