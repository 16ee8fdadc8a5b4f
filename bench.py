"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:
{"metric": ..., "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full through the ``noop`` sink (the whole plan
runs, nothing is collected): one warm-up run, then the median of
``$BENCH_REPEAT`` (default 3) timed runs. Landing, the end-to-end job and the
stream, which write tables, are timed once.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabflow.plans.registry import QUERIES, _fx, _zones_csv  # noqa: E402
from cabflow.session import build_session  # noqa: E402

HEADLINE = [
    "trips_by_borough",
    "trips_by_hour",
    "top_pickup_zones",
    "total_trips",
    "top10_pickup_zones",
    "top50_rejected_by_amount",
    "monthly_trip_counts",
    "reconciliation",
    "stg_trips",
    "enriched_preview",
    "period_coverage",
    "profile_metrics",
    "profile_null_values",
    "profile_duplicate_rows",
    "inspect_numeric_stats",
    "raw_expectations",
    "model_tests",
]
ONCE = ["raw_layout_month_counts", "pipeline_run", "incremental_tables_by_month"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name][0](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="cabflow-bench",
        shuffle_partitions=int(cpus),
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)  # warm-up: JIT, file listing, broadcast probes
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    # Landing is timed with its count, then the job and the stream over what it
    # landed; the zone CSV they read is setup.
    _zones_csv(_fx(spark, sf_dir))
    for name in ONCE:
        times[name] = round(run(spark, name, sf_dir), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
