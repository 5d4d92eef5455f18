"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads. All queries run
once to warm up the JVM, then each one ``BENCH_RUNS`` times; the median counts.
The last five are whole jobs (loads, builds, streams) rather than single plans.
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from overflight.plans.registry import QUERIES  # noqa: E402
from overflight.session import local_session  # noqa: E402

HEADLINE = (
    "stage_states",
    "region_density",
    "region_density_zero_filled",
    "daily_coverage",
    "grid_density",
    "grid_mart",
    "aircraft_points",
    "points_export",
    "density_contrast",
    "assign_box",
    "assign_box_states",
    "source_profile",
    "quality_metrics",
    "dq_results",
    "daily_health",
    "alert_timeline",
    "alert_notifications",
    "heartbeat_gaps",
    "last_not_null",
    "partition_replace",
    "stream_region_density",
    "backfill",
    "daily_build",
    "stream_ingest",
    "stream_late_reload",
    "stream_alerts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        return time.perf_counter() - start

    for name in names:
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total seconds of the headline queries after a warm-up pass",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
