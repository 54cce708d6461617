"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect, no
driver transfer) and timed; one JSON line is printed at the end.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Registered queries timed as they are.
HEADLINE = ["gap_enriched", "stuck_matrix", "years_to_close", "dispersion",
            "descriptive_panel", "latest_per_key", "batch_conflicts", "complete_grid",
            "coverage_span", "snapshot_rank", "tier_position", "loo_slope", "dq_report",
            "part_gap", "part_stuck_matrix", "part_years_to_close", "part_dispersion",
            "events_gap"]


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2,
                          extra={"spark.driver.memory": "16g"})
    jobs = {name: QUERIES[name] for name in HEADLINE}
    # warm-up: JVM, file listing, codegen caches
    QUERIES["gap_to_benchmark"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    timings = {}
    for name, fn in jobs.items():
        t0 = time.perf_counter()
        fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
