"""Benchmark: wall time of the headline queries at one scale factor.

Usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Each query runs its whole plan into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed warm-up query
absorbs JVM start-up and class loading.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortalloc.plans.catalog import QUERIES  # noqa: E402
from cohortalloc.session import build_session  # noqa: E402

HEADLINE = [
    "allocated_rates",
    "course_subsidy",
    "doctoral_subsidy",
    "degree_subsidy",
    "doctoral_degree_subsidy",
    "combined_course_table",
    "combined_degree_table",
    "course_reconciliation",
    "model_id_discrepancies",
    "unmatched_breakdown",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = build_session(
        app="cohortalloc-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": "16g"},
    )
    run(spark, "course_dollars", sf_dir)  # warm-up, not timed
    times = {name: round(run(spark, name, sf_dir), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
