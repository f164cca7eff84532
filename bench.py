"""Benchmark: run every registered query on $BENCH_SF_DIR and print one JSON line.

Each query is executed in full through the ``noop`` sink (all rows are
produced, nothing is collected to the driver), ``BENCH_RUNS`` times (default
3). The headline is the sum of each query's best run -- steady-state
execution, with code generation already compiled; the first (cold) run of
every query is reported alongside as ``cold_queries`` / ``cold_total``, and
the part of the time that building the plan takes as ``build_queries``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from callweave.plans.catalogue import QUERIES  # noqa: E402
from callweave.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = max(1, int(os.environ.get("BENCH_RUNS", "3")))
WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, name, sf_dir):
    """(seconds to build the plan, seconds in all)."""
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    built = time.perf_counter() - t0
    df.write.format("noop").mode("overwrite").save()
    return built, time.perf_counter() - t0


def main():
    spark = build_session(f"local[{CPUS}]", "callweave-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * CPUS)),
                          extra={"spark.driver.memory": "16g"})
    if os.path.isdir(WARMUP_DIR):
        run(spark, "flatten_calls", WARMUP_DIR)
    cold, best, build = {}, {}, {}
    for name in QUERIES:
        runs = [run(spark, name, SF_DIR) for _ in range(RUNS)]
        cold[name], best[name] = round(runs[0][1], 3), round(min(t for _, t in runs), 3)
        build[name] = round(min(b for b, _ in runs), 3)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_query_seconds_best_of_runs",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": CPUS,
        "runs": RUNS,
        "cold_total": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "build_total": round(sum(build.values()), 3),
        "build_queries": build,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
