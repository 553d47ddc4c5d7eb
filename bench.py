"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` (default 8) over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Every query is executed
in full with the ``noop`` sink (nothing is collected to the driver).  After
one warm-up query each query runs once cold and up to ``$BENCH_REPEAT`` times
(default 5) warm; it is not repeated further once it has taken a minute in all.
``queries`` holds the warm medians, ``value`` their sum, ``cold`` the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from staykit.plans.catalog import REGISTRY  # noqa: E402
from staykit.session import local_session  # noqa: E402

HEADLINE = (
    "kpi_region_month",
    "kpi_segment_month",
    "kpi_host_region_month",
    "star_fact",
    "star_owner",
    "csv_snapshot_scan",
    "load_snapshots",
    "end_to_end_region_kpi",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "5")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus)
    run_once(spark, "star_census", sf_dir)  # warm-up: JVM, codegen caches
    times, cold = {}, {}
    for name in only or HEADLINE:
        cold[name] = round(run_once(spark, name, sf_dir), 3)
        warm: list[float] = []
        while not warm or len(warm) < repeat and cold[name] + sum(warm) < 60:
            warm.append(run_once(spark, name, sf_dir))
        times[name] = round(median(warm), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
