"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and
cores. Every query gets one warm-up and RUNS timed runs; the median counts. Building the
DataFrame is part of the time, as some operators measure their inputs while building.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from galegrid.plans.registry import QUERIES
from galegrid.session import clear_scratch, local_session

RUNS = 3
HEADLINE = [
    "label_counts",
    "hourly_align",
    "incidents_by_hour",
    "spatial_join",
    "spatial_polygons",
    "spatial_polygons_shuffled",
    "nearest_incident",
    "area_profile",
    "condition_grid",
    "label_grid",
    "training_rows",
    "table_profile",
    "wkt_roundtrip",
    "reproject",
    "feature_pages",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    clear_scratch(spark)
    return seconds


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 1)
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        runs = [timed(spark, name, sf_dir) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
    report = {
        "metric": "total of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
