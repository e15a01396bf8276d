"""Headline queries on the given tables; prints one JSON line.

Each query is run to the end into a sink that keeps nothing, once to warm up and then `RUNS`
times; the fastest is reported. `rows_per_sec` is input rows by the time of the series queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dedupe_keep_first",
    "interpolate_linear",
    "gap_runs",
    "resample_first",
    "repair_resample",
    "dense_bins",
    "align_stations",
    "harvest_series",
    "harvest_series_users",
    "harvest_series_native",
    "range_bucket_join",
    "match_stations",
    "run_cast",
    "first_valid_meta",
    "attach_meta",
    "excluded_stations",
    "model_harvest",
    "backfill",
    "tide_harvest_files",
]
SERIES = ("harvest_series", "resample_first")
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from checks import load
    from gaugeloom.session import local_session

    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    queries = load()[0]
    times: dict[str, float] = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - begin)
        times[name] = round(min(took[1:]), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "rows_per_sec": {name: round(events / times[name]) for name in SERIES},
    }))


if __name__ == "__main__":
    main()
