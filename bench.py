"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (default 2).
Each query runs to completion through the ``noop`` sink (full plan executed, no
driver collect); the best of BENCH_REPEAT warm runs is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["ingest_file_counts", "reviews_insert", "hotels_upsert", "newest_reviews_by_platform",
            "rejects", "store_counters", "reviews_merge", "file_runs", "stream_ingest"]
# Queries over a state that a session keeps: it is built anew for each run, and counted. The read
# newest_reviews_by_platform is counted with its load as load_and_read, and alone.
ONCE = {"file_runs", "stream_ingest"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from innkeeper.plans.catalog import QUERIES
    from innkeeper.session import build_session

    spark = build_session(f"local[{cpus}]", app="innkeeper-bench", shuffle_partitions=cpus * 2)
    # Warm-up: JVM, codegen caches, parquet footers.
    QUERIES["ingest_file_counts"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    from innkeeper.plans import service, streams

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    times = {}
    for name in names:
        streams._STATES.clear()
        if name == "newest_reviews_by_platform":
            service._LOADED.clear()
            times["load_and_read"] = run(name)
        times[name] = min(run(name) for _ in range(1 if name in ONCE else repeat))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
