"""Seconds per headline query, warm JVM; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores.
Arguments name the queries to run; without any, every registered one of the library runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lexloom import plans
from lexloom.session import build_session

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or list(plans.QUERIES)
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "*"))
    # one small job of each kind (scan, shuffle, Python worker) before the clock starts
    for warm in ("tokenizer_report", "batch_map"):
        plans.QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
