"""Time the registered queries; print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs per query, default 3; the median is reported),
BENCH_SHUFFLE_PARTITIONS (default: BENCH_CPUS), BENCH_ONLY (comma-separated keys).
Each query runs to completion through Spark's ``noop`` sink, so the whole plan
executes (every row produced) without shipping rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "0")) or None

    from souk.catalog import QUERIES
    from souk.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=parts)
    keys = only or list(QUERIES)
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for key in keys:
        fn = QUERIES[key]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            run()  # warm-up: JIT, file listing and metadata caches
            times[key] = round(statistics.median(run() for _ in range(repeat)), 4)
        except Exception as exc:  # report the key, keep timing the others
            errors[key] = str(exc).splitlines()[0][:300]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 4),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
