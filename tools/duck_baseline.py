"""Time every oracle statement in DuckDB (single node) on one data set.

Usage: python tools/duck_baseline.py [sf_dir] -> one JSON line, seconds per key
(median of 3 after one warm-up), for comparison with bench.py.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from oracle.catalog import ORACLE
    from tests.compare import duck
    con = duck(sf_dir)
    out = {}
    for key, sql in ORACLE.items():
        con.execute(sql).fetchall()
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            runs.append(time.perf_counter() - t0)
        out[key] = round(statistics.median(runs), 4)
    print(json.dumps({"engine": "duckdb", "value": round(sum(out.values()), 4),
                      "queries": out, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
