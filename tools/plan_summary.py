"""Summarise the physical plan of every key: shuffles and broadcasts.

Usage: python tools/plan_summary.py [data_dir] -> markdown table on stdout.
Counts come from the initial (pre-AQE) physical plan with automatic broadcasts
off, as for inputs far above the threshold: every hash or range exchange is a
shuffle the query needs; AQE may later coalesce or skip some. Stages that a key
pins while its plan is built (ranks, quantiles, similar products) are not in it.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    hashes = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    keys = sorted({re.sub(r"#\d+L?", "", h) for h in hashes})
    return {
        "hash": len(hashes), "range": plan.count("Exchange rangepartitioning"),
        "single": plan.count("Exchange SinglePartition"),
        "bhj": plan.count("BroadcastHashJoin"), "smj": plan.count("SortMergeJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin"),
        "topk": plan.count("TakeOrderedAndProject"),
        "wgl": plan.count("WindowGroupLimit"), "keys": keys,
    }


def main() -> None:
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from souk.catalog import QUERIES, WRITING_KEYS
    from souk.session import local_session
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| key | hash shuffles | range | single | BHJ | SMJ | BNLJ | top-k | group limit | shuffle keys |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for key, fn in QUERIES.items():
        if key in WRITING_KEYS:
            continue
        plan = fn(spark, data)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        keys = "; ".join(s["keys"])[:160]
        print(f"| `{key}` | {s['hash']} | {s['range']} | {s['single']} | {s['bhj']} | "
              f"{s['smj']} | {s['bnlj']} | {s['topk']} | {s['wgl']} | {keys} |")


if __name__ == "__main__":
    main()
