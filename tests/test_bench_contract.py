"""bench.py prints one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF0001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_ONLY="q_churn,x_cohort",
               BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and d["metric"]
    assert set(d["queries"]) == {"q_churn", "x_cohort"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-3
    assert "errors" not in d
