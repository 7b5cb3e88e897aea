"""bench.py prints exactly one JSON line with every chosen item timed (smoke run at sf0.001)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_complete_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_REPEATS": "1", "BENCH_CPUS": "2",
           "BENCH_ITEMS": "q_executive_kpis,q_profile_missing,q_usage_daily"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=900, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert set(result) == {"metric", "value", "unit", "queries", "sf"}
    assert result["unit"] == "sec" and result["sf"] == 0.001 and result["value"] > 0
    assert "layered_run" in result["queries"]
    assert all(isinstance(t, float) and t > 0 for t in result["queries"].values()), result["queries"]
