"""A hot key holding a third of the rows must not land in one reduce task: measured from Spark's event log
(shuffle records read per task) in a separate session with partition coalescing off."""

import json
import os
import subprocess
import sys

from conftest import SF01

HERE = os.path.dirname(os.path.abspath(__file__))


def test_hot_key_and_few_sort_values_stay_balanced(scratch):
    out = subprocess.run([sys.executable, os.path.join(HERE, "skew_probe.py"), SF01, scratch],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    probe = json.loads(out.strip().splitlines()[-1])
    assert probe["hot_rows"] >= 0.3 * probe["total_rows"]  # about a third of all rows share one key
    assert probe["dup"]["k_unique"] > 0
    reduce_stages = [s for s in probe["stages"].values() if s["group"] in ("dup", "sort") and s["tasks"] > 1]
    assert {s["group"] for s in reduce_stages} == {"dup", "sort"}
    for s in reduce_stages:
        assert s["max"] <= 1.5 * s["mean"], s
        assert s["max"] < probe["hot_rows"], s  # the hot group never reaches one task whole
