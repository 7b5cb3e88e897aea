"""Plan guard rails for every registered query: no broadcast, no cross / nested-loop join, no Python in the plan,
and a global sort only on top of a range exchange."""

import pytest

from conftest import SF01, plan_text
from strata.plans import catalog

# these build their result by running the layered run or an admission (they write data); their parts are planned
# by the other queries
EFFECTFUL = {"q_layers_roundtrip", "q_admission", "q_published_kpis", "q_layer_summary", "q_written_segments",
             "q_written_risk", "q_copied_silver", "q_lake_versions", "q_layer_fingerprints", "q_layer_checks",
             # files are read by tasks, and keys pass a filter there
             "q_file_checksums", "q_installed_files", "q_unique_orders", "q_unique_lineitem"}
FORBIDDEN = ("BroadcastExchange", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
             "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EFFECTFUL))
def test_plan_guard_rails(spark, name):
    plan = plan_text(catalog.QUERIES[name](spark, SF01))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    tree = plan.split("\n\n")[0]
    if any(line.lstrip(" :+-").startswith("Sort ") for line in tree.splitlines()):
        # a total order is range-partitioned (sampled bounds), never gathered into one task
        assert "rangepartitioning" in plan, name


# table scans per query: every rule, summary or aggregate family shares its scan
SCAN_BUDGET = {
    "q_quality_bronze": 2,      # all row rules + the key-uniqueness rule
    "q_quality_lineitem": 2,
    "q_churn_by_segments": 1,   # three summaries and the KPIs in one combined aggregate
    "q_executive_kpis": 1,
    "q_profile_summary": 2,     # clean and dirty feed, row count and duplicates in one grouped pass each
    "q_kpi_reconciliation": 2,  # the layers and the source table
    "q_profile_missing": 3,     # one aggregate per profiled table
    "q_profile_categories": 3,  # orders and its derived feed share one scan; part; events
}


@pytest.mark.parametrize("name", sorted(SCAN_BUDGET))
def test_scan_budget(spark, name):
    plan = plan_text(catalog.QUERIES[name](spark, SF01))
    scans = [line for line in plan.splitlines() if line.startswith("(") and " Scan " in line]
    assert len(scans) <= SCAN_BUDGET[name], (name, len(scans))
