"""The command line runs every stage on explicit paths, like one job per stage."""

import hashlib
import json
import os

from pyspark.sql import functions as F

from conftest import SF001
from strata.cli import main
from strata.plans import catalog
from strata.sources.files import write_contract_csv
from strata.spec import GOLD_TABLES


def test_stage_by_stage_commands(spark, scratch):
    raw = f"{scratch}/raw"
    write_contract_csv(catalog.feed(spark, SF001).coalesce(1), raw)
    lake = f"{scratch}/lake"
    assert main(["bronze", "--input", raw, "--output", f"{lake}/bronze/customer_churn"], spark) == 0
    assert main(["quality", "--input", f"{lake}/bronze/customer_churn", "--json-output", f"{scratch}/q.json",
                 "--markdown-output", f"{scratch}/q.md"], spark) == 0
    assert json.load(open(f"{scratch}/q.json"))["failed_critical_count"] == 0
    assert main(["silver", "--input", f"{lake}/bronze/customer_churn", "--output",
                 f"{lake}/silver/customer_churn"], spark) == 0
    assert main(["gold", "--input", f"{lake}/silver/customer_churn", "--output-root",
                 f"{lake}/gold/customer_churn"], spark) == 0
    assert sorted(os.listdir(f"{lake}/gold/customer_churn")) == sorted(GOLD_TABLES)
    assert main(["verify", "--layer", "gold", "--input", f"{lake}/gold/customer_churn"], spark) == 0
    assert main(["verify", "--layer", "bronze", "--input", f"{lake}/bronze/customer_churn"], spark) == 0
    assert main(["verify", "--layer", "silver", "--input", f"{lake}/silver/customer_churn"], spark) == 0
    expected = f"{scratch}/kpis.json"
    json.dump({"total_customers": 1500, "churned_customers": 493, "overall_churn_rate_pct": 32.87}, open(expected, "w"))
    kpis = f"{lake}/gold/customer_churn/gold_executive_kpis"
    assert main(["kpi-test", "--input", kpis, "--expected", expected], spark) == 0
    json.dump({"total_customers": 7043}, open(expected, "w"))
    assert main(["kpi-test", "--input", kpis, "--expected", expected], spark) == 1
    assert main(["kpi-test", "--input", kpis, "--expected", "public-sample"], spark) == 1  # 1500 rows, not 7043
    assert main(["copy", "--src-root", lake, "--dst-root", f"{scratch}/copy"], spark) == 0
    assert main(["publish", "--root", lake, "--schema", "cli_dry"], spark) == 0
    assert main(["profile", "--input", raw, "--output", f"{scratch}/profile.md"], spark) == 0
    assert "- Row count: `1500`" in open(f"{scratch}/profile.md").read()


def test_run_admit_and_failures(spark, scratch):
    raw = f"{scratch}/raw"
    write_contract_csv(catalog.feed(spark, SF001).coalesce(1), raw)
    assert main(["admit", "--source", raw, "--destination", f"{scratch}/zone", "--expected-rows", "1500",
                 "--id-prefix", "C"], spark) == 0
    assert main(["admit", "--source", raw, "--destination", f"{scratch}/zone"], spark) == 1  # no silent overwrite
    assert main(["run", "--input", f"{scratch}/zone", "--root", f"{scratch}/lake", "--reports",
                 f"{scratch}/reports"], spark) == 0
    assert os.path.exists(f"{scratch}/reports/customer_churn_bronze_quality.md")
    pins = {n: hashlib.sha256(open(f"{raw}/{n}", "rb").read()).hexdigest() for n in os.listdir(raw) if n.endswith(".csv")}
    json.dump(pins, open(f"{scratch}/pins.json", "w"))
    admit = ["admit", "--source", raw, "--destination", f"{scratch}/pinned", "--force", "--manifest", f"{scratch}/pins.json"]
    assert main(admit, spark) == 0
    json.dump(dict.fromkeys(pins, "0" * 64), open(f"{scratch}/pins.json", "w"))
    assert main(admit, spark) == 1
    bad = catalog.feed(spark, SF001).withColumn("gender", F.lit("X"))
    write_contract_csv(bad.coalesce(1), f"{scratch}/bad")
    assert main(["run", "--input", f"{scratch}/bad", "--root", f"{scratch}/lake2"], spark) == 1
