"""The layered run end to end (S1, K1, K2, V1-V4, L1, L3), admission (K12, Q20-Q24), publication (K8-K10),
layer copy (K4) and verification (V5-V11)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.operators import quality as Q
from strata.operators import verify
from strata.plans import catalog, flow, publish
from strata.plans.lake import Lake
from strata.plans.layers import LayerPaths, copy_layers
from strata.sources.files import file_checksums, read_contract_csv, write_contract_csv
from strata.spec import BRONZE_COLUMNS, GOLD_TABLES


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landing"))
    write_contract_csv(catalog.feed(spark, SF001).coalesce(1), f"{base}/feed")
    return base


def _gold_values(spark, root, table):
    df = flow.read_gold(spark, root, table).drop("gold_created_at_utc")
    return sorted(tuple(r) for r in df.collect())


def test_run_layers_matches_direct_gold_and_is_idempotent(spark, landing, scratch):
    root = f"{scratch}/data"
    reports = f"{scratch}/reports"
    summary = flow.run_layers(spark, f"{landing}/feed", root, json_report=f"{reports}/q.json",
                              markdown_report=f"{reports}/q.md", checks_table=f"{scratch}/checks")
    assert summary.bronze_rows == summary.silver_rows == 1500
    assert summary.quality.passed
    assert set(summary.gold_rows) == set(GOLD_TABLES)
    # CSV round trip: "" TotalCharges cells come back NULL, " " cells stay blank -> default mode tracks both
    direct = catalog.q_executive_kpis(spark, SF001).collect()[0]
    kpis = flow.read_gold(spark, root, "gold_executive_kpis").collect()
    assert len(kpis) == 1
    assert tuple(kpis[0])[:7] == tuple(direct)
    # written order (one sorted file for a small summary) equals the O1 ordering
    in_file = [r["contract"] for r in flow.read_gold(spark, root, "gold_churn_by_contract").collect()]
    assert in_file == [r["contract"] for r in catalog.q_churn_by_contract(spark, SF001).collect()]
    contract = _gold_values(spark, root, "gold_churn_by_contract")
    assert contract == sorted(tuple(r) for r in catalog.q_churn_by_contract(spark, SF001).collect())
    # V11 on the written JSON report
    assert verify.report_regression(spark, f"{reports}/q.json", "bronze.customer_churn", 25) == []
    assert "| customer_id_unique | uniqueness | critical | PASS | 0 |" in open(f"{reports}/q.md").read()
    # Complete by commit marker, both ways
    paths = Lake(spark, root).paths()
    expected_tables = [n for n, _, _ in paths.registry()]
    assert verify.layer_completeness(spark, root, expected_tables) == [(n, "complete") for n in sorted(expected_tables)]
    states = dict(verify.layer_completeness(spark, root, [*expected_tables[1:], "gold_other"]))
    assert states["bronze_customer_churn"] == "unexpected" and states["gold_other"] == "missing"
    # L3: a second run gives the same tables; the check table keeps one set of 19 rows per run
    before = {t: _gold_values(spark, root, t) for t in GOLD_TABLES}
    flow.run_layers(spark, f"{landing}/feed", root, checks_table=f"{scratch}/checks")
    checks = spark.read.parquet(f"{scratch}/checks")
    assert checks.count() == 38 and checks.select("run_id").distinct().count() == 2
    assert {t: _gold_values(spark, root, t) for t in GOLD_TABLES} == before
    commits = Lake(spark, root).commits()
    assert [c.number for c in commits] == [1, 2] and commits[0].fingerprints == commits[1].fingerprints
    assert spark.read.parquet(paths.bronze).columns == list(BRONZE_COLUMNS)
    assert len(spark.read.parquet(paths.silver).columns) == 38


def test_gate_writes_reports_then_stops(spark, scratch):
    # a domain fault only (keys stay clean, so the bronze validator passes and the gate decides)
    raw = catalog.feed(spark, SF001).withColumn(
        "Contract", F.when(F.col("customerID").endswith("7"), F.lit("Weekly")).otherwise(F.col("Contract")))
    root = f"{scratch}/data"
    with pytest.raises(Q.QualityGateError):
        flow.run_layers(spark, raw, root, json_report=f"{scratch}/q.json", source_label="test")
    report = json.load(open(f"{scratch}/q.json"))
    assert report["failed_critical_count"] == 1
    failed = [c for c in report["checks"] if c["status"] == "FAIL"]
    assert [c["name"] for c in failed] == ["contract_domain_valid"] and failed[0]["observed_value"] == 150
    assert Lake(spark, root).current() is None and not os.path.exists(LayerPaths(root).silver)


def test_bronze_validator_stops_before_silver(spark, scratch):
    raw = catalog.feed(spark, SF001).withColumn("customerID", F.lit("same"))
    root = f"{scratch}/data"
    with pytest.raises(flow.LayerValidationError, match="customer_id_unique"):
        flow.run_layers(spark, raw, root, json_report=f"{scratch}/q.json", source_label="test")
    report = json.load(open(f"{scratch}/q.json"))
    assert {c["name"]: c["observed_value"] for c in report["checks"]}["customer_id_unique"] == 1
    assert not os.path.exists(LayerPaths(root).silver)


def test_admission_and_no_silent_overwrite(spark, landing, scratch):
    rows = {r["name"]: r for r in publish.admit(spark, f"{landing}/feed", expected_rows=1500, id_prefix="C").collect()}
    assert all(r["status"] == "PASS" for r in rows.values())
    bad = {r["name"]: r for r in publish.admit(spark, f"{landing}/feed", expected_rows=7, id_prefix="SYNTH-").collect()}
    assert bad["expected_row_count"]["status"] == "FAIL" and bad["id_prefix"]["observed_count"] == 1500
    # one of two files has its header reordered
    swapped = catalog.feed(spark, SF001).select("gender", "customerID", *[c for c in read_contract_csv(
        spark, f"{landing}/feed").columns if c not in ("gender", "customerID")])
    write_contract_csv(swapped.coalesce(1), f"{scratch}/two/part-b")
    write_contract_csv(catalog.feed(spark, SF001).coalesce(1), f"{scratch}/two/part-a")
    hdr = {r["name"]: r for r in publish.admit(spark, f"{scratch}/two/part-*").collect()}["header_matches_contract"]
    assert hdr["status"] == "FAIL" and hdr["observed_count"] == 1
    # promote twice: the second refuses without force
    dest = f"{scratch}/raw/customer_churn"
    assert publish.promote(spark, f"{landing}/feed", dest) == 1500
    with pytest.raises(FileExistsError, match="Refusing to overwrite"):
        publish.promote(spark, f"{landing}/feed", dest)
    assert publish.promote(spark, f"{landing}/feed", dest, force=True) == 1500


def _status(spark, path, checksum):
    return {r["name"]: r["status"] for r in publish.admit(spark, path, checksum=checksum).collect()}["checksum_matches"]


def test_checksums_hash_exactly_the_landing_files(spark, landing, scratch):
    import hashlib
    import shutil

    sums = file_checksums(spark, f"{landing}/feed").collect()
    for r in sums:
        local = r["path"].replace("file:", "")
        assert hashlib.sha256(open(local, "rb").read()).hexdigest() == r["sha256"]
    pinned = sums[0]["sha256"]
    assert _status(spark, f"{landing}/feed", pinned) == "PASS"
    # a file of another name is hashed too: no pass without a hash
    os.makedirs(f"{scratch}/text")
    shutil.copy(sums[0]["path"].replace("file:", ""), f"{scratch}/text/a.txt")
    assert _status(spark, f"{scratch}/text/a.txt", "deadbeef") == "FAIL"
    assert _status(spark, f"{scratch}/text/a.txt", pinned) == "PASS"
    # a folder of two files needs a manifest; a pin without a file fails
    shutil.copy(f"{scratch}/text/a.txt", f"{scratch}/text/b.txt")
    assert _status(spark, f"{scratch}/text", pinned) == "FAIL"
    assert _status(spark, f"{scratch}/text", {"a.txt": pinned, "b.txt": pinned}) == "PASS"
    assert _status(spark, f"{scratch}/text", {"a.txt": pinned, "b.txt": "00"}) == "FAIL"
    assert _status(spark, f"{scratch}/text", {n: pinned for n in ("a.txt", "b.txt", "c.txt")}) == "FAIL"
    # tables that are folders of part files are listed too
    spark.range(10).repartition(3).write.parquet(f"{scratch}/tables/t.parquet")
    assert file_checksums(spark, f"{scratch}/tables", glob="*.parquet").count() == 3


def test_install_keeps_the_bytes_and_a_failing_install_keeps_the_old_file(spark, landing, scratch):
    import hashlib

    def digests(folder):
        return sorted(hashlib.sha256(open(f"{folder}/{n}", "rb").read()).hexdigest()
                      for n in os.listdir(folder) if n.endswith(".csv"))

    zone = f"{scratch}/zone/customer_churn"
    publish.promote(spark, f"{landing}/feed", zone)
    assert digests(zone) == digests(f"{landing}/feed")
    with pytest.raises(publish.AdmissionError, match="expected_row_count"):
        publish.promote(spark, f"{landing}/feed", zone, force=True, expected_rows=7)
    assert digests(zone) == digests(f"{landing}/feed")
    assert os.listdir(f"{scratch}/zone") == ["customer_churn"]


def test_publish_discover_copy(spark, landing, scratch):
    root = f"{scratch}/data"
    flow.run_layers(spark, f"{landing}/feed", root)
    found = publish.discover_tables(spark, root)
    assert {n for n, _, _ in found} == {"bronze_customer_churn", "silver_customer_churn", *GOLD_TABLES}
    assert [n for n, _, _ in publish.discover_tables(spark, root, scope="gold")] == sorted(GOLD_TABLES)
    plan = publish.publish(spark, found, "churn_dry", dry_run=True)
    assert [p["table"] for p in plan[1:]] == sorted(GOLD_TABLES)  # gold only by default
    assert all(p["action"].startswith("would_") for p in plan)
    assert publish.quote_identifier("a`b") == "`a``b`"
    publish.publish(spark, found, "churn_pub", scope="gold", dry_run=False)
    kpis = spark.sql("SELECT total_customers FROM churn_pub.gold_executive_kpis").collect()
    assert kpis[0][0] == 1500
    views = publish.register_temp_views(spark, found, scope="silver")
    assert views == ["silver_customer_churn"]
    assert spark.sql("SELECT count(*) FROM silver_customer_churn").collect()[0][0] == 1500
    copied = copy_layers(spark, Lake(spark, root).paths(), LayerPaths(f"{scratch}/copy"))
    assert {c["table"]: c["rows"] for c in copied}["silver_customer_churn"] == 1500


def test_preview_is_a_limit(spark):
    bronze = catalog.bronze(spark, SF001)
    rows = verify.preview(bronze, verify.PREVIEW_COLUMNS["bronze"]).collect()
    assert len(rows) == 5 and list(rows[0].asDict()) == verify.PREVIEW_COLUMNS["bronze"]
    assert len(verify.preview(bronze, n=3).collect()[0]) == 25


def test_registering_a_partitioned_layer_finds_its_rows(spark, scratch):
    table = f"{scratch}/lake/gold/customer_churn/by_contract"
    catalog.q_churn_by_contract(spark, SF001).write.partitionBy("contract").parquet(table)
    found = publish.discover_tables(spark, f"{scratch}/lake")
    assert [(n, layer) for n, layer, _ in found] == [("by_contract", "gold")]
    publish.publish(spark, found, "churn_parts", dry_run=False)
    assert spark.table("churn_parts.by_contract").count() == 3


def test_unfinished_folders_are_not_complete(spark, scratch):
    folder = f"{scratch}/lake/silver/customer_churn"
    spark.range(3).write.parquet(folder)
    assert verify.layer_completeness(spark, f"{scratch}/lake", ["silver_customer_churn"]) == [
        ("silver_customer_churn", "complete")]
    os.remove(f"{folder}/_SUCCESS")
    assert verify.layer_completeness(spark, f"{scratch}/lake", ["silver_customer_churn"]) == [
        ("silver_customer_churn", "missing")]


def test_kpi_comparison_and_assertion(spark):
    actual = catalog.q_executive_kpis(spark, SF001).select("total_customers", "avg_monthly_charges")
    expected = spark.range(1).select(F.lit(1500).alias("total_customers"), F.lit(68.885).alias("avg_monthly_charges"))
    rows = {r["metric"]: r["passed"] for r in verify.kpi_comparison(actual, expected).collect()}
    assert rows == {"row_count": True, "total_customers": True, "avg_monthly_charges": True}
    # a metric that one side lacks fails, and so does a second row
    rows = {r["metric"]: r["passed"] for r in verify.kpi_comparison(actual.drop("avg_monthly_charges"), expected)
            .collect()}
    assert rows == {"row_count": True, "total_customers": True, "avg_monthly_charges": False}
    twice = {r["metric"]: r["passed"] for r in verify.kpi_comparison(actual.unionByName(actual), expected).collect()}
    assert not twice["row_count"]
    verify.assert_kpis(catalog.q_executive_kpis(spark, SF001), {"total_customers": 1500, "churned_customers": 493})
    with pytest.raises(AssertionError, match="overall_churn_rate_pct"):
        verify.assert_kpis(catalog.q_executive_kpis(spark, SF001), {"overall_churn_rate_pct": 99.0})
    with pytest.raises(AssertionError, match="no_such_kpi"):
        verify.assert_kpis(actual, {"total_customers": 1500, "no_such_kpi": 1})


def test_profile_report(spark, landing):
    from strata.plans.reports import build_profile_report
    from strata.spec import RAW_COLUMNS

    raw = read_contract_csv(spark, f"{landing}/feed")
    text = build_profile_report(
        raw, f"{landing}/feed", RAW_COLUMNS, "customerID",
        ["gender", "SeniorCitizen", "Contract", "InternetService", "PaymentMethod", "Churn"],
        ["tenure", "MonthlyCharges", "TotalCharges"],
        ["customerID", "tenure", "MonthlyCharges", "TotalCharges", "Churn"],
    )
    assert "- Row count: `1500`" in text
    assert "- Missing expected columns: `None`" in text
    assert "- Duplicate `customerID` values: `0`" in text
    assert "| TotalCharges | 21 |" in text  # tenure-0 rows: blank or empty totals (NULL after the CSV reader)
    assert "| Month-to-month |" in text and "## Sample Rows" in text


def test_partition_ordered_risk_table(spark, landing, scratch):
    root = f"{scratch}/data"
    flow.run_layers(spark, f"{landing}/feed", root, risk_order="partition")
    risk = flow.read_gold(spark, root, "gold_customer_risk_summary")
    assert risk.count() == 1500
    expected = sorted(tuple(r) for r in catalog.q_customer_risk(spark, SF001).collect())
    assert sorted(tuple(r) for r in risk.drop("gold_created_at_utc").collect()) == expected
    with pytest.raises(ValueError):
        flow.build_gold(spark, Lake(spark, root).paths(), risk_order="random")


def test_layered_run_job_budget(spark, landing, scratch):
    """BASELINE target: the whole run within 15 Spark actions. Measured as jobs with AQE off (with AQE on, every
    shuffle stage is submitted as its own job)."""
    sc = spark.sparkContext
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sc.setJobGroup("layered-run-budget", "layered run job budget")
        flow.run_layers(spark, f"{landing}/feed", f"{scratch}/data")
        jobs = sc.statusTracker().getJobIdsForGroup("layered-run-budget")
    finally:
        sc.setJobGroup("", "")
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    assert len(jobs) <= 15, len(jobs)


def test_failing_run_keeps_the_previous_bronze(spark, landing, scratch):
    def content(folder):
        return sorted((n, open(f"{folder}/{n}", "rb").read()) for n in os.listdir(folder) if n.endswith(".parquet"))

    root = f"{scratch}/data"
    flow.run_layers(spark, f"{landing}/feed", root)
    before = content(Lake(spark, root).paths().bronze)
    bad = catalog.feed(spark, SF001).withColumn("Contract", F.lit("Weekly"))
    with pytest.raises(Q.QualityGateError):
        flow.run_layers(spark, bad, root, source_label="bad")
    assert content(Lake(spark, root).paths().bronze) == before
    assert all(not name.startswith("_") for name, _, _ in publish.discover_tables(spark, root))


def test_profile_report_layout(spark, landing):
    from strata.plans.reports import build_profile_report
    from strata.spec import RAW_COLUMNS

    raw = read_contract_csv(spark, f"{landing}/feed")
    text = build_profile_report(raw, "feed.csv", RAW_COLUMNS, "customerID", ["Contract", "Churn"],
                                ["tenure", "MonthlyCharges", "TotalCharges"],
                                ["customerID", "tenure", "MonthlyCharges", "TotalCharges", "Churn"])
    lines = text.splitlines()
    headings = [line for line in lines if line.startswith("#")]
    assert headings == ["# Customer Churn Raw Data Profile", "## Schema Check", "## Missing Values",
                        "## Duplicate Customer IDs", "## Numeric Checks", "## Category Distributions",
                        "### Contract", "### Churn", "## Sample Rows"]
    assert "| Column | Invalid/blank numeric values | Negative values | Min | Max |" in lines
    assert "| --- | ---: | ---: | ---: | ---: |" in lines
    assert sum(1 for line in lines if line.startswith("| C0")) == 5  # five sample rows
    assert "| tenure | 0 | 0 | 0 | 72 |" in lines  # numeric checks row
    assert "| tenure | 0 |" in lines  # missing-values row


def test_discovery_of_a_delta_shaped_layout(spark, scratch):
    """A Delta table folder holds Parquet data files plus a hidden _delta_log (with checkpoint Parquet files):
    discovery finds the table by its log and never looks for tables inside it."""
    root = f"{scratch}/delta_root"
    table = f"{root}/gold/customer_churn/gold_executive_kpis"
    catalog.q_executive_kpis(spark, SF001).write.parquet(table)
    os.remove(f"{table}/_SUCCESS")
    os.makedirs(f"{table}/_delta_log")
    spark.range(3).write.parquet(f"{table}/_delta_log/00000000000000000010.checkpoint.parquet")
    found = publish.discover_tables(spark, root)
    assert [(name, layer) for name, layer, _ in found] == [("gold_executive_kpis", "gold")]
    assert found[0][2].rstrip("/").endswith("gold/customer_churn/gold_executive_kpis")


def test_profile_report_with_more_categories_than_a_page_lists(spark, scratch, monkeypatch):
    from strata.plans import reports

    monkeypatch.setattr(reports, "LISTED_CATEGORIES", 3)
    rows = [(f"c{i:03d}", "12345678901234567.91" if i else "-1e400") for i in range(40)] + [("c007", " 5")]
    raw = spark.createDataFrame(rows, "Contract string, TotalCharges string")
    folder = f"{scratch}/report.md.categories"
    text = reports.build_profile_report(raw, "x", ["Contract", "TotalCharges"], "Contract", ["Contract"], ["TotalCharges"],
                                        ["Contract"], categories_path=folder)
    assert "| TotalCharges | 0 | 1 | -1e400 | 12345678901234567.91 |" in text
    assert "| c007 | 2 |\n| c000 | 1 |\n| c001 | 1 |\n| (more values) |" in text and folder in text
    listed = spark.read.option("header", True).csv(folder)
    assert listed.count() == 40 and listed.agg(F.sum("row_count")).first()[0] == 41
