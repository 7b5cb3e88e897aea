"""Edge semantics pinned by tests: N15, N16, N22, N23, N25, N26."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from strata.operators import profile
from strata.operators import quality as Q
from strata.operators import rulesets
from strata.operators.bronze import to_bronze
from strata.plans import catalog, publish
from strata.sources.files import read_contract_csv, write_contract_csv
from strata.spec import RAW_COLUMNS, RAW_SCHEMA

GOOD = ["A1", "Male", "0", "Yes", "No", "5", "Yes", "No", "DSL", "Yes", "No", "No", "No", "No", "No", "One year",
        "Yes", "Mailed check", "20.00", "100.00", "No"]


def _write(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_n22_failfast_count_passes_but_full_read_and_admission_catch_it(spark, scratch):
    _write(f"{scratch}/f", [",".join(RAW_COLUMNS), ",".join(GOOD), "A2,Male,0", ",".join(["A3"] + GOOD[1:] + ["x"])])
    df = read_contract_csv(spark, f"{scratch}/f")
    assert df.count() == 3  # column pruning: nothing is parsed, nothing fails
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        df.collect()
    rows = {r["name"]: r for r in publish.admit(spark, f"{scratch}/f").collect()}
    assert rows["malformed_rows"]["status"] == "FAIL" and rows["malformed_rows"]["observed_count"] == 2


def test_n23_reordered_header_is_rejected(spark, scratch):
    swapped = list(RAW_COLUMNS)
    swapped[1], swapped[2] = swapped[2], swapped[1]
    _write(f"{scratch}/h", [",".join(swapped), ",".join(GOOD)])
    with pytest.raises(Exception, match="header|Header|CSV_HEADER"):
        read_contract_csv(spark, f"{scratch}/h").collect()
    # positional reading (the reader's default) would silently accept it
    assert read_contract_csv(spark, f"{scratch}/h", enforce_header=False).count() == 1
    # in a folder of several files, every file's header is checked, not only the first one
    _write(f"{scratch}/multi", [",".join(RAW_COLUMNS), ",".join(GOOD)])
    with open(f"{scratch}/multi/second.csv", "w") as fh:
        fh.write(",".join(swapped) + "\n" + ",".join(["B1"] + GOOD[1:]) + "\n")
    with pytest.raises(Exception, match="header|Header|CSV_HEADER"):
        read_contract_csv(spark, f"{scratch}/multi").collect()


def test_n15_duplicate_count_includes_null_and_blank_groups(spark):
    df = spark.createDataFrame([(None,), (None,), ("",), ("",), ("a",), ("a",), ("b",)], "k string")
    rows = {r["name"]: r["observed_count"] for r in Q.evaluate(df, [Q.unique("k")]).collect()}
    assert rows["k_unique"] == 3
    assert profile.duplicate_keys(df, "k", ignore_blank_keys=True).collect()[0]["duplicate_keys"] == 1
    # fault-injected feed at sf0.01: 15 repeated ids + the blank group; the profiler's variant excludes blanks
    assert catalog.q_profile_feed_duplicates(spark, SF01).collect()[0]["duplicate_keys"] == 15


def test_n16_metadata_check_counts_a_row_twice(spark):
    bronze = catalog.bronze(spark, "/root/testdata/sf0.001").limit(3)
    broken = bronze.withColumn("source_file", F.lit(None).cast("string")).withColumn(
        "ingested_at_utc", F.lit(None).cast("timestamp"))
    rows = {r["name"]: r["observed_count"] for r in Q.evaluate(broken, rulesets.bronze_checks()).collect()}
    assert rows["ingestion_metadata_present"] == 6


def test_n25_numeric_junk_follows_spark_parsing(spark):
    rows = []
    for value in ("NaN", "1d", "1_0", "abc", "-0.5"):
        row = list(GOOD)
        row[18] = value
        rows.append(tuple(row))
    bronze = to_bronze(spark.createDataFrame(rows, RAW_SCHEMA), "x")
    got = [r["monthly_charges"] for r in bronze.collect()]
    assert str(got[0]) == "nan" and got[1] == 1.0 and got[2] is None and got[3] is None and got[4] == -0.5
    checks = {r["name"]: r["observed_count"] for r in Q.evaluate(bronze, rulesets.bronze_checks()).collect()}
    assert checks["monthly_charges_non_negative"] == 1  # NaN is not negative (N14)


def test_n26_csv_writer_trims_unless_told_not_to(spark, scratch):
    df = spark.createDataFrame([(" ", "x")], "a string, b string")
    df.write.option("header", True).csv(f"{scratch}/default")
    assert spark.read.option("header", True).csv(f"{scratch}/default").collect()[0]["a"] is None
    write_contract_csv(df, f"{scratch}/kept")
    assert spark.read.option("header", True).csv(f"{scratch}/kept").collect()[0]["a"] == " "


def test_dirty_feed_through_csv_in_both_blank_modes(spark, scratch):
    """FIXTURES.md section 2 through a real CSV (whitespace kept by the writer): strict mode tracks 103 + 15 blanks,
    default mode 206 + 15; Q17 reports the 15 injected blanks in both; 'abc' charges become 15 NULLs."""
    write_contract_csv(catalog.feed(spark, SF01, dirty=True), f"{scratch}/dirty")
    raw = read_contract_csv(spark, f"{scratch}/dirty")
    for mode, tracked in (("strict", 118), ("default", 221)):
        bronze = to_bronze(raw, "dirty.csv", run_ts="2024-01-01 00:00:00", blank_mode=mode)
        rows = {r["name"]: r["observed_count"] for r in Q.evaluate(bronze, rulesets.bronze_checks()).collect()}
        assert rows["blank_total_charges_tracked"] == tracked, mode
        assert rows["blank_total_charges_only_for_zero_tenure"] == 15, mode
    strict = to_bronze(raw, "dirty.csv", blank_mode="strict")
    assert strict.filter(F.col("total_charges_was_blank").isNull()).count() == 103
    assert strict.filter(F.col("monthly_charges").isNull()).count() == 15


def test_n21_source_file_literal_or_physical(spark, scratch):
    write_contract_csv(catalog.feed(spark, "/root/testdata/sf0.001").repartition(2), f"{scratch}/feed")
    raw = read_contract_csv(spark, f"{scratch}/feed")
    literal = to_bronze(raw, "given/path.csv").select("source_file").distinct().collect()
    assert [r[0] for r in literal] == ["given/path.csv"]
    physical = to_bronze(raw, source_from_metadata=True).select("source_file").distinct().collect()
    assert len(physical) == 2 and all(r[0].endswith(".csv") for r in physical)


def test_n24_one_run_timestamp_for_every_layer(spark, scratch):
    from strata.plans import flow
    from strata.plans.lake import Lake

    raw = catalog.feed(spark, "/root/testdata/sf0.001")
    flow.run_layers(spark, raw, f"{scratch}/lake", run_ts="2030-05-06 07:08:09", source_label="t")
    stamps = set()
    paths = Lake(spark, f"{scratch}/lake").paths()
    for folder, column in ((paths.bronze, "ingested_at_utc"), (paths.silver, "silver_transformed_at_utc")):
        stamps |= {r[0] for r in spark.read.parquet(folder).select(column).distinct().collect()}
    stamps |= {r[0] for r in flow.read_gold(spark, f"{scratch}/lake", "gold_executive_kpis")
               .select("gold_created_at_utc").collect()}
    assert len(stamps) == 1 and str(next(iter(stamps))) == "2030-05-06 07:08:09"


def test_n9_churn_flag_is_zero_for_anything_but_yes(spark):
    from strata.operators.silver import to_silver

    rows = []
    for value in ("Yes", "No", None, "yes", " Yes", "Y"):
        row = list(GOOD)
        row[20] = value
        rows.append(tuple(row))
    silver = to_silver(to_bronze(spark.createDataFrame(rows, RAW_SCHEMA), "x"))
    assert [r[0] for r in silver.select("churn_flag").collect()] == [1, 0, 0, 0, 1, 0]  # " Yes" is trimmed in bronze
    checks = {r["name"]: r["status"] for r in Q.evaluate(silver, rulesets.silver_validator()).collect()}
    assert checks["churn_flag_domain_valid"] == "PASS"  # the flag is never outside {0, 1}
