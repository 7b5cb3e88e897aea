"""Gold values of a small feed, computed by hand: four subscribers with chosen contract, months, charge and services."""

from pyspark.sql import functions as F

from conftest import SF001
from strata.operators import gold
from strata.operators.bronze import to_bronze
from strata.operators.silver import to_silver
from strata.plans import catalog
from strata.spec import RAW_COLUMNS

# (id, contract, tenure, monthly, total, payment, internet, churn)
ROWS = [
    ("A", "Month-to-month", "1", "100.00", "100.00", "Electronic check", "Fiber optic", "Yes"),
    ("B", "Month-to-month", "0", "20.05", " ", "Mailed check", "DSL", "No"),
    ("C", "One year", "30", "50.10", "1503.00", "Bank transfer (automatic)", "DSL", "No"),
    ("D", "Two year", "72", "90.00", "6480.00", "Credit card (automatic)", "Fiber optic", "Yes"),
]


def silver(spark):
    names = ["customerID", "Contract", "tenure", "MonthlyCharges", "TotalCharges", "PaymentMethod", "InternetService",
             "Churn"]
    chosen = spark.createDataFrame(ROWS, names)
    rest = {c: F.lit("No") for c in RAW_COLUMNS if c not in names}
    rest |= {"gender": F.lit("Male"), "SeniorCitizen": F.lit("0"), "PhoneService": F.lit("Yes")}
    raw = chosen.withColumns(rest).select(*RAW_COLUMNS)
    return to_silver(to_bronze(raw, "hand", run_ts=catalog.FIXED_RUN_TS), run_ts=catalog.FIXED_RUN_TS)


def test_segments(spark):
    rows = {r["segment_value"]: tuple(r)[2:7] for r in gold.gold_aggregates_one_scan(silver(spark)).collect()}
    assert rows["Month-to-month"] == (2, 1, 50.0, 60.03, 50.0)  # 60.025 and (100 + 0) / 2
    assert rows["automatic"] == (2, 1, 50.0, 70.05, 3991.5)
    assert rows["new_customer"] == (1, 0, 0.0, 20.05, 0.0)
    assert rows["49_plus_months"] == (1, 1, 100.0, 90.0, 6480.0)


def test_kpis(spark):
    k = gold.executive_kpis(silver(spark), with_timestamp=False).first()
    # one active service each: the phone
    assert tuple(k) == (4, 2, 50.0, 65.04, 260.15, 2020.75, 1.0)


def test_risk(spark):
    rows = [(r["customer_id"], r["risk_score"], r["risk_level"])
            for r in gold.customer_risk(silver(spark), with_timestamp=False).collect()]
    # A: contract 30, months 25, charge 20, fiber 10, manual 10, services 5; D: charge 20, fiber 10, services 5
    assert rows == [("A", 100, "high"), ("B", 70, "high"), ("D", 35, "low"), ("C", 5, "low")]


def test_one_scan_equals_the_single_summaries(spark):
    sil = catalog.silver(spark, SF001)
    multi = gold.gold_aggregates_one_scan(sil)
    for by in ("contract", "tenure_band", "payment_method_group"):
        one = sorted(tuple(r) for r in gold.segment_rate_summary(sil, by, with_timestamp=False).collect())
        many = multi.where(F.col("segment") == by).select(
            "segment_value", "total_customers", "churned_customers", "churn_rate_pct", "avg_monthly_charges",
            "avg_total_charges").collect()
        assert sorted(map(tuple, many)) == one
