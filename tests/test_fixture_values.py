"""The published sf0.01 values of the derived feed (FIXTURES.md section 2), asserted directly."""

from conftest import SF01
from strata.plans import catalog


def test_executive_kpis(spark):
    row = catalog.q_executive_kpis(spark, SF01).collect()[0]
    assert tuple(row) == (15000, 4933, 32.89, 69.0, 1035026.58, 2476.8, 3.02)


def test_churn_by_contract(spark):
    got = {r["contract"]: (r["total_customers"], r["churned_customers"], r["churn_rate_pct"],
                           r["avg_monthly_charges"], r["avg_total_charges"])
           for r in catalog.q_churn_by_contract(spark, SF01).collect()}
    assert got == {
        "Month-to-month": (8977, 2943, 32.78, 69.25, 2505.81),
        "One year": (3003, 982, 32.7, 68.87, 2439.61),
        "Two year": (3020, 1008, 33.38, 68.41, 2427.55),
    }


def test_risk_levels(spark):
    got = {r["risk_level"]: (r["customers"], r["min_score"], r["max_score"])
           for r in catalog.q_risk_level_counts(spark, SF01).collect()}
    assert got == {"high": (1898, 70, 100), "medium": (7329, 40, 65), "low": (5773, 0, 35)}


def test_duplicate_lineitem_keys(spark):
    assert catalog.q_dup_keys_lineitem(spark, SF01).collect()[0]["duplicate_keys"] == 11785
