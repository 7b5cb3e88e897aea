"""Expression semantics on tiny literal frames, including NULL, negative, NaN, blank, tab."""

import math

from pyspark.sql import functions as F


from strata.functions import (
    band,
    count_equal,
    is_missing,
    is_negative,
    lookup,
    outside_domain,
    round_half_up,
    rule_score,
    safe_ratio,
    threshold_band,
    yes_no_to_boolean,
)
from strata.operators.bronze import to_bronze
from strata.operators.gold import risk_level
from strata.operators.silver import (
    contract_months,
    impute_zero_when,
    monthly_charge_band,
    payment_method_group,
    tenure_band,
)
from strata.spec import RAW_COLUMNS, RAW_SCHEMA


def _raw_row(**over):
    base = {c: "Yes" for c in RAW_COLUMNS}
    base.update(customerID="A1", gender="Male", SeniorCitizen="0", tenure="5", MonthlyCharges="20.00",
                TotalCharges="100.00", Contract="One year", PaymentMethod="Mailed check", Churn="No")
    base.update(over)
    return tuple(base[c] for c in RAW_COLUMNS)


def _one(spark, schema, rows, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_yes_no_to_boolean_n4(spark):
    got = _one(spark, "v string", [("Yes",), ("No",), (None,), ("No phone service",), ("yes",)],
               yes_no_to_boolean("v"))
    assert got == [True, False, None, None, None]


def test_blank_flag_modes_n1(spark):
    rows = [_raw_row(TotalCharges=v) for v in (None, " ", "", "\t", "12.5")]
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    default = [r[0] for r in to_bronze(raw, "x").select("total_charges_was_blank").collect()]
    strict = [r[0] for r in to_bronze(raw, "x", blank_mode="strict").select("total_charges_was_blank").collect()]
    assert default == [True, True, True, False, False]  # tab survives trim (N2)
    assert strict == [None, True, True, False, False]
    totals = [r[0] for r in to_bronze(raw, "x").select("total_charges").collect()]
    assert totals == [None, None, None, None, 12.5]


def test_try_cast_under_ansi_n3(spark):
    rows = [_raw_row(tenure=v, MonthlyCharges=m) for v, m in (("5.7", "abc"), ("-1", "-5.00"), ("12", " 7 "))]
    out = to_bronze(spark.createDataFrame(rows, RAW_SCHEMA), "x").select("tenure", "monthly_charges").collect()
    assert [tuple(r) for r in out] == [(None, None), (-1, -5.0), (12, 7.0)]


def test_tenure_band_n5(spark):
    got = _one(spark, "tenure int", [(0,), (1,), (12,), (13,), (24,), (25,), (48,), (49,), (None,), (-3,)],
               tenure_band())
    assert got == ["new_customer", "1_12_months", "1_12_months", "13_24_months", "13_24_months", "25_48_months",
                   "25_48_months", "49_plus_months", "49_plus_months", "49_plus_months"]


def test_monthly_charge_band_n6(spark):
    got = _one(spark, "monthly_charges double", [(10.0,), (35.0,), (69.99,), (70.0,), (None,), (float("nan"),)],
               monthly_charge_band())
    assert got == ["low", "medium", "medium", "high", "high", "high"]


def test_contract_months_n7_and_payment_group_n8(spark):
    got = _one(spark, "contract string", [("Month-to-month",), ("One year",), ("Two year",), ("Weekly",), (None,)],
               contract_months())
    assert got == [1, 12, 24, None, None]
    got = _one(spark, "payment_method string",
               [("Bank transfer (automatic)",), ("Mailed check",), (None,), ("AUTOMATIC",)], payment_method_group())
    assert got == ["automatic", "manual", "manual", "manual"]


def test_service_count_n10_and_ratio_n11(spark):
    df = spark.createDataFrame([("Yes", "No", None), ("Yes", "Yes", "Yes")], "a string, b string, c string")
    assert [r[0] for r in df.select(count_equal(["a", "b", "c"])).collect()] == [1, 3]
    got = _one(spark, "t double, n int", [(100.0, 0), (100.0, None), (100.0, -2), (100.0, 4)], safe_ratio("t", "n"))
    assert got == [100.0, 100.0, 100.0, 25.0]


def test_imputation_n12(spark):
    got = _one(spark, "total double, tenure int", [(None, 0), (None, 3), (None, None), (5.0, 0)],
               impute_zero_when("total", "tenure"))
    assert got == [0.0, None, None, 5.0]


def test_domain_counts_null_n13_and_negative_excludes_null_nan_n14(spark):
    got = _one(spark, "v string", [("a",), ("z",), (None,)], outside_domain("v", ["a", "b"]))
    assert got == [False, True, True]
    got = _one(spark, "v double", [(-1.0,), (0.0,), (None,), (float("nan"),)], is_negative("v"))
    assert got == [True, False, None, False]


def test_missing_predicate(spark):
    got = _one(spark, "v string", [(None,), ("",), ("  ",), ("\t",), ("x",)], is_missing("v"))
    assert got == [True, True, True, False, False]
    got = _one(spark, "v string", [("\t",), (" x",)], is_missing("v", strip_all_whitespace=True))
    assert got == [True, False]


def test_rule_score_null_predicate_scores_zero(spark):
    df = spark.createDataFrame([(None, 5), (20, None), (None, None)], "a int, b int")
    got = [r[0] for r in df.select(rule_score([("a", ">", 10, 30), ("b", "<=", 5, 5)])).collect()]
    assert got == [5, 30, 0]
    assert _one(spark, "risk_score int", [(100,), (70,), (69,), (40,), (0,)], risk_level()) == [
        "high", "high", "medium", "medium", "low"]


def test_generic_bands_and_lookup(spark):
    got = _one(spark, "v int", [(1,), (5,), (6,), (None,)], band("v", [(1, 5, "a")], "z"))
    assert got == ["a", "a", "z", "z"]
    got = _one(spark, "v double", [(1.0,), (10.0,), (None,)], threshold_band("v", [(5, "lo")], "hi", op="<"))
    assert got == ["lo", "hi", "hi"]
    got = _one(spark, "v string", [("x",), ("q",)], lookup("v", {"x": 1}, default=0))
    assert got == [1, 0]


def test_round_half_up_n19(spark):
    got = _one(spark, "v double", [(1.005,), (2.675,), (-1.005,), (None,), (float("nan"),)], round_half_up("v", 2))
    assert got[:3] == [1.01, 2.68, -1.01]
    assert got[3] is None and got[4] is None
    assert not any(isinstance(g, float) and math.isnan(g) for g in got)


def test_decimal_keys_sort_as_decimals_do(spark):
    from decimal import Decimal

    from strata.functions.expr import decimal_key

    texts = ["0", "-0.0", "0e9", "1", "1.0", "+1", "01.00", "1e0", "10e-1", "1.5", "-1.5", "-1.2", "-1.23", "-1.229", "12", "-12",
             "1e400", "-1e400", "1e-400", "-1e-400", "12345678901234567.91", "12345678901234567.90", "99999999999999999999999",
             ".5", "5.", " 7 ", "-.5", "1E+3", "1e17", "1e18", "123e999999999999999", "-123e-999999999999999"]
    bad = ["", " ", "abc", "1,5", "NaN", "Infinity", "-", ".", "1e", "e5", "1d", "0x10", "1 2", "--1", "1e1234567890123456789", None]
    rows = spark.createDataFrame([(t,) for t in texts + bad], "t string").select("t", decimal_key(F.col("t")).alias("k")).collect()
    keys = {r["t"]: r["k"] for r in rows}
    assert all(keys[t] is None for t in bad)
    for a in texts:
        for b in texts:
            x, y = Decimal(a.strip()), Decimal(b.strip())
            assert (keys[a] < keys[b], keys[a] == keys[b]) == (x < y, x == y), (a, b)


def test_a_value_beyond_the_decimal_is_added_to_the_exact_sum(spark):
    from strata.functions import exact_avg, exact_sum

    df = spark.createDataFrame([(0.1,), (0.2,), (1e30,), (None,)], "v double")
    row = df.agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
    assert row["s"] == 1e30 and row["a"] == 1e30 / 3
    small = df.where("v < 1").agg(exact_sum("v").alias("s")).first()
    assert small["s"] == 0.3
