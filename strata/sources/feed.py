"""Derived subscriber feed: one raw (all-string) subscriber row per order.

The test data has no subscriber table, so the raw 21-column feed is derived from ``orders`` by integer arithmetic
(identical on any SQL engine). With ``k = o_orderkey``, ``t = (k*31) % 73`` and
``c = 1825 + floor(o_totalprice) % 10051`` (cents):

customerID ``C`` + k padded to at least 10 digits; gender Female when k even; SeniorCitizen 1 when k%7=0; Partner / Dependents /
PaperlessBilling Yes when k%3 / k%5 / k%4 = 0; tenure t; PhoneService No when k%10=0; MultipleLines
``No phone service`` when k%10=0, else Yes when k%4<2; InternetService by k%9 (0-1 No, 2-4 DSL, 5-8 Fiber optic);
the six internet options ``No internet service`` when k%9<2, else Yes when (k*p)%11<5; Contract from the order
priority; PaymentMethod by k%4; MonthlyCharges c as d.dd; TotalCharges blank (" " for even k, "" for odd k) when
t=0, else c*t as d.dd; Churn Yes when the order status is F.

``dirty_feed`` injects one fault per order according to ``k % 1000`` to exercise the quality gate.

Both are narrow projections of ``orders`` (no shuffle), so they scale with the orders table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the derived feed (they define the fixture, see FIXTURES.md section 2).
OPTION_MULTIPLIERS = (
    ("OnlineSecurity", 3),
    ("OnlineBackup", 5),
    ("DeviceProtection", 7),
    ("TechSupport", 13),
    ("StreamingTV", 17),
    ("StreamingMovies", 19),
)
PAYMENT_METHODS = ("Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)")
PRIORITY_CONTRACT = {"3-MEDIUM": "One year", "4-NOT SPECIFIED": "Two year"}
DEFAULT_CONTRACT = "Month-to-month"


def _identifier(key: Column) -> Column:
    """``C`` and the key with at least ten digits; a longer key keeps all of them."""
    digits = key.cast("string")
    return F.concat(F.lit("C"), F.lpad(digits, F.greatest(F.length(digits), F.lit(10)), F.lit("0")))


def _money(cents: Column) -> Column:
    return F.format_string("%d.%02d", F.floor(cents / 100), cents % 100)


def feed_columns(orders: DataFrame) -> dict[str, Column]:
    k = F.col("o_orderkey")
    t = (k * 31) % 73
    c = F.lit(1825) + F.floor(F.col("o_totalprice")) % 10051
    no_internet = (k % 9) < 2
    options = {
        name: F.when(no_internet, F.lit("No internet service"))
        .when((k * mult) % 11 < 5, F.lit("Yes"))
        .otherwise(F.lit("No"))
        for name, mult in OPTION_MULTIPLIERS
    }
    contract = F.lit(DEFAULT_CONTRACT)
    for priority, name in reversed(PRIORITY_CONTRACT.items()):
        contract = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(contract)
    payment = F.element_at(F.array(*[F.lit(p) for p in PAYMENT_METHODS]), (k % 4 + 1).cast("int"))
    yes_if = lambda cond: F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))
    return {
        "customerID": _identifier(k),
        "gender": F.when(k % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")),
        "SeniorCitizen": F.when(k % 7 == 0, F.lit("1")).otherwise(F.lit("0")),
        "Partner": yes_if(k % 3 == 0),
        "Dependents": yes_if(k % 5 == 0),
        "tenure": t.cast("string"),
        "PhoneService": yes_if(k % 10 != 0),
        "MultipleLines": F.when(k % 10 == 0, F.lit("No phone service")).otherwise(yes_if(k % 4 < 2)),
        "InternetService": F.when(no_internet, F.lit("No"))
        .when((k % 9) < 5, F.lit("DSL"))
        .otherwise(F.lit("Fiber optic")),
        **options,
        "Contract": contract,
        "PaperlessBilling": yes_if(k % 4 == 0),
        "PaymentMethod": payment,
        "MonthlyCharges": _money(c),
        "TotalCharges": F.when(t == 0, F.when(k % 2 == 0, F.lit(" ")).otherwise(F.lit("")))
        .otherwise(_money(c * t)),
        "Churn": yes_if(F.col("o_orderstatus") == "F"),
    }


def subscriber_feed(orders: DataFrame) -> DataFrame:
    """Raw 21-column string feed, one row per order (narrow projection, no shuffle)."""
    cols = feed_columns(orders)
    return orders.select(*[cols[name].alias(name) for name in cols])


def dirty_feed(orders: DataFrame) -> DataFrame:
    """The feed with one injected fault per 1000 orders (see FIXTURES.md section 2)."""
    cols = feed_columns(orders)
    k = F.col("o_orderkey")
    r = k % 1000
    prev_id = _identifier(k - 1)
    t = (k * 31) % 73
    faults = {
        "customerID": [(r == 1, F.lit("")), (r == 12, prev_id)],
        "gender": [(r == 7, F.lit(""))],
        "Contract": [(r == 3, F.lit("Weekly"))],
        "tenure": [(r == 4, F.lit("-1"))],
        "MonthlyCharges": [(r == 5, F.lit("-5.00")), (r == 8, F.lit("abc"))],
        "TotalCharges": [((r == 6) & (t > 0), F.lit(" "))],
    }
    out = []
    for name, expr in cols.items():
        for cond, value in reversed(faults.get(name, [])):
            expr = F.when(cond, value).otherwise(expr)
        out.append(expr.alias(name))
    return orders.select(*out)
