"""Independent SQL for every compared query, runnable by DuckDB on the driver's parquet views.

Written by hand (not generated from the Spark plans) so the comparison checks the semantics twice. Hygiene:
``sum``/``count_if`` are cast to BIGINT (DuckDB yields HUGEINT), rounding starts from a double's shortest decimal
form, timestamps and paths are left out.
"""

from __future__ import annotations

# rounding HALF_UP from the shortest decimal form of a double
R2 = "CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,16)), 2) AS DOUBLE)"


def r2(x: str) -> str:
    return R2.format(x=x)


def _sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,10))) AS DOUBLE)"


def _avg(x: str) -> str:
    return f"{_sum(x)} / count({x})"


def _money(x: str) -> str:
    return f"(CAST({x} // 100 AS VARCHAR) || '.' || lpad(CAST({x} % 100 AS VARCHAR), 2, '0'))"


def _yes(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"


def _option(mult: int) -> str:
    return (f"CASE WHEN k % 9 < 2 THEN 'No internet service' WHEN (k * {mult}) % 11 < 5 THEN 'Yes' "
            f"ELSE 'No' END")


# --- raw feed (clean and fault-injected), bronze, silver, risk as CTEs --------------------------------------


FEED_BASE = f"""
feed_src AS (
  SELECT o_orderkey AS k, o_orderstatus, o_orderpriority,
         (o_orderkey * 31) % 73 AS t,
         1825 + CAST(floor(o_totalprice) AS BIGINT) % 10051 AS c
  FROM orders
),
feed_clean AS (
  SELECT k, t,
    'C' || CASE WHEN k >= 10000000000 THEN CAST(k AS VARCHAR) ELSE printf('%010d', k) END AS customerID,
    CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN k % 7 = 0 THEN '1' ELSE '0' END AS SeniorCitizen,
    {_yes('k % 3 = 0')} AS Partner,
    {_yes('k % 5 = 0')} AS Dependents,
    CAST(t AS VARCHAR) AS tenure,
    {_yes('k % 10 <> 0')} AS PhoneService,
    CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN k % 4 < 2 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE WHEN k % 9 < 2 THEN 'No' WHEN k % 9 < 5 THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
    {_option(3)} AS OnlineSecurity,
    {_option(5)} AS OnlineBackup,
    {_option(7)} AS DeviceProtection,
    {_option(13)} AS TechSupport,
    {_option(17)} AS StreamingTV,
    {_option(19)} AS StreamingMovies,
    CASE o_orderpriority WHEN '3-MEDIUM' THEN 'One year' WHEN '4-NOT SPECIFIED' THEN 'Two year'
         ELSE 'Month-to-month' END AS Contract,
    {_yes('k % 4 = 0')} AS PaperlessBilling,
    CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
    {_money('c')} AS MonthlyCharges,
    CASE WHEN t = 0 THEN (CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END) ELSE {_money('c * t')} END AS TotalCharges,
    {_yes("o_orderstatus = 'F'")} AS Churn
  FROM feed_src
)"""

RAW = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
       "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
       "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges",
       "TotalCharges", "Churn"]

FEED_CLEAN = f"feed AS (SELECT {', '.join(RAW)} FROM feed_clean)"

FEED_DIRTY = """
feed AS (
  SELECT
    CASE WHEN k % 1000 = 1 THEN '' WHEN k % 1000 = 12 THEN 'C' || CASE WHEN k > 10000000000 THEN CAST(k - 1 AS VARCHAR) ELSE printf('%010d', k - 1) END
         ELSE customerID END AS customerID,
    CASE WHEN k % 1000 = 7 THEN '' ELSE gender END AS gender,
    SeniorCitizen, Partner, Dependents,
    CASE WHEN k % 1000 = 4 THEN '-1' ELSE tenure END AS tenure,
    PhoneService, MultipleLines, InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport,
    StreamingTV, StreamingMovies,
    CASE WHEN k % 1000 = 3 THEN 'Weekly' ELSE Contract END AS Contract,
    PaperlessBilling, PaymentMethod,
    CASE WHEN k % 1000 = 5 THEN '-5.00' WHEN k % 1000 = 8 THEN 'abc' ELSE MonthlyCharges END AS MonthlyCharges,
    CASE WHEN k % 1000 = 6 AND t > 0 THEN ' ' ELSE TotalCharges END AS TotalCharges,
    Churn
  FROM feed_clean
)"""

BRONZE = """
bronze AS (
  SELECT
    trim(customerID) AS customer_id,
    trim(gender) AS gender,
    TRY_CAST(trim(SeniorCitizen) AS INTEGER) AS senior_citizen,
    trim(Partner) AS partner,
    trim(Dependents) AS dependents,
    TRY_CAST(trim(tenure) AS INTEGER) AS tenure,
    trim(PhoneService) AS phone_service,
    trim(MultipleLines) AS multiple_lines,
    trim(InternetService) AS internet_service,
    trim(OnlineSecurity) AS online_security,
    trim(OnlineBackup) AS online_backup,
    trim(DeviceProtection) AS device_protection,
    trim(TechSupport) AS tech_support,
    trim(StreamingTV) AS streaming_tv,
    trim(StreamingMovies) AS streaming_movies,
    trim(Contract) AS contract,
    trim(PaperlessBilling) AS paperless_billing,
    trim(PaymentMethod) AS payment_method,
    TRY_CAST(trim(MonthlyCharges) AS DOUBLE) AS monthly_charges,
    TRY_CAST(nullif(trim(TotalCharges), '') AS DOUBLE) AS total_charges,
    trim(Churn) AS churn,
    trim(TotalCharges) AS total_charges_raw,
    coalesce(trim(TotalCharges), '') = '' AS total_charges_was_blank,
    'derived:orders' AS source_file,
    TIMESTAMP '2024-01-01 00:00:00' AS ingested_at_utc
  FROM feed
)"""


def _yn(c: str) -> str:
    return f"CASE {c} WHEN 'Yes' THEN true WHEN 'No' THEN false END"


_CLEAN_TOTAL = "CASE WHEN total_charges IS NULL AND tenure = 0 THEN 0.0 ELSE total_charges END"

SILVER = f"""
silver AS (
  SELECT
    customer_id, gender, senior_citizen, partner, dependents, tenure, phone_service, multiple_lines,
    internet_service, online_security, online_backup, device_protection, tech_support, streaming_tv,
    streaming_movies, contract, paperless_billing, payment_method, monthly_charges, churn, total_charges_raw,
    total_charges_was_blank, source_file, ingested_at_utc,
    {_CLEAN_TOTAL} AS total_charges,
    {_yn('partner')} AS is_partner,
    {_yn('dependents')} AS is_dependents,
    {_yn('phone_service')} AS is_phone_service,
    {_yn('paperless_billing')} AS is_paperless_billing,
    senior_citizen = 1 AS is_senior_citizen,
    CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS churn_flag,
    CASE WHEN tenure = 0 THEN 'new_customer' WHEN tenure BETWEEN 1 AND 12 THEN '1_12_months'
         WHEN tenure BETWEEN 13 AND 24 THEN '13_24_months' WHEN tenure BETWEEN 25 AND 48 THEN '25_48_months'
         ELSE '49_plus_months' END AS tenure_band,
    CASE WHEN monthly_charges < 35 THEN 'low' WHEN monthly_charges < 70 THEN 'medium' ELSE 'high' END
      AS monthly_charge_band,
    CASE contract WHEN 'Month-to-month' THEN 1 WHEN 'One year' THEN 12 WHEN 'Two year' THEN 24 END
      AS contract_months,
    CASE WHEN contains(payment_method, 'automatic') THEN 'automatic' ELSE 'manual' END AS payment_method_group,
    (CASE WHEN phone_service = 'Yes' THEN 1 ELSE 0 END + CASE WHEN online_security = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN online_backup = 'Yes' THEN 1 ELSE 0 END + CASE WHEN device_protection = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN tech_support = 'Yes' THEN 1 ELSE 0 END + CASE WHEN streaming_tv = 'Yes' THEN 1 ELSE 0 END
     + CASE WHEN streaming_movies = 'Yes' THEN 1 ELSE 0 END) AS active_service_count,
    ({_CLEAN_TOTAL}) / greatest(tenure, 1) AS average_charge_per_tenure_month
  FROM bronze
)"""

RISK = """
risk AS (
  SELECT customer_id, gender, senior_citizen, tenure, tenure_band, contract, payment_method_group,
    internet_service, monthly_charges, monthly_charge_band, total_charges, active_service_count, churn, churn_flag,
    score AS risk_score,
    CASE WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'medium' ELSE 'low' END AS risk_level
  FROM (
    SELECT *,
      (CASE WHEN contract = 'Month-to-month' THEN 30 ELSE 0 END
       + CASE WHEN tenure <= 12 THEN 25 ELSE 0 END
       + CASE WHEN monthly_charge_band = 'high' THEN 20 ELSE 0 END
       + CASE WHEN internet_service = 'Fiber optic' THEN 10 ELSE 0 END
       + CASE WHEN payment_method_group = 'manual' THEN 10 ELSE 0 END
       + CASE WHEN active_service_count <= 2 THEN 5 ELSE 0 END) AS score
    FROM silver
  )
)"""


def with_layers(*ctes: str, dirty: bool = False) -> str:
    parts = [FEED_BASE, FEED_DIRTY if dirty else FEED_CLEAN, *ctes]
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


BRONZE_COLS = ["customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure", "phone_service",
               "multiple_lines", "internet_service", "online_security", "online_backup", "device_protection",
               "tech_support", "streaming_tv", "streaming_movies", "contract", "paperless_billing",
               "payment_method", "monthly_charges", "total_charges", "churn", "total_charges_raw",
               "total_charges_was_blank", "source_file"]


# --- gold segment rates and KPIs ----------------------------------------------------------------------------


def _segment(by: str) -> str:
    return with_layers(BRONZE, SILVER) + f"""
SELECT {by},
  count(*) AS total_customers,
  CAST(sum(churn_flag) AS BIGINT) AS churned_customers,
  {r2('avg(churn_flag) * 100')} AS churn_rate_pct,
  {r2(_avg('monthly_charges'))} AS avg_monthly_charges,
  {r2(_avg('total_charges'))} AS avg_total_charges
FROM silver GROUP BY {by}"""


def _segments_one_scan() -> str:
    body = []
    for by in ("contract", "tenure_band", "payment_method_group"):
        body.append(f"""
SELECT '{by}' AS segment, CAST({by} AS VARCHAR) AS segment_value,
  count(*) AS total_customers, CAST(sum(churn_flag) AS BIGINT) AS churned_customers,
  {r2('avg(churn_flag) * 100')} AS churn_rate_pct, {r2(_avg('monthly_charges'))} AS avg_monthly_charges,
  {r2(_avg('total_charges'))} AS avg_total_charges, {r2(_sum('monthly_charges'))} AS estimated_monthly_revenue,
  {r2('avg(active_service_count)')} AS avg_active_service_count
FROM silver GROUP BY {by}""")
    body.append(f"""
SELECT '__total__' AS segment, CAST(NULL AS VARCHAR) AS segment_value,
  count(*) AS total_customers, CAST(sum(churn_flag) AS BIGINT) AS churned_customers,
  {r2('avg(churn_flag) * 100')} AS churn_rate_pct, {r2(_avg('monthly_charges'))} AS avg_monthly_charges,
  {r2(_avg('total_charges'))} AS avg_total_charges, {r2(_sum('monthly_charges'))} AS estimated_monthly_revenue,
  {r2('avg(active_service_count)')} AS avg_active_service_count
FROM silver""")
    return with_layers(BRONZE, SILVER) + "\nUNION ALL\n".join(body)


# --- quality checks -----------------------------------------------------------------------------------------


def _check_row(order, name, dimension, severity, count_sql, rule, kind="violations", text=None) -> str:
    rule_sql = rule.replace("'", "''")
    if kind == "text":
        return (f"SELECT {order} AS check_order, '{name}' AS name, '{dimension}' AS dimension, "
                f"'{severity}' AS severity, '{'PASS' if text == 'None' else 'FAIL'}' AS status, "
                f"'{text}' AS observed_value, CAST(NULL AS BIGINT) AS observed_count, '{rule_sql}' AS rule")
    if kind == "violations":
        status = f"CASE WHEN {count_sql} = 0 THEN 'PASS' ELSE 'FAIL' END"
    elif kind == "positive":
        status = f"CASE WHEN {count_sql} > 0 THEN 'PASS' ELSE 'FAIL' END"
    else:  # tracked
        status = "'PASS'"
    return (f"SELECT {order} AS check_order, '{name}' AS name, '{dimension}' AS dimension, "
            f"'{severity}' AS severity, {status} AS status, CAST(CAST({count_sql} AS BIGINT) AS VARCHAR) "
            f"AS observed_value, CAST({count_sql} AS BIGINT) AS observed_count, '{rule_sql}' AS rule")


def _missing(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


DOMAIN_SQL = [
    ("gender", "'Female', 'Male'", "['Female', 'Male']"),
    ("senior_citizen", "0, 1", "[0, 1]"),
    ("partner", "'No', 'Yes'", "['No', 'Yes']"),
    ("dependents", "'No', 'Yes'", "['No', 'Yes']"),
    ("phone_service", "'No', 'Yes'", "['No', 'Yes']"),
    ("internet_service", "'DSL', 'Fiber optic', 'No'", "['DSL', 'Fiber optic', 'No']"),
    ("contract", "'Month-to-month', 'One year', 'Two year'", "['Month-to-month', 'One year', 'Two year']"),
    ("paperless_billing", "'No', 'Yes'", "['No', 'Yes']"),
    ("churn", "'No', 'Yes'", "['No', 'Yes']"),
]


def _quality_bronze(dirty: bool) -> str:
    aggs = [
        "count(*) AS n",
        f"count_if({_missing('customer_id')}) AS c_missing_id",
    ]
    for c, vals, _ in DOMAIN_SQL:
        aggs.append(f"count_if({c} NOT IN ({vals}) OR {c} IS NULL) AS c_dom_{c}")
    aggs += [
        "count_if(tenure < 0) AS c_neg_tenure",
        "count_if(monthly_charges < 0) AS c_neg_monthly",
        "count_if(total_charges < 0) AS c_neg_total",
        "count_if(total_charges_was_blank = true AND tenure > 0) AS c_blank_pos",
        "count_if(total_charges_was_blank = true) AS c_blank",
        f"count_if({_missing('source_file')}) + count_if(ingested_at_utc IS NULL) AS c_meta",
    ]
    rows = [
        _check_row(1, "required_columns_present", "completeness", "critical", None,
                   "All expected bronze columns must be present.", kind="text", text="None"),
        _check_row(2, "row_count_positive", "completeness", "critical", "a.n",
                   "Bronze dataset must contain at least one row.", kind="positive"),
        _check_row(3, "customer_id_not_null", "completeness", "critical", "a.c_missing_id",
                   "customer_id must not be missing."),
        _check_row(4, "customer_id_unique", "uniqueness", "critical", "d.dups",
                   "customer_id must be unique in the customer baseline dataset."),
    ]
    for i, (c, _, text) in enumerate(DOMAIN_SQL):
        rows.append(_check_row(5 + i, f"{c}_domain_valid", "validity", "critical", f"a.c_dom_{c}",
                               f"{c} must be one of: {text}."))
    rows += [
        _check_row(14, "tenure_non_negative", "accuracy", "critical", "a.c_neg_tenure",
                   "tenure must not be negative."),
        _check_row(15, "monthly_charges_non_negative", "accuracy", "critical", "a.c_neg_monthly",
                   "monthly_charges must not be negative."),
        _check_row(16, "total_charges_non_negative", "accuracy", "critical", "a.c_neg_total",
                   "total_charges must not be negative when present."),
        _check_row(17, "blank_total_charges_only_for_zero_tenure", "consistency", "critical", "a.c_blank_pos",
                   "Blank total_charges is allowed only when tenure is zero."),
        _check_row(18, "blank_total_charges_tracked", "completeness", "warning", "a.c_blank",
                   "Blank source TotalCharges values must be tracked for silver cleaning.", kind="tracked"),
        _check_row(19, "ingestion_metadata_present", "timeliness", "critical", "a.c_meta",
                   "source_file and ingested_at_utc must be populated."),
    ]
    head = with_layers(BRONZE, dirty=dirty).rstrip() + f""",
a_src AS (SELECT {', '.join(aggs)} FROM bronze),
d_src AS (SELECT count(*) AS dups FROM (SELECT customer_id FROM bronze GROUP BY customer_id HAVING count(*) > 1))
"""
    return head + "\nUNION ALL\n".join(f"{r} FROM a_src a, d_src d" for r in rows)


def _quality_silver() -> str:
    rows = [
        _check_row(1, "row_count_positive", "completeness", "critical", "a.n", "Silver output must have rows.",
                   kind="positive"),
        _check_row(2, "customer_id_unique", "uniqueness", "critical", "d.dups",
                   "customer_id values must not repeat."),
        _check_row(3, "total_charges_not_null", "completeness", "critical", "a.c_null_total",
                   "total_charges must be filled after cleaning."),
        _check_row(4, "churn_flag_domain_valid", "validity", "critical", "a.c_flag",
                   "churn_flag must be one of: [0, 1]."),
    ]
    head = with_layers(BRONZE, SILVER).rstrip() + """,
a_src AS (SELECT count(*) AS n, count_if(total_charges IS NULL) AS c_null_total,
                 count_if(churn_flag NOT IN (0, 1) OR churn_flag IS NULL) AS c_flag FROM silver),
d_src AS (SELECT count(*) AS dups FROM (SELECT customer_id FROM silver GROUP BY customer_id HAVING count(*) > 1))
"""
    return head + "\nUNION ALL\n".join(f"{r} FROM a_src a, d_src d" for r in rows)


def _quality_generic(table: str, specs: list, dup_keys: list | None) -> str:
    """specs: (order, name, dimension, severity, count_if-predicate or special, rule, kind)."""
    aggs = ["count(*) AS n"]
    rows = []
    for order, name, dim, sev, pred, rule, kind in specs:
        if kind == "text":
            rows.append(_check_row(order, name, dim, sev, None, rule, kind="text", text=pred))
        elif kind == "positive":
            rows.append(_check_row(order, name, dim, sev, "a.n", rule, kind="positive"))
        elif kind == "dups":
            rows.append(_check_row(order, name, dim, sev, "d.dups", rule))
        else:
            aggs.append(f"count_if({pred}) AS c{order}")
            rows.append(_check_row(order, name, dim, sev, f"a.c{order}", rule, kind=kind))
    keys = ", ".join(dup_keys or ["1"])
    return f"""WITH a_src AS (SELECT {', '.join(aggs)} FROM {table}),
d_src AS (SELECT count(*) AS dups FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1))
""" + "\nUNION ALL\n".join(f"{r} FROM a_src a, d_src d" for r in rows)


def _dom(c, vals):
    quoted = ", ".join(f"'{v}'" for v in vals)
    return f"{c} NOT IN ({quoted}) OR {c} IS NULL"


def _dom_text(vals):
    return "[" + ", ".join(f"'{v}'" for v in vals) + "]"


ORDERS_QUALITY = _quality_generic("orders", [
    (1, "required_columns_present", "completeness", "critical", "None", "All expected columns must be present.",
     "text"),
    (2, "row_count_positive", "completeness", "critical", None, "Dataset must contain at least one row.",
     "positive"),
    (3, "o_orderkey_not_null", "completeness", "critical", _missing("o_orderkey"), "o_orderkey must not be missing.",
     "violations"),
    (4, "o_orderkey_unique", "uniqueness", "critical", None, "o_orderkey must be unique.", "dups"),
    (5, "o_orderstatus_domain_valid", "validity", "critical", _dom("o_orderstatus", ["F", "O", "P"]),
     f"o_orderstatus must be one of: {_dom_text(['F', 'O', 'P'])}.", "violations"),
    (6, "o_orderpriority_domain_valid", "validity", "critical",
     _dom("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
     f"o_orderpriority must be one of: {_dom_text(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])}.",
     "violations"),
    (7, "o_totalprice_non_negative", "accuracy", "critical", "o_totalprice < 0", "o_totalprice must not be negative.",
     "violations"),
    (8, "o_orderdate_present", "timeliness", "critical", "o_orderdate IS NULL", "o_orderdate must be populated.",
     "violations"),
], ["o_orderkey"])

LINEITEM_QUALITY = _quality_generic("lineitem", [
    (1, "row_count_positive", "completeness", "critical", None, "Dataset must contain at least one row.",
     "positive"),
    (2, "l_orderkey_l_linenumber_unique", "uniqueness", "critical", None, "l_orderkey, l_linenumber must be unique.",
     "dups"),
    (3, "l_returnflag_domain_valid", "validity", "critical", _dom("l_returnflag", ["A", "N", "R"]),
     f"l_returnflag must be one of: {_dom_text(['A', 'N', 'R'])}.", "violations"),
    (4, "l_linestatus_domain_valid", "validity", "critical", _dom("l_linestatus", ["F", "O"]),
     f"l_linestatus must be one of: {_dom_text(['F', 'O'])}.", "violations"),
    (5, "l_quantity_non_negative", "accuracy", "critical", "l_quantity < 0", "l_quantity must not be negative.",
     "violations"),
    (6, "l_extendedprice_non_negative", "accuracy", "critical", "l_extendedprice < 0",
     "l_extendedprice must not be negative.", "violations"),
    (7, "l_discount_non_negative", "accuracy", "critical", "l_discount < 0", "l_discount must not be negative.",
     "violations"),
    (8, "l_discount_at_most_one", "validity", "critical", "l_discount > 1", "l_discount must not exceed 1.",
     "violations"),
    (9, "l_returned_lines", "completeness", "warning", "l_returnflag = 'R'", "Returned lines are reported.",
     "tracked"),
], ["l_orderkey", "l_linenumber"])

EVENTS_QUALITY = _quality_generic("events", [
    (1, "row_count_positive", "completeness", "critical", None, "Dataset must contain at least one row.",
     "positive"),
    (2, "event_id_unique", "uniqueness", "critical", None, "event_id must be unique.", "dups"),
    (3, "user_id_not_null", "completeness", "critical", _missing("user_id"), "user_id must not be missing.",
     "violations"),
    (4, "event_type_domain_valid", "validity", "critical",
     _dom("event_type", ["click", "error", "purchase", "signup", "view"]),
     f"event_type must be one of: {_dom_text(['click', 'error', 'purchase', 'signup', 'view'])}.", "violations"),
    (5, "value_non_negative", "accuracy", "critical", "value < 0", "value must not be negative.", "violations"),
    (6, "ts_present", "timeliness", "critical", "ts IS NULL", "ts must be populated.", "violations"),
], ["event_id"])


# --- duplicate keys and profiling ---------------------------------------------------------------------------


def _dup_keys(table: str, keys: str, where: str = "") -> str:
    return f"""SELECT CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicated_rows,
  count(*) AS distinct_keys
FROM (SELECT count(*) AS n FROM {table} {where} GROUP BY {keys})"""


# characters Python's str.strip() removes, as a SQL literal
_WS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _strip(c: str) -> str:
    return f"trim(CAST({c} AS VARCHAR), '{_WS}')"


def _missing_profile(table: str, columns: list[str], label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL OR {_strip(c)} = '') AS BIGINT) AS missing_rows, "
        f"'{label}' AS table_name FROM {table}"
        for c in columns
    )


def _category_profile(table: str, columns: list[str], label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, coalesce(nullif({_strip(c)}, ''), '<missing>') AS category_value, "
        f"count(*) AS row_count, '{label}' AS table_name FROM {table} GROUP BY 2"
        for c in columns
    )


def _numeric_profile(table: str, columns: list[str], label: str) -> str:
    parts = []
    for c in columns:
        v = f"TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count_if({v} IS NULL) AS BIGINT) AS invalid_or_blank, "
            f"CAST(count_if({v} < 0) AS BIGINT) AS negative, CAST(min({v}) AS DOUBLE) AS min_value, "
            f"CAST(max({v}) AS DOUBLE) AS max_value, '{label}' AS table_name FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


# --- segment rates on native tables -------------------------------------------------------------------------


def _segment_generic(table, by, flag, measures, count_name, flagged_name, rate_name) -> str:
    ms = "".join(f",\n  {r2(_avg(src))} AS {name}" for name, src in measures.items())
    return f"""SELECT {by}, count(*) AS {count_name},
  CAST(sum({flag}) AS BIGINT) AS {flagged_name},
  {r2(f'avg({flag}) * 100')} AS {rate_name}{ms}
FROM {table} GROUP BY {by}"""


# --- verification, admission, daily usage, messages, profile summary ----------------------------------------


def _summary(layer, table, source, extra=()) -> str:
    """(layer, table_name, metric, value) rows: row_count, column_count and extra count_if metrics."""
    parts = [f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'row_count' AS metric, count(*) AS value "
             f"FROM {source}"]
    for name, pred in extra:
        parts.append(f"SELECT '{layer}', '{table}', '{name}', CAST(count_if({pred}) AS BIGINT) FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _column_count(layer, table, n) -> str:
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'column_count' AS metric, CAST({n} AS BIGINT) AS value"


_SEG_COUNT = "(SELECT {by} FROM silver GROUP BY {by})"

LAYER_SUMMARY = with_layers(BRONZE, SILVER) + "\nUNION ALL\n".join([
    _summary("bronze", "customer_churn", "bronze", [("blank_total_charges", "total_charges_was_blank = true")]),
    _column_count("bronze", "customer_churn", 25),
    _summary("silver", "customer_churn", "silver", [("null_total_charges", "total_charges IS NULL"),
                                                    ("blank_total_charges", "total_charges_was_blank = true")]),
    _column_count("silver", "customer_churn", 38),
    _summary("gold", "gold_churn_by_contract", _SEG_COUNT.format(by="contract")),
    _column_count("gold", "gold_churn_by_contract", 7),
    _summary("gold", "gold_churn_by_tenure_band", _SEG_COUNT.format(by="tenure_band")),
    _column_count("gold", "gold_churn_by_tenure_band", 7),
    _summary("gold", "gold_churn_by_payment_method", _SEG_COUNT.format(by="payment_method_group")),
    _column_count("gold", "gold_churn_by_payment_method", 7),
    _summary("gold", "gold_customer_risk_summary", "silver"),
    _column_count("gold", "gold_customer_risk_summary", 17),
    _summary("gold", "gold_executive_kpis", "(SELECT 1)"),
    _column_count("gold", "gold_executive_kpis", 8),
])

_KPIS = ("total_customers", "churned_customers", "overall_churn_rate_pct", "avg_monthly_charges",
         "estimated_monthly_revenue", "avg_total_charges", "avg_active_service_count")
_CENTS = "(1825 + CAST(floor(o_totalprice) AS BIGINT) % 10051)"
_OPTION_PRIMES = (3, 5, 7, 13, 17, 19)
_SERVICES = "CASE WHEN o_orderkey % 10 <> 0 THEN 1 ELSE 0 END" + "".join(
    f" + CASE WHEN o_orderkey % 9 >= 2 AND (o_orderkey * {m}) % 11 < 5 THEN 1 ELSE 0 END" for m in _OPTION_PRIMES)

KPI_RECONCILIATION = with_layers(BRONZE, SILVER) + f"""
, actual AS (
  SELECT 1.0::DOUBLE AS row_count, CAST(count(*) AS DOUBLE) AS total_customers,
    CAST(sum(churn_flag) AS DOUBLE) AS churned_customers, {r2('avg(churn_flag) * 100')} AS overall_churn_rate_pct,
    {r2(_avg('monthly_charges'))} AS avg_monthly_charges, {r2(_sum('monthly_charges'))} AS estimated_monthly_revenue,
    {r2(_avg('total_charges'))} AS avg_total_charges, {r2('avg(active_service_count)')} AS avg_active_service_count
  FROM silver
), expected AS (
  SELECT 1.0::DOUBLE AS row_count, CAST(count(*) AS DOUBLE) AS total_customers,
    CAST(count_if(o_orderstatus = 'F') AS DOUBLE) AS churned_customers,
    {r2("count_if(o_orderstatus = 'F')::DOUBLE / count(*) * 100")} AS overall_churn_rate_pct,
    {r2(f'avg({_CENTS}) / 100')} AS avg_monthly_charges, {r2(f'sum({_CENTS}) / 100')} AS estimated_monthly_revenue,
    {r2(f'avg({_CENTS} * ((o_orderkey * 31) % 73)) / 100')} AS avg_total_charges,
    {r2(f'avg({_SERVICES})')} AS avg_active_service_count
  FROM orders
), pairs AS (
""" + " UNION ALL\n".join(
    f"  SELECT '{m}' AS metric, a.{m} AS actual, e.{m} AS expected, {str(m in ('total_customers', 'churned_customers')).lower()} AS whole "
    "FROM actual a, expected e" for m in ("row_count", *_KPIS)) + """
)
SELECT metric, actual, expected, coalesce(CASE WHEN whole THEN actual = expected
  ELSE abs(actual - expected) <= 0.01 END, false) AS passed
FROM pairs"""

ADMISSION = with_layers() + """
, a AS (SELECT count(*) AS n, count_if(right(customerID, 1) IN ('1', '3', '5', '7', '9')) AS bad_prefix
        FROM feed),
o AS (SELECT count(*) AS expected FROM orders)
SELECT 1 AS check_order, 'header_matches_contract' AS name, 'validity' AS dimension, 'critical' AS severity,
  'FAIL' AS status, '1' AS observed_value, CAST(1 AS BIGINT) AS observed_count,
  'Every header must equal the contract columns in order.' AS rule FROM a
UNION ALL SELECT 2, 'file_not_empty', 'completeness', 'critical', CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END,
  CAST(n AS VARCHAR), n, 'File must contain data rows.' FROM a
UNION ALL SELECT 3, 'malformed_rows', 'validity', 'critical', 'PASS', '0', CAST(0 AS BIGINT),
  'Every line must parse with the contract schema.' FROM a
UNION ALL SELECT 4, 'expected_row_count', 'completeness', 'critical',
  CASE WHEN n = expected THEN 'PASS' ELSE 'FAIL' END, CAST(n AS VARCHAR), n,
  'Dataset must hold exactly ' || CAST(expected AS VARCHAR) || ' rows.' FROM a, o
UNION ALL SELECT 5, 'id_prefix', 'validity', 'critical', CASE WHEN bad_prefix = 0 THEN 'PASS' ELSE 'FAIL' END,
  CAST(CAST(bad_prefix AS BIGINT) AS VARCHAR), CAST(bad_prefix AS BIGINT), 'customerID must start with C.' FROM a"""

USAGE = "(SELECT CAST(ts AS DATE) AS usage_date, CAST(user_id AS VARCHAR) AS customer_id, value AS revenue FROM events)"

USAGE_QUALITY = _quality_generic(USAGE, [
    (1, "row_count_positive", "completeness", "critical", None, "Dataset must contain at least one row.",
     "positive"),
    (2, "usage_date_valid", "validity", "critical", "usage_date IS NULL", "usage_date must be a valid date.",
     "violations"),
    (3, "customer_id_not_null", "completeness", "critical", _missing("customer_id"),
     "customer_id must not be missing.", "violations"),
    (4, "revenue_non_negative", "accuracy", "critical", "revenue < 0", "revenue must not be negative.",
     "violations"),
    (5, "usage_date_customer_id_unique", "uniqueness", "critical", None, "usage_date, customer_id must be unique.",
     "dups"),
], ["usage_date", "customer_id"])

USAGE_DAILY = f"""
SELECT usage_date, count(*) AS records, count(DISTINCT customer_id) AS active_customers,
  {r2(_sum('revenue'))} AS revenue
FROM {USAGE} GROUP BY usage_date"""

MESSAGES = "(SELECT role AS label, text AS message FROM conversations)"

MESSAGE_QUALITY = f"""WITH a_src AS (
  SELECT count(*) AS n,
    count_if({_missing('label')}) AS c_label,
    count_if(label NOT IN ('assistant', 'system', 'user') OR label IS NULL) AS c_dom,
    count_if({_missing('message')}) AS c_msg,
    count_if(length(message) < 20) AS c_short
  FROM {MESSAGES}
), d_src AS (SELECT count(*) AS dups FROM (SELECT message FROM {MESSAGES} GROUP BY message HAVING count(*) > 1))
""" + "\nUNION ALL\n".join(f"{r} FROM a_src a, d_src d" for r in [
    _check_row(1, "row_count_positive", "completeness", "critical", "a.n", "Dataset must contain at least one row.",
               kind="positive"),
    _check_row(2, "label_not_null", "completeness", "critical", "a.c_label", "label must not be missing."),
    _check_row(3, "label_domain_valid", "validity", "critical", "a.c_dom",
               "label must be one of: ['assistant', 'system', 'user']."),
    _check_row(4, "message_not_null", "completeness", "critical", "a.c_msg", "message must not be missing."),
    _check_row(5, "message_duplicates", "uniqueness", "warning", "d.dups", "Duplicate messages are measured."),
    _check_row(6, "short_messages", "completeness", "warning", "a.c_short",
               "Messages under 20 characters are flagged.", kind="tracked"),
])

PROFILE_SUMMARY = with_layers() + """
, dirty_keys AS (
  SELECT CASE WHEN k % 1000 = 1 THEN '' WHEN k % 1000 = 12 THEN 'C' || CASE WHEN k > 10000000000 THEN CAST(k - 1 AS VARCHAR) ELSE printf('%010d', k - 1) END
              ELSE customerID END AS customerID
  FROM feed_clean
)
SELECT CAST(sum(n) AS BIGINT) AS row_count, 21 AS column_count, 'None' AS missing_expected_columns,
  'None' AS unexpected_columns,
  CAST(count_if(n > 1 AND NOT (customerID IS NULL OR trim(customerID) = '')) AS BIGINT) AS duplicate_key_values,
  'clean' AS feed
FROM (SELECT customerID, count(*) AS n FROM feed GROUP BY customerID)
UNION ALL
SELECT CAST(sum(n) AS BIGINT), 21, 'Churn', 'extra', CAST(count_if(n > 1 AND NOT (customerID IS NULL OR
  trim(customerID) = '')) AS BIGINT), 'dirty'
FROM (SELECT customerID, count(*) AS n FROM dirty_keys GROUP BY customerID)"""

# --- the registry -------------------------------------------------------------------------------------------


ORACLE_SQL: dict[str, str] = {
    "q_feed_bronze": with_layers(BRONZE) + f"SELECT {', '.join(BRONZE_COLS)} FROM bronze",
    "q_feed_silver": with_layers(BRONZE, SILVER) + "SELECT * EXCLUDE (ingested_at_utc) FROM silver",
    "q_churn_by_contract": _segment("contract"),
    "q_churn_by_tenure_band": _segment("tenure_band"),
    "q_churn_by_payment_group": _segment("payment_method_group"),
    "q_churn_by_segments": _segments_one_scan(),
    "q_customer_risk": with_layers(BRONZE, SILVER, RISK) + "SELECT * FROM risk",
    "q_risk_level_counts": with_layers(BRONZE, SILVER, RISK) + """
SELECT risk_level, count(*) AS customers, CAST(sum(churn_flag) AS BIGINT) AS churned_customers,
  min(risk_score) AS min_score, max(risk_score) AS max_score
FROM risk GROUP BY risk_level""",
    "q_risk_top100": with_layers(BRONZE, SILVER, RISK) + """
SELECT * FROM risk ORDER BY risk_score DESC, monthly_charges DESC NULLS LAST, customer_id ASC LIMIT 100""",
    "q_executive_kpis": with_layers(BRONZE, SILVER) + f"""
SELECT count(*) AS total_customers,
  CAST(sum(churn_flag) AS BIGINT) AS churned_customers,
  {r2('avg(churn_flag) * 100')} AS overall_churn_rate_pct,
  {r2(_avg('monthly_charges'))} AS avg_monthly_charges,
  {r2(_sum('monthly_charges'))} AS estimated_monthly_revenue,
  {r2(_avg('total_charges'))} AS avg_total_charges,
  {r2('avg(active_service_count)')} AS avg_active_service_count
FROM silver""",
    "q_quality_bronze": _quality_bronze(dirty=False),
    "q_quality_dirty": _quality_bronze(dirty=True),
    "q_quality_silver": _quality_silver(),
    "q_quality_orders": ORDERS_QUALITY,
    "q_quality_lineitem": LINEITEM_QUALITY,
    "q_quality_events": EVENTS_QUALITY,
    "q_dup_keys_lineitem": _dup_keys("lineitem", "l_orderkey, l_linenumber"),
    "q_dup_keys_conversations": _dup_keys("conversations", "conv_id, turn"),
    "q_negative_balance": """
SELECT 'customer' AS table_name, count(*) AS row_count, CAST(count_if(c_acctbal < 0) AS BIGINT) AS negative_rows,
  min(c_acctbal) AS min_balance FROM customer
UNION ALL
SELECT 'supplier', count(*), CAST(count_if(s_acctbal < 0) AS BIGINT), min(s_acctbal) FROM supplier""",
    "q_profile_missing": with_layers()
    + _missing_profile("documents", DOCUMENT_COLUMNS, "documents")
    + "\nUNION ALL\n" + _missing_profile("customer", CUSTOMER_COLUMNS, "customer")
    + "\nUNION ALL\n" + _missing_profile("feed", RAW, "feed"),
    "q_profile_categories": with_layers()
    + _category_profile("orders", ["o_orderstatus", "o_orderpriority"], "orders")
    + "\nUNION ALL\n" + _category_profile("part", ["p_type", "p_brand"], "part")
    + "\nUNION ALL\n" + _category_profile("events", ["event_type"], "events")
    + "\nUNION ALL\n" + _category_profile(
        "feed", ["gender", "SeniorCitizen", "Contract", "InternetService", "PaymentMethod", "Churn"], "feed"),
    "q_profile_numeric": with_layers()
    + _numeric_profile("feed", ["tenure", "MonthlyCharges", "TotalCharges"], "feed")
    + "\nUNION ALL\n" + _numeric_profile("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], "lineitem"),
    "q_profile_feed_duplicates": with_layers(dirty=True)
    + _dup_keys("feed", "customerID", f"WHERE NOT (customerID IS NULL OR trim(customerID) = '')"),
    "q_rate_by_priority": _segment_generic(
        "orders", "o_orderpriority", "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
        {"avg_totalprice": "o_totalprice"}, "orders", "finished_orders", "finished_rate_pct"),
    "q_rate_by_event_type": _segment_generic(
        "events", "event_type", "CASE WHEN value >= 100 THEN 1 ELSE 0 END",
        {"avg_value": "value"}, "events", "high_value_events", "high_value_rate_pct"),
    "q_toxic_rate_by_quality": _segment_generic(
        "labels", "quality", "toxic", {}, "documents", "toxic_documents", "toxic_rate_pct"),
    "q_balance_band": f"""
SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'medium'
            ELSE 'high' END AS balance_band,
  count(*) AS customers, {r2(_avg('c_acctbal'))} AS avg_balance
FROM customer GROUP BY 1""",
    "q_part_size_band": f"""
SELECT CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 25 THEN 'medium'
            WHEN p_size BETWEEN 26 AND 40 THEN 'large' ELSE 'extra_large' END AS size_band,
  count(*) AS parts, {r2(_avg('p_retailprice'))} AS avg_retailprice
FROM part GROUP BY 1""",
    "q_kpis_lineitem": f"""
SELECT count(*) AS line_count,
  CAST(count_if(l_returnflag = 'R') AS BIGINT) AS returned_lines,
  {r2("avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100")} AS return_rate_pct,
  {r2(_sum('l_quantity'))} AS total_quantity,
  {r2(_avg('l_extendedprice'))} AS avg_extendedprice,
  {r2(_sum('l_extendedprice * (1 - l_discount)'))} AS net_revenue
FROM lineitem""",
    "q_layer_summary": LAYER_SUMMARY,
    "q_kpi_reconciliation": KPI_RECONCILIATION,
    "q_admission": ADMISSION,
    "q_profile_summary": PROFILE_SUMMARY,
    "q_usage_quality": USAGE_QUALITY,
    "q_usage_daily": USAGE_DAILY,
    "q_message_quality": MESSAGE_QUALITY,
}
ORACLE_SQL["q_layers_roundtrip"] = ORACLE_SQL["q_executive_kpis"]
ORACLE_SQL["q_published_kpis"] = ORACLE_SQL["q_executive_kpis"]
ORACLE_SQL["q_text_checksums"] = "SELECT doc_id, sha256(text) AS sha256 FROM documents"
_RUN = "'2024-01-01 00:00:00'"
ORACLE_SQL["q_written_segments"] = with_layers(BRONZE, SILVER) + "\nUNION ALL\n".join(f"""
SELECT '{by}' AS segment, CAST({by} AS VARCHAR) AS segment_value, count(*) AS total_customers,
  CAST(sum(churn_flag) AS BIGINT) AS churned_customers, {r2('avg(churn_flag) * 100')} AS churn_rate_pct,
  {r2(_avg('monthly_charges'))} AS avg_monthly_charges, {r2(_avg('total_charges'))} AS avg_total_charges,
  {_RUN} AS gold_created_at_utc
FROM silver GROUP BY {by}""" for by in ("contract", "tenure_band", "payment_method_group"))
ORACLE_SQL["q_written_risk"] = with_layers(BRONZE, SILVER, RISK) + f"SELECT *, {_RUN} AS gold_created_at_utc FROM risk"
ORACLE_SQL["q_copied_silver"] = with_layers(BRONZE, SILVER) + (
    f"SELECT * REPLACE ({_RUN} AS ingested_at_utc), {_RUN} AS silver_transformed_at_utc FROM silver")
ORACLE_SQL["q_quality_summary"] = f"""
SELECT 'bronze.customer_churn' AS dataset, max(CASE WHEN name = 'row_count_positive' THEN observed_count END) AS row_count,
  25 AS column_count, CAST(count_if(severity = 'critical' AND status = 'FAIL') AS BIGINT) AS failed_critical_count,
  count(*) AS check_count
FROM ({ORACLE_SQL['q_quality_dirty']})"""
ORACLE_SQL["q_quality_missing_column"] = f"""
SELECT check_order, name, dimension, severity, CASE WHEN check_order = 1 THEN 'FAIL' ELSE status END AS status,
  CASE WHEN check_order = 1 THEN 'contract' ELSE observed_value END AS observed_value, observed_count, rule
FROM ({ORACLE_SQL['q_quality_bronze']}) WHERE check_order <= 2"""

_FILES = """files AS (
  SELECT doc_id // 100 AS part, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) || chr(10) AS body
  FROM documents GROUP BY 1)"""
ORACLE_SQL["q_file_checksums"] = f"""WITH {_FILES}
SELECT CAST(part AS BIGINT) AS part, CAST(strlen(body) AS BIGINT) AS length, sha256(body) AS sha256,
  CAST(ceil(strlen(body) / 65536.0) AS BIGINT) AS n_blocks, CASE WHEN part = 1 THEN 'FAIL' ELSE 'PASS' END AS status
FROM files"""
ORACLE_SQL["q_installed_files"] = f"""WITH {_FILES}
SELECT CAST(part AS BIGINT) AS part, CAST(strlen(body) AS BIGINT) AS length, CAST(strlen(body) AS BIGINT) AS written,
  sha256(body) AS sha256, true AS same, CAST(sum(strlen(body)) OVER () AS BIGINT) AS staged_bytes
FROM files"""
ORACLE_SQL["q_lake_versions"] = f"""
SELECT CAST(1 AS BIGINT) AS commit_number, CAST(2 AS BIGINT) AS runs, 'LayerValidationError' AS second_run,
  total_customers, churned_customers, total_customers AS bronze_rows
FROM ({ORACLE_SQL['q_executive_kpis']})"""
_TABLES = (("bronze", "bronze_customer_churn", "bronze"), ("silver", "silver_customer_churn", "silver"),
           ("gold", "gold_churn_by_contract", _SEG_COUNT.format(by="contract")),
           ("gold", "gold_churn_by_tenure_band", _SEG_COUNT.format(by="tenure_band")),
           ("gold", "gold_churn_by_payment_method", _SEG_COUNT.format(by="payment_method_group")),
           ("gold", "gold_customer_risk_summary", "silver"), ("gold", "gold_executive_kpis", "(SELECT 1)"))
ORACLE_SQL["q_layer_fingerprints"] = with_layers(BRONZE, SILVER) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{layer}' AS layer, count(*) AS rows, true AS same_again, true AS same_copy "
    f"FROM {source}" for layer, name, source in _TABLES)
ORACLE_SQL["q_layer_checks"] = f"""
SELECT 'V4' AS "check", 'gate' AS subject, 'LayerValidationError' AS outcome
WHERE EXISTS (SELECT 1 FROM ({ORACLE_SQL['q_quality_dirty']}) WHERE name = 'customer_id_unique' AND status = 'FAIL')
UNION ALL SELECT 'V10', 'gold_churn_by_region', 'missing'
UNION ALL SELECT 'V10', name, CASE WHEN name = 'bronze_customer_churn' THEN 'unexpected' ELSE 'complete' END
FROM (VALUES {', '.join(f"('{name}')" for _, name, _ in _TABLES)}) AS t(name)
UNION ALL SELECT 'V11', 'report', p FROM (VALUES ('critical checks failed'), ('a critical check is not PASS')) AS t(p)
WHERE EXISTS (SELECT 1 FROM ({ORACLE_SQL['q_quality_dirty']}) WHERE severity = 'critical' AND status = 'FAIL')"""
ORACLE_SQL["q_profile_decimals"] = """
WITH w AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE
    CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '' END || '1' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') || '.'
    || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') END AS long,
    CAST(o_orderkey % 7 AS VARCHAR) || 'e' || CAST(o_orderkey % 500 AS VARCHAR) AS exponent
  FROM orders)
SELECT 'long' AS column_name, CAST(count_if(long IS NULL) AS BIGINT) AS invalid_or_blank, CAST(count_if(long LIKE '-%') AS BIGINT) AS negative,
  CAST(min(CAST(long AS DECIMAL(38, 2))) AS VARCHAR) AS min_text, CAST(max(CAST(long AS DECIMAL(38, 2))) AS VARCHAR) AS max_text
FROM w
UNION ALL
SELECT 'exponent', 0, 0, min(exponent) FILTER (k % 7 = 0), arg_max(exponent, k % 500 * 10 + k % 7) FILTER (k % 7 > 0) FROM w"""
ORACLE_SQL["q_unique_lineitem"] = ORACLE_SQL["q_dup_keys_lineitem"]
ORACLE_SQL["q_unique_orders"] = """
SELECT CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicated_rows,
  count(*) AS distinct_keys
FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)"""
