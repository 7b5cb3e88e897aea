"""Table contracts and the subscriber (customer churn) specification.

The operators in ``strata.operators`` take columns, rules and bands as arguments; the subscriber table is one
instance of those arguments, bundled here as :data:`SUBSCRIBER`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------------------------------------------
# Fixed values. These must equal the reference's source contract, domains, bands and score points for the
# results to match; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------------------------------------------

RAW_COLUMNS = (
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
)

RENAMES = {
    "customerID": "customer_id",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Churn": "churn",
}

BRONZE_COLUMNS = (
    "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure",
    "phone_service", "multiple_lines", "internet_service", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract", "paperless_billing", "payment_method",
    "monthly_charges", "total_charges", "churn", "total_charges_raw",
    "total_charges_was_blank", "source_file", "ingested_at_utc",
)

DOMAINS = {
    "gender": ["Female", "Male"],
    "senior_citizen": [0, 1],
    "partner": ["No", "Yes"],
    "dependents": ["No", "Yes"],
    "phone_service": ["No", "Yes"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "contract": ["Month-to-month", "One year", "Two year"],
    "paperless_billing": ["No", "Yes"],
    "churn": ["No", "Yes"],
}

YES_NO_FLAG_COLUMNS = ("partner", "dependents", "phone_service", "paperless_billing")

SERVICE_COLUMNS = (
    "phone_service", "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
)

# (low, high, label) inclusive; anything else (incl. NULL and negative tenure) gets the default label
TENURE_BANDS = ((0, 0, "new_customer"), (1, 12, "1_12_months"), (13, 24, "13_24_months"), (25, 48, "25_48_months"))
TENURE_BAND_DEFAULT = "49_plus_months"

# (exclusive upper limit, label); anything else (incl. NULL and NaN) gets the default label
MONTHLY_CHARGE_BANDS = ((35, "low"), (70, "medium"))
MONTHLY_CHARGE_BAND_DEFAULT = "high"

CONTRACT_MONTHS = {"Month-to-month": 1, "One year": 12, "Two year": 24}

AUTOMATIC_PAYMENT_MARKER = "automatic"

# (column, operator, value, points) -- summed; a NULL comparison scores 0
RISK_SCORE_RULES = (
    ("contract", "==", "Month-to-month", 30),
    ("tenure", "<=", 12, 25),
    ("monthly_charge_band", "==", "high", 20),
    ("internet_service", "==", "Fiber optic", 10),
    ("payment_method_group", "==", "manual", 10),
    ("active_service_count", "<=", 2, 5),
)

# (inclusive lower limit, label), checked from the top; anything else is "low"
RISK_LEVELS = ((70, "high"), (40, "medium"))
RISK_LEVEL_DEFAULT = "low"

RISK_COLUMNS = (
    "customer_id", "gender", "senior_citizen", "tenure", "tenure_band", "contract",
    "payment_method_group", "internet_service", "monthly_charges", "monthly_charge_band",
    "total_charges", "active_service_count", "churn", "churn_flag",
)

GOLD_TABLES = (
    "gold_churn_by_contract",
    "gold_churn_by_tenure_band",
    "gold_churn_by_payment_method",
    "gold_customer_risk_summary",
    "gold_executive_kpis",
)

DATASET_NAME = "bronze.customer_churn"
ENTITY = "customer_churn"

# Published executive KPIs of the full 7,043-row public sample (the expectation of the KPI test).
PUBLIC_SAMPLE_KPIS = {
    "total_customers": 7043,
    "churned_customers": 1869,
    "overall_churn_rate_pct": 26.54,
    "avg_monthly_charges": 64.76,
    "estimated_monthly_revenue": 456116.60,
}

# ---------------------------------------------------------------------------------------------------------------


def string_schema(columns) -> StructType:
    """All-string, nullable schema: raw files are never type-inferred."""
    return StructType([StructField(c, StringType(), True) for c in columns])


RAW_SCHEMA = string_schema(RAW_COLUMNS)


@dataclass(frozen=True)
class SubscriberSpec:
    """Everything the layers need to know about one entity table."""

    raw_columns: tuple = RAW_COLUMNS
    renames: dict = field(default_factory=lambda: dict(RENAMES))
    key: str = "customer_id"
    int_columns: tuple = ("senior_citizen", "tenure")
    double_columns: tuple = ("monthly_charges",)
    blank_tracked: str = "total_charges"
    bronze_columns: tuple = BRONZE_COLUMNS
    domains: dict = field(default_factory=lambda: dict(DOMAINS))
    yes_no_flags: tuple = YES_NO_FLAG_COLUMNS
    services: tuple = SERVICE_COLUMNS
    dataset: str = DATASET_NAME
    entity: str = ENTITY


SUBSCRIBER = SubscriberSpec()

# The columns that the raw profile reports.
PROFILE_CATEGORICAL = ("gender", "SeniorCitizen", "Contract", "InternetService", "PaymentMethod", "Churn")
PROFILE_NUMERIC = ("tenure", "MonthlyCharges", "TotalCharges")
PROFILE_SAMPLE = ("customerID", "tenure", "MonthlyCharges", "TotalCharges", "Churn")
