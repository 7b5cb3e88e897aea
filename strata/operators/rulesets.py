"""Rule sets: the subscriber bronze gate (19 checks), the bronze / silver validators, and rule sets for the
driver's native tables that show the engine is table-agnostic."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import spec as S
from strata.functions import is_missing
from strata.operators import quality as Q

# Rule texts of the bronze quality report (they appear verbatim in the reports).
BRONZE_RULE_TEXT = {
    "required_columns_present": "All expected bronze columns must be present.",
    "row_count_positive": "Bronze dataset must contain at least one row.",
    "customer_id_not_null": "customer_id must not be missing.",
    "customer_id_unique": "customer_id must be unique in the customer baseline dataset.",
    "tenure_non_negative": "tenure must not be negative.",
    "monthly_charges_non_negative": "monthly_charges must not be negative.",
    "total_charges_non_negative": "total_charges must not be negative when present.",
    "blank_total_charges_only_for_zero_tenure": "Blank total_charges is allowed only when tenure is zero.",
    "blank_total_charges_tracked": "Blank source TotalCharges values must be tracked for silver cleaning.",
    "ingestion_metadata_present": "source_file and ingested_at_utc must be populated.",
}


def bronze_checks(spec: S.SubscriberSpec = S.SUBSCRIBER) -> list[Q.Check]:
    t = BRONZE_RULE_TEXT
    blank = F.col(f"{spec.blank_tracked}_was_blank") == F.lit(True)
    checks = [
        Q.required_columns(spec.bronze_columns, rule=t["required_columns_present"]),
        Q.row_count_positive(rule=t["row_count_positive"]),
        Q.not_missing(spec.key, rule=t["customer_id_not_null"]),
        Q.unique(spec.key, name=f"{spec.key}_unique", rule=t["customer_id_unique"]),
    ]
    checks += [Q.in_domain(c, allowed) for c, allowed in spec.domains.items()]
    checks += [
        Q.non_negative("tenure", rule=t["tenure_non_negative"]),
        Q.non_negative("monthly_charges", rule=t["monthly_charges_non_negative"]),
        Q.non_negative("total_charges", rule=t["total_charges_non_negative"]),
        Q.violation(
            "blank_total_charges_only_for_zero_tenure",
            blank & (F.col("tenure") > 0),
            dimension="consistency",
            rule=t["blank_total_charges_only_for_zero_tenure"],
        ),
        Q.tracked("blank_total_charges_tracked", blank, rule=t["blank_total_charges_tracked"]),
        Q.violation(
            "ingestion_metadata_present",
            [is_missing("source_file"), F.col("ingested_at_utc").isNull()],
            dimension="timeliness",
            rule=t["ingestion_metadata_present"],
        ),
    ]
    return checks


def bronze_validator(spec: S.SubscriberSpec = S.SUBSCRIBER) -> list[Q.Check]:
    """V1: zero rows, duplicate keys, missing keys (NULL or exactly empty), in that order."""
    return [
        Q.row_count_positive(rule="Bronze output must have rows."),
        Q.unique(spec.key, rule=f"{spec.key} values must not repeat."),
        Q.not_missing(spec.key, trim=False, rule=f"{spec.key} must be present."),
    ]


def silver_validator(spec: S.SubscriberSpec = S.SUBSCRIBER) -> list[Q.Check]:
    """V2: zero rows, duplicate keys, NULL cleaned total, churn flag outside {0, 1}."""
    return [
        Q.row_count_positive(rule="Silver output must have rows."),
        Q.unique(spec.key, rule=f"{spec.key} values must not repeat."),
        Q.violation(f"{spec.blank_tracked}_not_null", F.col(spec.blank_tracked).isNull(), dimension="completeness",
                    rule=f"{spec.blank_tracked} must be filled after cleaning."),
        Q.in_domain("churn_flag", [0, 1]),
    ]


# Domains of the driver tables (observed in the data; parameters of the generic rule sets).
ORDER_STATUSES = ["F", "O", "P"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def orders_checks() -> list[Q.Check]:
    return [
        Q.required_columns(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                            "o_orderpriority"]),
        Q.row_count_positive(),
        Q.not_missing("o_orderkey"),
        Q.unique("o_orderkey"),
        Q.in_domain("o_orderstatus", ORDER_STATUSES),
        Q.in_domain("o_orderpriority", ORDER_PRIORITIES),
        Q.non_negative("o_totalprice"),
        Q.violation("o_orderdate_present", F.col("o_orderdate").isNull(), dimension="timeliness",
                    rule="o_orderdate must be populated."),
    ]


def lineitem_checks() -> list[Q.Check]:
    return [
        Q.row_count_positive(),
        Q.unique(["l_orderkey", "l_linenumber"]),
        Q.in_domain("l_returnflag", RETURN_FLAGS),
        Q.in_domain("l_linestatus", LINE_STATUSES),
        Q.non_negative("l_quantity"),
        Q.non_negative("l_extendedprice"),
        Q.non_negative("l_discount"),
        Q.violation("l_discount_at_most_one", F.col("l_discount") > 1, dimension="validity",
                    rule="l_discount must not exceed 1."),
        Q.tracked("l_returned_lines", F.col("l_returnflag") == "R", rule="Returned lines are reported."),
    ]


def events_checks() -> list[Q.Check]:
    return [
        Q.row_count_positive(),
        Q.unique("event_id"),
        Q.not_missing("user_id"),
        Q.in_domain("event_type", EVENT_TYPES),
        Q.non_negative("value"),
        Q.violation("ts_present", F.col("ts").isNull(), dimension="timeliness", rule="ts must be populated."),
    ]


def usage_checks() -> list[Q.Check]:
    """D1 daily usage feed: valid date, customer present, non-negative amounts, one record per date and customer."""
    return [
        Q.row_count_positive(),
        Q.violation("usage_date_valid", F.col("usage_date").isNull(), dimension="validity",
                    rule="usage_date must be a valid date."),
        Q.not_missing("customer_id"),
        Q.non_negative("revenue"),
        Q.unique(["usage_date", "customer_id"]),
    ]


SHORT_MESSAGE_CHARS = 20


def message_checks(labels=("assistant", "system", "user")) -> list[Q.Check]:
    """D2 message feed (label, message): label present and known, message not blank; duplicate messages and very
    short messages are measured as warnings. Duplicates are keyed by (SHA-256 of the whole text, length), so the
    shuffle carries 40 bytes per row whatever the text length."""
    return [
        Q.row_count_positive(),
        Q.not_missing("label"),
        Q.in_domain("label", list(labels)),
        Q.not_missing("message"),
        Q.unique(["message_sha256", "message_length"], name="message_duplicates", severity=Q.WARNING,
                 rule="Duplicate messages are measured."),
        Q.tracked("short_messages", F.length("message") < SHORT_MESSAGE_CHARS,
                  rule=f"Messages under {SHORT_MESSAGE_CHARS} characters are flagged."),
    ]
