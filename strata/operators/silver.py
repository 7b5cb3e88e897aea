"""Silver layer (P8-P19): imputation, flags, bands, lookups, service count, safe ratio -- one projection.

Column order: the bronze columns without the original tracked total, then the cleaned total (same name), the
derived columns, and the layer timestamp (38 columns for the subscriber spec).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import spec as S
from strata.functions import (
    band,
    count_equal,
    lookup,
    safe_ratio,
    threshold_band,
    yes_no_to_boolean,
)
from strata.operators.bronze import _ts_literal


def tenure_band(c: str = "tenure") -> Column:
    return band(c, S.TENURE_BANDS, S.TENURE_BAND_DEFAULT)


def monthly_charge_band(c: str = "monthly_charges") -> Column:
    return threshold_band(c, S.MONTHLY_CHARGE_BANDS, S.MONTHLY_CHARGE_BAND_DEFAULT, op="<")


def contract_months(c: str = "contract") -> Column:
    return lookup(c, S.CONTRACT_MONTHS)


def payment_method_group(c: str = "payment_method") -> Column:
    """``automatic`` when the method contains the (case-sensitive) marker; anything else, NULL too, ``manual``."""
    return F.when(F.col(c).contains(S.AUTOMATIC_PAYMENT_MARKER), F.lit("automatic")).otherwise(F.lit("manual"))


def impute_zero_when(total: str, tenure: str) -> Column:
    """NULL total with tenure 0 -> 0.0; NULL total with tenure > 0 (or NULL tenure) stays NULL."""
    return F.when(F.col(total).isNull() & (F.col(tenure) == 0), F.lit(0.0)).otherwise(F.col(total))


def silver_columns(spec: S.SubscriberSpec = S.SUBSCRIBER, run_ts=None) -> list[Column]:
    total = spec.blank_tracked
    keep = [c for c in spec.bronze_columns if c != total]
    clean_total = impute_zero_when(total, "tenure")
    derived: dict[str, Column] = {total: clean_total}
    for c in spec.yes_no_flags:
        derived[f"is_{c}"] = yes_no_to_boolean(c)
    derived["is_senior_citizen"] = F.col("senior_citizen") == 1
    derived["churn_flag"] = F.when(F.col("churn") == "Yes", F.lit(1)).otherwise(F.lit(0))
    derived["tenure_band"] = tenure_band()
    derived["monthly_charge_band"] = monthly_charge_band()
    derived["contract_months"] = contract_months()
    derived["payment_method_group"] = payment_method_group()
    derived["active_service_count"] = count_equal(spec.services, "Yes")
    derived["average_charge_per_tenure_month"] = safe_ratio(clean_total, "tenure", 1)
    derived["silver_transformed_at_utc"] = _ts_literal(run_ts)
    return [F.col(c) for c in keep] + [expr.alias(name) for name, expr in derived.items()]


def to_silver(bronze: DataFrame, run_ts=None, spec: S.SubscriberSpec = S.SUBSCRIBER) -> DataFrame:
    return bronze.select(*silver_columns(spec, run_ts))
