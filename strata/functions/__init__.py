"""Column-expression builders. All return ``pyspark.sql.Column`` built from built-in functions, so they stay
inside whole-stage code generation and can be pushed into scans where Catalyst allows."""

from strata.functions.expr import (
    band,
    col_of,
    count_equal,
    is_blank,
    is_missing,
    is_negative,
    lookup,
    exact_avg,
    exact_sum,
    outside_domain,
    round_half_up,
    rule_score,
    safe_ratio,
    strip_whitespace,
    threshold_band,
    yes_no_to_boolean,
)

__all__ = [
    "band",
    "col_of",
    "count_equal",
    "is_blank",
    "is_missing",
    "is_negative",
    "lookup",
    "exact_avg",
    "exact_sum",
    "outside_domain",
    "round_half_up",
    "rule_score",
    "safe_ratio",
    "strip_whitespace",
    "threshold_band",
    "yes_no_to_boolean",
]
