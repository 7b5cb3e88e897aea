"""Gold layer.

* ``segment_rate_summary``: one grouped aggregate (partial + final hash aggregation: a hot group costs one row per
  map task in the shuffle, never a skewed reducer), ordered by rate and count with the group as the tie-break.
* ``segment_rate_multi``: several single-column summaries and the global total in ONE scan; the grouping sets only
  expand the few rows of the combined groups.
* ``customer_risk``: row-level rule score and level; the full ordering is range-partitioned by Spark and uses the
  key as final tie-break, so range bounds can split even a value held by a third of the rows.
* ``executive_kpis``: one global aggregate row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import spec as S
from strata.functions import exact_avg, exact_sum, round_half_up, rule_score, threshold_band
from strata.functions.expr import sum_parts, total_of
from strata.operators.bronze import _ts_literal

DEFAULT_MEASURES = {"avg_monthly_charges": "monthly_charges", "avg_total_charges": "total_charges"}


def rate_aggregates(
    flag: str | Column = "churn_flag",
    measures: dict | None = None,
    count_name: str = "total_customers",
    flagged_name: str = "churned_customers",
    rate_name: str = "churn_rate_pct",
) -> list[Column]:
    """count, sum(flag) as bigint, round(avg(flag)*100, 2), round(avg(measure), 2) for each measure."""
    flag_col = F.col(flag) if isinstance(flag, str) else flag
    measures = DEFAULT_MEASURES if measures is None else measures
    aggs = [
        F.count(F.lit(1)).alias(count_name),
        F.sum(flag_col).cast("bigint").alias(flagged_name),
        round_half_up(F.avg(flag_col) * 100, 2).alias(rate_name),
    ]
    for name, c in measures.items():
        aggs.append(round_half_up(exact_avg(c), 2).alias(name))
    return aggs


def segment_rate_summary(
    df: DataFrame,
    by: str | list[str],
    flag: str | Column = "churn_flag",
    measures: dict | None = None,
    run_ts=None,
    count_name: str = "total_customers",
    flagged_name: str = "churned_customers",
    rate_name: str = "churn_rate_pct",
    with_timestamp: bool = True,
    ordered: bool = True,
) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    out = df.groupBy(*by).agg(*rate_aggregates(flag, measures, count_name, flagged_name, rate_name))
    if with_timestamp:
        out = out.withColumn("gold_created_at_utc", _ts_literal(run_ts))
    if ordered:
        out = out.orderBy(F.desc(rate_name), F.desc(count_name), *[F.asc_nulls_first(c) for c in by])
    return out


def segment_rate_multi(
    df: DataFrame,
    groups: list[str],
    flag: str | Column = "churn_flag",
    measures: dict | None = None,
    extra: dict | None = None,
    include_total: bool = True,
    count_name: str = "total_customers",
    flagged_name: str = "churned_customers",
    rate_name: str = "churn_rate_pct",
) -> DataFrame:
    """All single-column segment summaries (and the grand total) in one scan.

    The rows are aggregated once by all ``groups`` together, into exact sums and counts; only those few rows are
    expanded into the grouping sets. ``extra`` maps a name to (``"sum"`` or ``"avg"``, column).

    Output: ``segment`` (the grouping column name, ``__total__`` for the grand total), ``segment_value`` (as
    string, NULL group kept), the rate aggregates and ``extra`` aggregates.
    """
    measures = DEFAULT_MEASURES if measures is None else measures
    wanted = {**{name: ("avg", c) for name, c in measures.items()}, **(extra or {})}
    flag_col = F.col(flag) if isinstance(flag, str) else flag
    first = [F.count(F.lit(1)).alias("_rows"), F.sum(flag_col).alias("_flagged"), F.count(flag_col).alias("_flags")]
    for name, (_, c) in wanted.items():
        first += [part.alias(f"_{name}_{key}") for key, part in sum_parts(c).items()]
    combined = df.groupBy(*groups).agg(*first)
    sets = [[c] for c in groups] + ([[]] if include_total else [])
    again = [F.sum(c).alias(c) for c in combined.columns if c not in groups]
    g = combined.groupingSets(sets, *groups).agg(*again, F.grouping_id().alias("_gid"))
    n = len(groups)
    segment = None
    value = None
    for i, c in enumerate(groups):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))
        cond = F.col("_gid") == gid
        segment = F.when(cond, F.lit(c)) if segment is None else segment.when(cond, F.lit(c))
        value = F.when(cond, F.col(c).cast("string")) if value is None else value.when(cond, F.col(c).cast("string"))
    segment = segment.otherwise(F.lit("__total__"))
    rate = F.col("_flagged").cast("double") / F.nullif(F.col("_flags"), F.lit(0)) * 100
    out = [F.coalesce("_rows", F.lit(0)).alias(count_name), F.col("_flagged").cast("bigint").alias(flagged_name),
           round_half_up(rate, 2).alias(rate_name)]
    for name, (kind, _) in wanted.items():
        total = total_of(*[F.col(f"_{name}_{key}") for key in ("exact", "approx", "odd")])
        if kind == "avg":
            total = total / F.nullif(F.col(f"_{name}_n"), F.lit(0))
        out.append(round_half_up(total, 2).alias(name))
    return g.select(segment.alias("segment"), value.alias("segment_value"), *out)


def risk_score() -> Column:
    return rule_score(S.RISK_SCORE_RULES)


def risk_level(c: str | Column = "risk_score") -> Column:
    return threshold_band(c, S.RISK_LEVELS, S.RISK_LEVEL_DEFAULT, op=">=")


def risk_order() -> list[Column]:
    """O2: riskiest first, then the higher charge, then the key (a total order over unique keys)."""
    return [F.desc("risk_score"), F.desc_nulls_last("monthly_charges"), F.asc("customer_id")]


def customer_risk(df: DataFrame, run_ts=None, ordered: bool = True, with_timestamp: bool = True) -> DataFrame:
    out = (
        df.select(*S.RISK_COLUMNS)
        .withColumn("risk_score", risk_score())
        .withColumn("risk_level", risk_level())
    )
    if with_timestamp:
        out = out.withColumn("gold_created_at_utc", _ts_literal(run_ts))
    if ordered:
        out = out.orderBy(*risk_order())
    return out


def risk_top(df: DataFrame, k: int = 100) -> DataFrame:
    """Top-k riskiest customers: per-partition top-k then merge (TakeOrderedAndProject), no full sort."""
    return customer_risk(df, with_timestamp=False, ordered=False).orderBy(*risk_order()).limit(k)


def risk_level_counts(df: DataFrame) -> DataFrame:
    risk = customer_risk(df, with_timestamp=False, ordered=False)
    return risk.groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("churn_flag").cast("bigint").alias("churned_customers"),
        F.min("risk_score").alias("min_score"),
        F.max("risk_score").alias("max_score"),
    )


def kpi_aggregates() -> dict[str, Column]:
    return {
        "total_customers": F.count(F.lit(1)),
        "churned_customers": F.sum("churn_flag").cast("bigint"),
        "overall_churn_rate_pct": round_half_up(F.avg("churn_flag") * 100, 2),
        "avg_monthly_charges": round_half_up(exact_avg("monthly_charges"), 2),
        "estimated_monthly_revenue": round_half_up(exact_sum("monthly_charges"), 2),  # exact at any row count
        "avg_total_charges": round_half_up(exact_avg("total_charges"), 2),
        "avg_active_service_count": round_half_up(exact_avg("active_service_count"), 2),
    }


def executive_kpis(df: DataFrame, run_ts=None, with_timestamp: bool = True) -> DataFrame:
    out = df.agg(*[expr.alias(name) for name, expr in kpi_aggregates().items()])
    if with_timestamp:
        out = out.withColumn("gold_created_at_utc", _ts_literal(run_ts))
    return out


SEGMENT_TABLES = {
    "gold_churn_by_contract": "contract",
    "gold_churn_by_tenure_band": "tenure_band",
    "gold_churn_by_payment_method": "payment_method_group",
}


def build_gold_tables(silver: DataFrame, run_ts=None) -> dict[str, DataFrame]:
    """The five gold tables as lazy DataFrames (each its own aggregate)."""
    tables = {name: segment_rate_summary(silver, by, run_ts=run_ts) for name, by in SEGMENT_TABLES.items()}
    tables["gold_customer_risk_summary"] = customer_risk(silver, run_ts)
    tables["gold_executive_kpis"] = executive_kpis(silver, run_ts)
    return {name: tables[name] for name in S.GOLD_TABLES}


def gold_aggregates_one_scan(silver: DataFrame) -> DataFrame:
    """Segment summaries and executive KPIs from ONE scan of silver (grouping sets incl. the grand total)."""
    extra = {
        "estimated_monthly_revenue": ("sum", "monthly_charges"),
        "avg_active_service_count": ("avg", "active_service_count"),
    }
    return segment_rate_multi(silver, list(SEGMENT_TABLES.values()), extra=extra)


def segment_order(by: str, rate_name: str = "churn_rate_pct", count_name: str = "total_customers") -> list:
    """O1 ordering of a segment summary, with the group as final tie-break."""
    return [F.desc(rate_name), F.desc(count_name), F.asc_nulls_first(by)]


def split_gold_aggregates(multi: DataFrame, run_ts=None, ordered: bool = True) -> dict[str, DataFrame]:
    """Turn the one-scan aggregate into the four aggregate gold tables (same schemas as the per-table form)."""
    ts = _ts_literal(run_ts)
    out = {}
    for name, by in SEGMENT_TABLES.items():
        part = multi.filter(F.col("segment") == by).select(
            F.col("segment_value").alias(by),
            "total_customers",
            "churned_customers",
            "churn_rate_pct",
            "avg_monthly_charges",
            "avg_total_charges",
            ts.alias("gold_created_at_utc"),
        )
        out[name] = part.orderBy(*segment_order(by)) if ordered else part
    out["gold_executive_kpis"] = multi.filter(F.col("segment") == "__total__").select(
        "total_customers",
        "churned_customers",
        F.col("churn_rate_pct").alias("overall_churn_rate_pct"),
        "avg_monthly_charges",
        "estimated_monthly_revenue",
        "avg_total_charges",
        "avg_active_service_count",
        ts.alias("gold_created_at_utc"),
    )
    return out
