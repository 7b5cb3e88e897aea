"""Verification (V5-V11): layer summaries, previews, KPI expectations, output completeness, report regression.

Summaries are returned as DataFrames (long form: ``layer, table_name, metric, value``) instead of printed, so
tests and the oracle can compare them. Each summary is one aggregate per table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.sources import fs


def layer_summary(df: DataFrame, layer: str, table_name: str, counts: dict[str, Column] | None = None) -> DataFrame:
    """(layer, table_name, metric, value): row count, column count and any extra ``count_if`` metrics."""
    counts = counts or {}
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(c).alias(f"_k{i}") for i, c in enumerate(counts.values())]
    metrics = [("row_count", F.col("_rows")), ("column_count", F.lit(len(df.columns)).cast("bigint"))]
    metrics += [(name, F.col(f"_k{i}")) for i, name in enumerate(counts)]
    pairs = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(table_name).alias("table_name"),
                F.lit(name).alias("metric"),
                value.cast("bigint").alias("value"),
            )
            for name, value in metrics
        ]
    )
    return df.agg(*aggs).select(F.inline(pairs))


def bronze_summary(bronze: DataFrame, table_name: str = "customer_churn") -> DataFrame:
    """V6: rows, columns, blank totals tracked."""
    return layer_summary(bronze, "bronze", table_name,
                         {"blank_total_charges": F.col("total_charges_was_blank") == F.lit(True)})


def silver_summary(silver: DataFrame, table_name: str = "customer_churn") -> DataFrame:
    """V7: rows, columns, NULL totals after cleaning, blank totals tracked."""
    return layer_summary(
        silver,
        "silver",
        table_name,
        {
            "null_total_charges": F.col("total_charges").isNull(),
            "blank_total_charges": F.col("total_charges_was_blank") == F.lit(True),
        },
    )


def gold_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """V8: rows and columns of every gold table, unioned."""
    out = None
    for name, df in tables.items():
        part = layer_summary(df, "gold", name)
        out = part if out is None else out.unionByName(part)
    return out


# The columns each layer's verification previews (gold tables preview every column).
PREVIEW_COLUMNS = {
    "bronze": ["customer_id", "tenure", "monthly_charges", "total_charges", "total_charges_was_blank", "churn"],
    "silver": ["customer_id", "tenure", "total_charges", "total_charges_was_blank", "churn_flag", "tenure_band",
               "monthly_charge_band", "active_service_count"],
}


def preview(df: DataFrame, columns=None, n: int = 5) -> DataFrame:
    """O3: the first ``n`` rows of selected columns (a limit, not a scan of the whole table)."""
    return df.select(*(columns or df.columns)).limit(n)


#: the metric that says whether a KPI table has exactly one row
ONE_ROW = "row_count"


def kpi_comparison(actual: DataFrame, expected: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """V5: compare KPI frames metric by metric -> (metric, actual, expected, passed).

    Every metric of either side is listed, and one that a side lacks fails; so does a NULL. ``row_count`` is a metric
    too: both frames must have exactly one row. Whole-number columns (by type, on both sides) must be equal, others
    within ``tolerance``. Values are compared as decimals, so large whole numbers keep every digit.
    """
    whole = lambda df, c: isinstance(df.schema[c].dataType, IntegralType)

    def long(df: DataFrame, side: str) -> DataFrame:
        kind = "decimal(38,8)"
        one = df.agg(F.count(F.lit(1)).alias(ONE_ROW), *[F.first(c).alias(c) for c in df.columns])
        pairs = [F.struct(F.lit(ONE_ROW).alias("metric"), F.col(ONE_ROW).cast(kind).alias("v"), F.lit(True).alias("w"))]
        pairs += [F.struct(F.lit(c).alias("metric"), F.col(c).cast(kind).alias("v"), F.lit(whole(df, c)).alias("w"))
                  for c in df.columns]
        return one.select(F.inline(F.array(*pairs))).select("metric", F.lit(side).alias("side"), "v", "w")

    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = long(actual, "actual").unionByName(long(expected, "expected")).groupBy("metric").agg(
        of("actual", "v").alias("actual"), of("expected", "v").alias("expected"), F.bool_and("w").alias("whole"))
    near = F.abs(F.col("actual") - F.col("expected")) <= F.lit(tolerance).cast("decimal(38,8)")
    passed = (F.when(F.col("metric") == ONE_ROW, (F.col("actual") == 1) & (F.col("expected") == 1))
              .when(F.col("whole"), F.col("actual") == F.col("expected")).otherwise(near))
    return both.select("metric", F.col("actual").cast("double").alias("actual"),
                       F.col("expected").cast("double").alias("expected"),
                       F.coalesce(passed, F.lit(False)).alias("passed"))


def assert_kpis(actual: DataFrame, expected: dict, tolerance: float = 0.01) -> None:
    """V5 as an assertion: the failing metrics of :func:`kpi_comparison` among those expected, raised together."""
    wanted = actual.sparkSession.createDataFrame([tuple(expected.values())], list(expected))
    extra = [c for c in actual.columns if c not in expected]
    result = kpi_comparison(actual.drop(*extra), wanted, tolerance).where(~F.col("passed")).orderBy("metric").collect()
    if result:
        raise AssertionError("; ".join(f"{r['metric']}: {r['actual']} instead of {r['expected']}" for r in result))


def layer_completeness(spark, root: str, expected_tables) -> list[tuple[str, str]]:
    """V10 on any file system: (table, state) for every expected or found table, by commit marker: ``complete``,
    ``missing`` (no committed folder), or ``unexpected`` (committed, not expected)."""
    from strata.plans.publish import discover_tables

    found = {name for name, _, _ in discover_tables(spark, root)}
    wanted = set(expected_tables)
    state = lambda name: ("complete" if name in found else "missing") if name in wanted else "unexpected"
    return [(name, state(name)) for name in sorted(wanted | found)]


def report_regression(spark, report_path: str, dataset: str, column_count: int) -> list[str]:
    """Problems found in a written JSON quality report (empty list = fine)."""
    report = json.loads(fs.read_text(spark, report_path))
    problems = []
    if report.get("dataset") != dataset:
        problems.append("dataset name differs")
    if not report.get("row_count"):
        problems.append("no rows")
    if report.get("failed_critical_count") != 0:
        problems.append("critical checks failed")
    if any(c["status"] != "PASS" for c in report.get("checks", []) if c["severity"] == "critical"):
        problems.append("a critical check is not PASS")
    if report.get("column_count") != column_count:
        problems.append(f"column count {report.get('column_count')} != {column_count}")
    return problems
