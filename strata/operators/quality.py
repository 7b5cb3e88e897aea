"""Data-quality rule engine.

Rules are data (:class:`Check`). :func:`evaluate` turns any list of checks into ONE lazy DataFrame of check
results:

* every row-level rule is a ``count_if`` inside a single global aggregate (one scan, partial aggregation per task,
  a single row per task crosses the shuffle);
* each key-uniqueness rule is ``groupBy(keys).count()`` -> ``count_if(n > 1)``. Partial aggregation collapses a hot
  key (e.g. a blank key held by a third of the rows) to one row per map task before the shuffle;
* metadata rules (required columns) need no job at all;
* the branches are unioned, so materialising the result is one action, whatever the number of rules;
* the row-level aggregate is also available as named expressions (:func:`row_rule_metrics`), so a writer can
  observe it while it writes the data; ``evaluate(..., metrics=...)`` then only re-reads the key columns.

The result has one row per check: ``check_order, name, dimension, severity, status, observed_value (string),
observed_count (bigint, NULL for text observations), rule``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import is_missing, is_negative, outside_domain

CRITICAL = "critical"
WARNING = "warning"


@dataclass(frozen=True)
class Check:
    name: str
    dimension: str
    severity: str
    rule: str
    kind: str  # required_columns | metadata | row_count | violations | tracked | duplicates
    predicates: tuple = ()  # Columns; their count_if values are summed
    keys: tuple = ()
    columns: tuple = ()
    ignore_blank_keys: bool = False
    target: int | None = None  # row_count: exact expected count (None: at least one row)
    observed: str | None = None  # metadata: observed text
    passed: bool | None = None  # metadata: outcome decided from schema / file metadata


# --- check constructors ---------------------------------------------------------------------------------------


def required_columns(columns, name="required_columns_present", severity=CRITICAL,
                     rule="All expected columns must be present.") -> Check:
    return Check(name, "completeness", severity, rule, "required_columns", columns=tuple(columns))


def row_count_positive(name="row_count_positive", severity=CRITICAL,
                       rule="Dataset must contain at least one row.") -> Check:
    return Check(name, "completeness", severity, rule, "row_count")


def row_count_equals(expected: int, name="expected_row_count", severity=CRITICAL, rule=None) -> Check:
    return Check(name, "completeness", severity, rule or f"Dataset must hold exactly {expected} rows.", "row_count",
                 target=expected)


def metadata(name, passed: bool, observed: str, dimension="validity", severity=CRITICAL, rule="") -> Check:
    """A check decided from schema or file metadata (no job)."""
    return Check(name, dimension, severity, rule, "metadata", observed=observed, passed=passed)


def not_missing(column, name=None, severity=CRITICAL, rule=None, trim=True) -> Check:
    return Check(
        name or f"{column}_not_null", "completeness", severity, rule or f"{column} must not be missing.",
        "violations", predicates=(is_missing(column, trim=trim),),
    )


def unique(keys, name=None, severity=CRITICAL, rule=None, ignore_blank_keys=False) -> Check:
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    label = "_".join(keys)
    return Check(
        name or f"{label}_unique", "uniqueness", severity, rule or f"{', '.join(keys)} must be unique.",
        "duplicates", keys=keys, ignore_blank_keys=ignore_blank_keys,
    )


def in_domain(column, allowed, name=None, severity=CRITICAL, rule=None) -> Check:
    allowed = list(allowed)
    return Check(
        name or f"{column}_domain_valid", "validity", severity, rule or f"{column} must be one of: {allowed}.",
        "violations", predicates=(outside_domain(column, allowed),),
    )


def non_negative(column, name=None, severity=CRITICAL, rule=None) -> Check:
    return Check(
        name or f"{column}_non_negative", "accuracy", severity, rule or f"{column} must not be negative.",
        "violations", predicates=(is_negative(column),),
    )


def violation(name, predicate: Column | list, dimension="consistency", severity=CRITICAL, rule="") -> Check:
    preds = tuple(predicate) if isinstance(predicate, (list, tuple)) else (predicate,)
    return Check(name, dimension, severity, rule, "violations", predicates=preds)


def tracked(name, predicate: Column, dimension="completeness", rule="") -> Check:
    """Always PASS (warning); reports how many rows match ``predicate``."""
    return Check(name, dimension, WARNING, rule, "tracked", predicates=(predicate,))


# --- engine ---------------------------------------------------------------------------------------------------


def _check_struct(order: int, check: Check, count: Column | None, text: str | None, passed: Column) -> Column:
    observed_value = F.lit(text) if count is None else count.cast("string")
    return F.struct(
        F.lit(order).cast("int").alias("check_order"),
        F.lit(check.name).alias("name"),
        F.lit(check.dimension).alias("dimension"),
        F.lit(check.severity).alias("severity"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        observed_value.alias("observed_value"),
        (F.lit(None) if count is None else count).cast("bigint").alias("observed_count"),
        F.lit(check.rule).alias("rule"),
    )


def _sum_count_if(preds) -> Column:
    return reduce(lambda a, b: a + b, [F.count_if(F.coalesce(p, F.lit(False))) for p in preds])


def _short_circuit(columns, checks: list[Check]) -> bool:
    """A missing required column stops every data rule (only metadata and row count are reported)."""
    present = set(columns)
    return any(col not in present for c in checks if c.kind == "required_columns" for col in c.columns)


def row_rule_metrics(checks: list[Check], columns) -> dict[str, Column]:
    """The single global aggregate behind every row-level rule, as named aggregate expressions: ``_rows`` plus
    ``_c<order>`` per violation / tracked rule. ``evaluate`` computes exactly these in one aggregate; a writer can
    instead collect them while it writes (``DataFrame.observe``) and pass the values back as ``metrics``."""
    metrics = {"_rows": F.count(F.lit(1))}
    if _short_circuit(columns, checks):
        return metrics
    for order, check in enumerate(checks, start=1):
        if check.kind in ("violations", "tracked"):
            metrics[f"_c{order}"] = _sum_count_if(check.predicates)
    return metrics


def evaluate(df: DataFrame, checks: list[Check], metrics: dict | None = None) -> DataFrame:
    """All checks as one lazy DataFrame (one action to materialise).

    ``metrics``: values of :func:`row_rule_metrics` already collected (e.g. observed during the write of
    ``df``); then only the key-uniqueness rules read ``df``.
    """
    present = set(df.columns)
    short_circuit = _short_circuit(present, checks)

    def value(alias: str) -> Column:
        return F.col(alias) if metrics is None else F.lit(int(metrics[alias])).cast("bigint")

    global_aggs: list[Column] = [
        expr.alias(alias) for alias, expr in row_rule_metrics(checks, df.columns).items()
    ]
    structs_global: list = []  # (order, check, count, text, passed) on the global aggregate
    dup_branches: list[DataFrame] = []
    for order, check in enumerate(checks, start=1):
        if check.kind == "required_columns":
            miss = [col for col in check.columns if col not in present]
            structs_global.append((order, check, None, ", ".join(miss) if miss else "None", F.lit(not miss)))
        elif check.kind == "metadata":
            structs_global.append((order, check, None, check.observed, F.lit(bool(check.passed))))
        elif check.kind == "row_count":
            rows = value("_rows")
            ok = rows > 0 if check.target is None else rows == check.target
            structs_global.append((order, check, rows, None, ok))
        elif short_circuit:
            continue
        elif check.kind in ("violations", "tracked"):
            count = value(f"_c{order}")
            passed = F.lit(True) if check.kind == "tracked" else count == 0
            structs_global.append((order, check, count, None, passed))
        elif check.kind == "duplicates":
            keyed = df
            if check.ignore_blank_keys:
                keyed = df.filter(~reduce(lambda a, b: a | b, [is_missing(k) for k in check.keys]))
            per_key = keyed.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("_n"))
            dup = per_key.agg(F.count_if(F.col("_n") > 1).alias("_d"))
            dup_branches.append(
                dup.select(F.inline(F.array(_check_struct(order, check, F.col("_d"), None, F.col("_d") == 0))))
            )
        else:
            raise ValueError(f"unknown check kind {check.kind!r}")

    branches = list(dup_branches)
    if structs_global:
        # with precomputed metrics the global row is literal: no scan of df for the row rules
        carrier = df.agg(*global_aggs) if metrics is None else df.sparkSession.range(1)
        branches.insert(0, carrier.select(F.inline(F.array(*[_check_struct(*s) for s in structs_global]))))
    if not branches:
        raise ValueError("no checks to evaluate")
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    return out


@dataclass
class QualityResult:
    dataset: str
    checked_at_utc: str
    row_count: int | None
    column_count: int
    failed_critical_count: int
    checks: list[dict] = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return self.failed_critical_count == 0

    def as_dict(self) -> dict:
        return {
            "dataset": self.dataset,
            "checked_at_utc": self.checked_at_utc,
            "row_count": self.row_count,
            "column_count": self.column_count,
            "failed_critical_count": self.failed_critical_count,
            "checks": self.checks,
        }


def run_checks(df: DataFrame, checks: list[Check], dataset: str, sink_path: str | None = None,
               sink_format: str = "parquet", metrics: dict | None = None) -> QualityResult:
    """Evaluate and materialise (one action). The collected rows are the aggregated checks (tens of rows).

    With ``sink_path`` the check rows are first appended to a check table there (with dataset, run id and check
    time), and this run's rows are read back from it, so the table and the returned result are the same rows.
    """
    checked_at = _dt.datetime.now(_dt.timezone.utc)
    evaluated = evaluate(df, checks, metrics)
    if sink_path:
        run_id = uuid.uuid4().hex
        (
            evaluated.withColumn("dataset", F.lit(dataset))
            .withColumn("run_id", F.lit(run_id))
            .withColumn("checked_at_utc", F.lit(checked_at.replace(tzinfo=None)).cast("timestamp"))
            .write.format(sink_format).mode("append").save(sink_path)
        )
        evaluated = df.sparkSession.read.format(sink_format).load(sink_path).filter(F.col("run_id") == run_id)
    rows = sorted(evaluated.collect(), key=lambda r: r["check_order"])
    result_checks = []
    row_count = None
    kinds = {i: c.kind for i, c in enumerate(checks, start=1)}
    for r in rows:
        observed = r["observed_count"] if r["observed_count"] is not None else r["observed_value"]
        if kinds[r["check_order"]] == "row_count" and row_count is None:
            row_count = r["observed_count"]
        result_checks.append(
            {
                "name": r["name"],
                "dimension": r["dimension"],
                "severity": r["severity"],
                "status": r["status"],
                "observed_value": observed,
                "rule": r["rule"],
            }
        )
    failed = sum(1 for c in result_checks if c["severity"] == CRITICAL and c["status"] == "FAIL")
    return QualityResult(
        dataset=dataset,
        checked_at_utc=checked_at.isoformat(),
        row_count=row_count,
        column_count=len(df.columns),
        failed_critical_count=failed,
        checks=result_checks,
    )


def summary(checks_df: DataFrame, dataset: str, column_count: int) -> DataFrame:
    """One-row summary computed on Spark from the check DataFrame (A9 failed-critical roll-up)."""
    return checks_df.agg(
        F.lit(dataset).alias("dataset"),
        F.max(F.when(F.col("name") == "row_count_positive", F.col("observed_count"))).alias("row_count"),
        F.lit(column_count).alias("column_count"),
        F.count_if((F.col("severity") == CRITICAL) & (F.col("status") == "FAIL")).cast("bigint").alias(
            "failed_critical_count"
        ),
        F.count(F.lit(1)).alias("check_count"),
    )


class QualityGateError(RuntimeError):
    pass


def enforce(df: DataFrame, checks: list[Check], stage: str, metrics: dict | None = None) -> QualityResult:
    """Validator (V1/V2): raise on the first failing critical check in declared order, else return the result.
    ``metrics``: row-rule values observed earlier (see :func:`row_rule_metrics`)."""
    result = run_checks(df, checks, stage, metrics=metrics)
    for c in result.checks:
        if c["severity"] == CRITICAL and c["status"] == "FAIL":
            raise ValueError(f"{stage}: check {c['name']} failed (observed {c['observed_value']}): {c['rule']}")
    return result
