"""The layered run (L1, L3): CSV -> bronze -> quality gate -> silver -> gold, stopping at the first failure.

Each layer is written as a table and the next layer reads the written table, so lineage is cut at every layer
boundary (a lost executor recomputes at most one layer) and every stage reads pruned Parquet, never the CSV again.

Spark actions per run (versus ~50 single-purpose actions in a job-per-check design):

1. bronze write: the CSV is parsed exactly once (the costliest step at scale); the row count and every row-level
   gate rule (``count_if``) are observed by the write itself (``DataFrame.observe``);
2. bronze checks on the written Parquet: key uniqueness only (one key-column scan and shuffle), combined with the
   observed metrics into the validator rules (V1) and all gate rules (V4). Both reports are written, then a
   failing validator or critical rule raises, so no downstream layer ever reads an unchecked bronze;
3. silver validator (V2) on the planned silver: one scan of a few pruned bronze columns, before the write, so an
   invalid silver is never written (key uniqueness is inherited from the bronze gate: silver keeps the key 1:1);
4. silver write (row count observed);
5. gold aggregates: every segment summary and the KPIs from ONE grouping-sets aggregate, checkpointed to the
   shared checkpoint folder (a few rows) and split into four tables: one job, one tiny count, four tiny writes;
6. customer risk table: one sampled range-partitioned sort and write.

Validating the CSV source before writing would parse it twice. Here every run writes to version folders of its own, the
gate reads the bronze of the run, and one small commit file at the end makes all layers of the run the current ones
(``strata.plans.lake``): no reader ever sees a bronze that has not passed or layers of different runs, and the last good
layers survive a run that fails or is killed at any step.

A rerun commits the same tables again (idempotent, L3): the commit holds fingerprints of their rows, observed by the
writes, and equal runs have equal ones.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold, quality, rulesets
from strata.operators.bronze import run_timestamp, to_bronze
from strata.operators.silver import to_silver
from strata.plans.lake import Lake
from strata.plans.layers import LayerPaths, fingerprint, plain_fingerprint, write_layer, write_observed
from strata.sources import fs
from strata.plans.reports import write_quality_reports
from strata.session import checkpoint_root
from strata.sources.files import read_contract_csv, read_layer
from strata.spec import GOLD_TABLES, SUBSCRIBER, SubscriberSpec


@dataclass
class RunSummary:
    paths: LayerPaths
    bronze_rows: int | None = None
    silver_rows: int | None = None
    gold_rows: dict = field(default_factory=dict)
    fingerprints: dict = field(default_factory=dict)
    commit: int | None = None
    quality: quality.QualityResult | None = None


class LayerValidationError(ValueError):
    pass


def ingest_bronze(spark: SparkSession, source: str | DataFrame, paths: LayerPaths, fmt: str = "parquet",
                  run_ts=None, blank_mode: str = "default", spec: SubscriberSpec = SUBSCRIBER,
                  source_label: str | None = None, fingerprints: dict | None = None) -> tuple[int, dict]:
    """Parse the source once and write bronze (K1). The row-level gate rules are observed by the same write, so
    the gate afterwards only shuffles the key. Returns (rows written, observed rule metrics)."""
    raw = read_contract_csv(spark, source) if isinstance(source, str) else source
    label = source_label or (source if isinstance(source, str) else "dataframe")
    bronze = to_bronze(raw, label, run_ts=run_ts, spec=spec, blank_mode=blank_mode)
    wanted = quality.row_rule_metrics(rulesets.bronze_checks(spec), bronze.columns)
    if fingerprints is not None:
        wanted |= {f"_print_{k}": v for k, v in fingerprint(bronze.columns).items()}
    metrics = write_observed(bronze, paths.bronze, wanted, fmt)
    if fingerprints is not None:
        seen = {k: metrics.pop(f"_print_{k}") for k in fingerprint([])}
        fingerprints[f"bronze_{paths.entity}"] = plain_fingerprint(seen)
    return int(metrics["_rows"]), metrics


def validator_check_names(spec: SubscriberSpec = SUBSCRIBER) -> set[str]:
    """The bronze validator (V1) inside the bronze rule set: rows, key uniqueness, missing key."""
    return {"row_count_positive", f"{spec.key}_unique", f"{spec.key}_not_null"}


def quality_gate(spark: SparkSession, paths: LayerPaths, fmt: str = "parquet", json_report: str | None = None,
                 markdown_report: str | None = None, spec: SubscriberSpec = SUBSCRIBER,
                 checks_table: str | None = None, metrics: dict | None = None) -> quality.QualityResult:
    """V1 + V4 in one job on the written bronze: write both reports (and append the check rows to
    ``checks_table`` when given), then raise on a validator failure (``LayerValidationError``) or any other
    critical failure (``QualityGateError``); warnings pass. With ``metrics`` observed by the bronze write, the
    job only checks key uniqueness (one key-column scan and shuffle)."""
    bronze = read_layer(spark, paths.bronze, fmt)
    result = quality.run_checks(bronze, rulesets.bronze_checks(spec), spec.dataset, sink_path=checks_table,
                                metrics=metrics)
    write_quality_reports(spark, result, json_report, markdown_report)
    validator = validator_check_names(spec)
    for c in result.checks:
        if c["name"] in validator and c["status"] == "FAIL":
            raise LayerValidationError(f"bronze: check {c['name']} failed (observed {c['observed_value']})")
    if not result.passed:
        raise quality.QualityGateError(
            f"{result.failed_critical_count} critical data quality checks failed for {spec.dataset}")
    return result


def build_silver(spark: SparkSession, paths: LayerPaths, fmt: str = "parquet", run_ts=None,
                 spec: SubscriberSpec = SUBSCRIBER, keys_verified: bool = False,
                 fingerprints: dict | None = None) -> int:
    """V2 on the planned silver, then the write. Silver is a row-wise projection of bronze with the key
    unchanged, so when the bronze gate of this run already proved the key unique (``keys_verified``) the
    uniqueness rule is not re-run: V2 is then one scan of a few pruned columns instead of a full key shuffle."""
    silver = to_silver(read_layer(spark, paths.bronze, fmt), run_ts=run_ts, spec=spec)
    checks = rulesets.silver_validator(spec)
    if keys_verified:
        checks = [c for c in checks if c.kind != "duplicates"]
    quality.enforce(silver, checks, "silver")
    return write_layer(silver, paths.silver, fmt, "overwrite", fingerprints, f"silver_{paths.entity}")


RISK_ORDERS = ("global", "partition")


def build_gold(spark: SparkSession, paths: LayerPaths, fmt: str = "parquet", run_ts=None,
               risk_order: str = "global", fingerprints: dict | None = None) -> dict[str, int]:
    """The five gold tables of ``paths`` from its written silver (see :func:`write_gold_tables`)."""
    return write_gold_tables(spark, read_layer(spark, paths.silver, fmt), paths.gold, fmt, run_ts, risk_order,
                             fingerprints)


def write_gold_tables(spark: SparkSession, silver: DataFrame, path_of, fmt: str = "parquet", run_ts=None,
                      risk_order: str = "global", fingerprints: dict | None = None) -> dict[str, int]:
    """Write the five gold tables to ``path_of(table name)``; returns the row count of each.

    The four aggregate tables come from one grouping-sets aggregate checkpointed to the shared checkpoint folder.
    ``risk_order="global"`` writes the customer-risk table in one total order (sampled range partitioning: one
    shuffle of the table); ``"partition"`` sorts each file only (no shuffle), for readers that need per-file order
    or the top-k, which ``gold.risk_top`` serves without any sort."""
    if risk_order not in RISK_ORDERS:
        raise ValueError(f"risk_order must be one of {RISK_ORDERS}")
    checkpoint_root(spark)
    # one range sort for all segment tables (O1 within each); their rows keep that order when they are split
    order = ("segment", F.desc("churn_rate_pct"), F.desc("total_customers"), F.asc_nulls_first("segment_value"))
    segments = [*gold.SEGMENT_TABLES.values(), "__total__"]
    seen = Observation(f"gold_{uuid.uuid4().hex[:12]}")
    multi = gold.gold_aggregates_one_scan(silver).orderBy(*order).observe(
        seen, *[F.count_if(F.col("segment") == s).alias(s) for s in segments],
        F.max("total_customers").alias("customers")).checkpoint(eager=True)
    counts = dict(seen.get)
    tables = gold.split_gold_aggregates(multi, run_ts, ordered=False)
    # validate every table before any write (V3), then build the write plans
    plans = {}
    for name in GOLD_TABLES:
        if name == "gold_customer_risk_summary":
            continue
        segment = gold.SEGMENT_TABLES.get(name, "__total__")
        if not counts.get(segment):
            raise LayerValidationError(f"{name} has zero rows.")
        plans[name] = tables[name]
    if not counts["customers"]:
        raise LayerValidationError("gold_executive_kpis: no customers (a global aggregate always has one row).")
    if risk_order == "global":
        risk = gold.customer_risk(silver, run_ts)
    else:
        risk = gold.customer_risk(silver, run_ts, ordered=False).sortWithinPartitions(*gold.risk_order())

    # the five writes are independent actions: submit them together (the tiny ones overlap the large one); the
    # threads inherit the caller's Spark local properties (job group, description, scheduler pool)
    write = inheritable_thread_target(spark)(write_layer)
    with ThreadPoolExecutor(max_workers=len(GOLD_TABLES)) as pool:
        small = {name: pool.submit(write, table, path_of(name), fmt, "overwrite", fingerprints, name)
                 for name, table in plans.items()}
        risk_future = pool.submit(write, risk, path_of("gold_customer_risk_summary"), fmt, "overwrite", fingerprints,
                                  "gold_customer_risk_summary")
        for future in small.values():
            future.result()
        risk_rows = risk_future.result()
    if not risk_rows:
        raise LayerValidationError("gold_customer_risk_summary has zero rows.")
    written = {name: counts[gold.SEGMENT_TABLES.get(name, "__total__")] for name in plans}
    written["gold_customer_risk_summary"] = risk_rows
    return {name: written[name] for name in GOLD_TABLES}


def run_layers(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    fmt: str = "parquet",
    json_report: str | None = None,
    markdown_report: str | None = None,
    run_ts=None,
    blank_mode: str = "default",
    spec: SubscriberSpec = SUBSCRIBER,
    source_label: str | None = None,
    checks_table: str | None = None,
    risk_order: str = "global",
) -> RunSummary:
    """Ingest -> gate -> silver -> gold -> commit; a failing stage raises and the later stages do not run.

    ``checks_table``: a folder where every run appends its bronze check rows (an audit table of the gate).
    All layers are written to version folders of the run; the commit at the end makes them the current ones together
    (see :mod:`strata.plans.lake`). With ``fmt="delta"`` the layers have plain paths and Delta's own commits; bronze
    is gated as Parquet in a staging folder first."""
    run_ts = run_ts or run_timestamp()
    lake = Lake(spark, root, spec.entity)
    delta = fmt == "delta"
    paths = LayerPaths(root, spec.entity) if delta else lake.begin()
    summary, seen = RunSummary(paths), {}
    first = LayerPaths(f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex[:12]}", spec.entity) if delta else paths
    summary.bronze_rows, metrics = ingest_bronze(spark, source, first, "parquet" if delta else fmt, run_ts, blank_mode,
                                                 spec, source_label, seen)
    summary.quality = quality_gate(spark, first, "parquet" if delta else fmt, json_report, markdown_report, spec,
                                   checks_table, metrics)
    if delta:
        write_layer(read_layer(spark, first.bronze), paths.bronze, fmt)
        fs.delete(spark, first.root)
    summary.silver_rows = build_silver(spark, paths, fmt, run_ts, spec, keys_verified=True, fingerprints=seen)
    summary.gold_rows = build_gold(spark, paths, fmt, run_ts, risk_order, seen)
    summary.fingerprints = seen
    if not delta:
        summary.commit = lake.commit(paths, seen).number
    return summary


def read_gold(spark: SparkSession, root: str, table: str, fmt: str = "parquet",
              spec: SubscriberSpec = SUBSCRIBER) -> DataFrame:
    """A gold table of the last commit (of the plain folder where nothing has been committed)."""
    return read_layer(spark, Lake(spark, root, spec.entity).location(table), fmt)
