"""Command line: one subcommand per stage, plus the whole run.

    python -m strata bronze   --input raw.csv --output lake/bronze/customer_churn
    python -m strata quality  --input lake/bronze/customer_churn --json-output q.json --markdown-output q.md
    python -m strata silver   --input lake/bronze/customer_churn --output lake/silver/customer_churn
    python -m strata gold     --input lake/silver/customer_churn --output-root lake/gold/customer_churn
    python -m strata verify   --layer gold --input lake/gold/customer_churn
    python -m strata copy     --src-root lake --dst-root lake_delta --dst-format delta
    python -m strata kpi-test --input lake/gold/customer_churn/gold_executive_kpis --expected kpis.json
    python -m strata profile  --input raw.csv --output profile.md
    python -m strata admit    --source landing.csv --destination raw/customer_churn [--force]
    python -m strata publish  --root lake --schema churn [--scope gold] [--register]
    python -m strata run      --input raw.csv --root lake --reports reports/

Every command builds (or reuses) a session with the session contract and leaves it running for the caller when
it already existed. Exit code 1 on a failed gate, validator, admission or KPI test.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from strata import spec as S
from strata.operators import quality, rulesets, verify
from strata.operators.bronze import run_timestamp, to_bronze
from strata.operators.silver import to_silver
from strata.plans import flow, publish
from strata.plans.lake import Lake
from strata.plans.layers import LayerPaths, copy_layers, write_layer, write_observed
from strata.plans.reports import build_profile_report, write_quality_reports
from strata.session import get_session
from strata.sources import fs
from strata.sources.files import read_contract_csv, read_layer


def _bronze(spark, a):
    bronze = to_bronze(read_contract_csv(spark, a.input), a.input, run_ts=run_timestamp(), blank_mode=a.blank_mode)
    checks = rulesets.bronze_validator()
    parent, _, name = a.output.rstrip("/").rpartition("/")
    staged = f"{parent}/_staging-{uuid.uuid4().hex[:12]}/{name}"
    metrics = write_observed(bronze, staged, quality.row_rule_metrics(checks, bronze.columns), a.format)
    quality.enforce(read_layer(spark, staged, a.format), checks, "bronze", metrics)
    fs.replace(spark, staged, a.output)
    fs.delete(spark, staged.rpartition("/")[0])
    print(f"bronze rows written: {metrics['_rows']}\nbronze output path: {a.output}")


def _quality(spark, a):
    result = quality.run_checks(read_layer(spark, a.input, a.format), rulesets.bronze_checks(), S.DATASET_NAME)
    write_quality_reports(spark, result, a.json_output, a.markdown_output)
    print(f"quality dataset: {result.dataset}\nrows checked: {result.row_count}\n"
          f"critical failures: {result.failed_critical_count}")
    if not result.passed:
        raise quality.QualityGateError("critical data quality checks failed")


def _silver(spark, a):
    silver = to_silver(read_layer(spark, a.input, a.format), run_ts=run_timestamp())
    quality.enforce(silver, rulesets.silver_validator(), "silver")
    rows = write_layer(silver, a.output, a.format)
    print(f"silver rows written: {rows}\nsilver output path: {a.output}")


def _gold(spark, a):
    root = a.output_root.rstrip("/")
    rows = flow.write_gold_tables(spark, read_layer(spark, a.input, a.format), lambda name: f"{root}/{name}",
                                  a.format, run_timestamp(), a.risk_order)
    for name, n in rows.items():
        print(f"{name}: wrote {n} rows to {root}/{name}")


def _verify(spark, a):
    if a.layer == "gold":
        frames = {name: read_layer(spark, f"{a.input.rstrip('/')}/{name}", a.format) for name in S.GOLD_TABLES}
        summary = verify.gold_summary(frames)
    else:
        df = read_layer(spark, a.input, a.format)
        summary = verify.bronze_summary(df) if a.layer == "bronze" else verify.silver_summary(df)
        frames = {a.layer: df}
    summary.show(100, truncate=False)
    for name, df in frames.items():
        print(name)
        df.printSchema()
        verify.preview(df, verify.PREVIEW_COLUMNS.get(name), a.rows).show(truncate=False)


def _copy(spark, a):
    for entry in copy_layers(spark, Lake(spark, a.src_root).paths(), LayerPaths(a.dst_root), a.src_format, a.dst_format):
        print(f"{a.dst_format} {entry['layer']} {entry['table']}: wrote {entry['rows']} rows to {entry['location']}")


def _kpi_test(spark, a):
    if a.expected == "public-sample":
        expected = dict(S.PUBLIC_SAMPLE_KPIS)
    else:
        expected = json.loads(fs.read_text(spark, a.expected))
    verify.assert_kpis(read_layer(spark, a.input, a.format), expected, a.tolerance)
    print("gold KPI tests passed")


def _profile(spark, a):
    raw = read_contract_csv(spark, a.input, enforce_header=False)
    text = build_profile_report(
        raw, a.input, S.RAW_COLUMNS, "customerID",
        list(S.PROFILE_CATEGORICAL), list(S.PROFILE_NUMERIC), list(S.PROFILE_SAMPLE),
        categories_path=f"{a.output}.categories",
    )
    fs.write_text(spark, a.output, text)
    print(f"report written to: {a.output}\n\n{text.partition('## Category')[0]}")


def _admit(spark, a):
    pins = json.loads(fs.read_text(spark, a.manifest)) if a.manifest else a.sha256
    rows = publish.promote(spark, a.source, a.destination, force=a.force, expected_rows=a.expected_rows,
                           id_prefix=a.id_prefix, checksum=pins)
    print(f"installed {rows} rows at {a.destination}")


def _publish(spark, a):
    entries = publish.discover_tables(spark, a.root, scope="all")
    for step in publish.publish(spark, entries, a.schema, a.format, a.scope, a.catalog, dry_run=not a.register):
        print(f"{step['action']}: {step['statement']}")


def _run(spark, a):
    reports = a.reports.rstrip("/") if a.reports else None
    summary = flow.run_layers(
        spark, a.input, a.root, a.format,
        json_report=f"{reports}/customer_churn_bronze_quality.json" if reports else None,
        markdown_report=f"{reports}/customer_churn_bronze_quality.md" if reports else None,
        blank_mode=a.blank_mode,
        risk_order=a.risk_order,
    )
    print(json.dumps({"bronze_rows": summary.bronze_rows, "silver_rows": summary.silver_rows,
                      "gold_rows": summary.gold_rows, "commit": summary.commit,
                      "failed_critical": summary.quality.failed_critical_count}))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def cmd(name, fn, help_text):
        c = sub.add_parser(name, help=help_text)
        c.set_defaults(fn=fn)
        c.add_argument("--format", default="parquet", help="layer format (parquet, or delta with its package)")
        c.add_argument("--profile", default="local", choices=["local", "cluster"],
                       help="session settings: 'cluster' starts from many shuffle partitions and larger splits")
        return c

    c = cmd("bronze", _bronze, "raw CSV -> bronze layer")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--blank-mode", default="default", choices=["default", "strict"])
    c = cmd("quality", _quality, "bronze quality gate with JSON and Markdown reports")
    c.add_argument("--input", required=True)
    c.add_argument("--json-output")
    c.add_argument("--markdown-output")
    c = cmd("silver", _silver, "bronze -> silver layer")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c = cmd("gold", _gold, "silver -> the five gold tables")
    c.add_argument("--input", required=True)
    c.add_argument("--output-root", required=True)
    c.add_argument("--risk-order", default="global", choices=list(flow.RISK_ORDERS))
    c = cmd("verify", _verify, "summaries, schemas and previews of a layer")
    c.add_argument("--layer", required=True, choices=["bronze", "silver", "gold"])
    c.add_argument("--input", required=True)
    c.add_argument("--rows", type=int, default=5)
    c = cmd("copy", _copy, "copy every layer table to another root / format")
    c.add_argument("--src-root", required=True)
    c.add_argument("--dst-root", required=True)
    c.add_argument("--src-format", default="parquet")
    c.add_argument("--dst-format", default="parquet")
    c = cmd("kpi-test", _kpi_test, "compare the executive KPI table with expected values")
    c.add_argument("--input", required=True)
    c.add_argument("--expected", required=True,
                   help="JSON file (column -> expected value) or 'public-sample' for the published KPIs")
    c.add_argument("--tolerance", type=float, default=0.01)
    c = cmd("profile", _profile, "profile a raw CSV into a Markdown report")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c = cmd("admit", _admit, "check a landing CSV and install it in the raw zone")
    c.add_argument("--source", required=True)
    c.add_argument("--destination", required=True)
    c.add_argument("--force", action="store_true")
    c.add_argument("--expected-rows", type=int)
    c.add_argument("--id-prefix")
    c.add_argument("--sha256", help="digest of a landing of one file")
    c.add_argument("--manifest", help="JSON file: file name -> SHA-256 of every file of the landing")
    c = cmd("publish", _publish, "register layer tables in the catalog (dry run unless --register)")
    c.add_argument("--root", required=True)
    c.add_argument("--schema", required=True)
    c.add_argument("--catalog")
    c.add_argument("--scope", default="gold", choices=list(publish.SCOPES))
    c.add_argument("--register", action="store_true")
    c = cmd("run", _run, "the whole layered run: ingest -> gate -> silver -> gold")
    c.add_argument("--input", required=True, help="landing CSV file or folder (contract header, 21 columns)")
    c.add_argument("--root", required=True, help="lake root; layers go to <root>/<layer>/customer_churn, a version folder a run")
    c.add_argument("--reports", help="folder for the JSON and Markdown quality reports")
    c.add_argument("--blank-mode", default="default", choices=["default", "strict"])
    c.add_argument("--risk-order", default="global", choices=list(flow.RISK_ORDERS))
    return p


FAILURES = (quality.QualityGateError, flow.LayerValidationError, publish.AdmissionError, FileExistsError,
            AssertionError, ValueError)


def main(argv=None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    spark = spark or get_session(app_name=f"strata-{args.command}", profile=args.profile,
                                 delta=args.format == "delta")
    try:
        args.fn(spark, args)
    except FAILURES as exc:
        print(f"error: {exc}", file=sys.stderr)
        return 1
    return 0

