"""Query catalogue: every registered query reads the driver tables (or frames Spark derives from them).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Most are lazy; those that check written tables run the
writes when they are called and return the tables read back. Paths are left out of the compared queries (they differ
per run); every computed column carries the alias used by the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import band, exact_avg, exact_sum, round_half_up, threshold_band
from strata.operators import gold, profile, quality, rulesets, unique, verify
from strata.operators.bronze import to_bronze
from strata.operators.silver import to_silver
from strata.plans import flow, publish
from strata.plans.lake import Lake
from strata.plans.layers import LayerPaths, copy_layers, fingerprint
from strata.session import scratch_dir
from strata.sources import blocks, fs
from strata.sources.feed import OPTION_MULTIPLIERS, dirty_feed, feed_columns, subscriber_feed
from strata.sources.files import file_checksums, write_contract_csv
from strata.spec import GOLD_TABLES, PROFILE_CATEGORICAL, RAW_COLUMNS

FEED_SOURCE = "derived:orders"
# a fixed run timestamp for the compared layers, so the lineage checks see a populated value
FIXED_RUN_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed(spark, sf_dir, dirty: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return dirty_feed(orders) if dirty else subscriber_feed(orders)


def bronze(spark, sf_dir, dirty: bool = False) -> DataFrame:
    return to_bronze(feed(spark, sf_dir, dirty), FEED_SOURCE, run_ts=FIXED_RUN_TS)


def silver(spark, sf_dir) -> DataFrame:
    return to_silver(bronze(spark, sf_dir), run_ts=FIXED_RUN_TS)


# --- subscriber layers ----------------------------------------------------------------------------------------


def q_feed_bronze(spark, sf_dir):
    """The bronze layer of the derived feed (without the run timestamp)."""
    return bronze(spark, sf_dir).drop("ingested_at_utc")


def q_feed_silver(spark, sf_dir):
    """The silver layer of the derived feed (without timestamps)."""
    return silver(spark, sf_dir).drop("ingested_at_utc", "silver_transformed_at_utc")


def _segment(by):
    def q(spark, sf_dir):
        return gold.segment_rate_summary(silver(spark, sf_dir), by, with_timestamp=False)

    return q


q_churn_by_contract = _segment("contract")
q_churn_by_tenure_band = _segment("tenure_band")
q_churn_by_payment_group = _segment("payment_method_group")


def q_churn_by_segments(spark, sf_dir):
    """A1 as GROUPING SETS: all three segment summaries and the KPIs from one scan."""
    return gold.gold_aggregates_one_scan(silver(spark, sf_dir))


def q_customer_risk(spark, sf_dir):
    """Row-level risk score and level, in the total risk order."""
    return gold.customer_risk(silver(spark, sf_dir), with_timestamp=False)


def q_risk_level_counts(spark, sf_dir):
    """Customers, churned customers and score range per risk level."""
    return gold.risk_level_counts(silver(spark, sf_dir))


def q_risk_top100(spark, sf_dir):
    """O2 top-k: the 100 riskiest customers (per-task top-k and merge, no full sort)."""
    return gold.risk_top(silver(spark, sf_dir), 100)


def q_executive_kpis(spark, sf_dir):
    """A2: the executive KPIs (one global aggregate)."""
    return gold.executive_kpis(silver(spark, sf_dir), with_timestamp=False)


# --- quality --------------------------------------------------------------------------------------------------


def q_quality_bronze(spark, sf_dir):
    """Q1-Q19: the bronze gate on the clean feed (one action)."""
    return quality.evaluate(bronze(spark, sf_dir), rulesets.bronze_checks())


def q_quality_dirty(spark, sf_dir):
    """Q1-Q19 on the fault-injected feed: each fault fails exactly its check."""
    return quality.evaluate(bronze(spark, sf_dir, dirty=True), rulesets.bronze_checks())


def q_quality_silver(spark, sf_dir):
    """V2: the silver validator as a check table."""
    return quality.evaluate(silver(spark, sf_dir), rulesets.silver_validator())


def q_quality_orders(spark, sf_dir):
    """Rule engine on orders: keys, domains, non-negative price, timeliness."""
    return quality.evaluate(table(spark, sf_dir, "orders"), rulesets.orders_checks())


def q_quality_lineitem(spark, sf_dir):
    """Rule engine on lineitem: composite-key uniqueness (fails), domains, ranges."""
    return quality.evaluate(table(spark, sf_dir, "lineitem"), rulesets.lineitem_checks())


def q_quality_events(spark, sf_dir):
    """Rule engine on events: key uniqueness, domain, non-negative value, timeliness."""
    return quality.evaluate(table(spark, sf_dir, "events"), rulesets.events_checks())


def q_dup_keys_lineitem(spark, sf_dir):
    """A4: repeated (l_orderkey, l_linenumber) keys (11,785 at sf0.01)."""
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dup_keys_conversations(spark, sf_dir):
    """A4: repeated (conv_id, turn) keys."""
    return profile.duplicate_keys(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


def q_unique_orders(spark, sf_dir):
    """A4, Q4: the key of ``orders`` proven unique by sorted runs of hashes; only keys that may repeat are shuffled."""
    return unique.repeated_keys(table(spark, sf_dir, "orders"), "o_orderkey")


def q_unique_lineitem(spark, sf_dir):
    """A4, Q4: repeated (order, line) keys of ``lineitem``, counted in the same way."""
    return unique.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_negative_balance(spark, sf_dir):
    """Negative balances of customers and suppliers."""
    parts = []
    for name, c in (("customer", "c_acctbal"), ("supplier", "s_acctbal")):
        parts.append(
            table(spark, sf_dir, name).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(F.col(c) < 0).alias("negative_rows"),
                F.min(c).alias("min_balance"),
            )
        )
    return parts[0].unionByName(parts[1])


# --- profiling ------------------------------------------------------------------------------------------------


def q_profile_missing(spark, sf_dir):
    """Missing values per column of documents, customer and the raw feed."""
    docs = profile.missing_by_column(table(spark, sf_dir, "documents")).withColumn("table_name", F.lit("documents"))
    cust = profile.missing_by_column(table(spark, sf_dir, "customer")).withColumn("table_name", F.lit("customer"))
    raw = profile.missing_by_column(feed(spark, sf_dir)).withColumn("table_name", F.lit("feed"))
    return docs.unionByName(cust).unionByName(raw)


FEED_CATEGORICAL = list(PROFILE_CATEGORICAL)


def q_profile_categories(spark, sf_dir):
    """Category distributions of orders, the feed derived from orders, part and events. Orders and its feed share
    one projection of one scan (their column names do not collide)."""
    orders = table(spark, sf_dir, "orders")
    derived = feed_columns(orders)
    order_cols = ["o_orderstatus", "o_orderpriority"]
    both = orders.select(*order_cols, *[derived[c].alias(c) for c in FEED_CATEGORICAL])
    out = profile.category_counts(both, order_cols + FEED_CATEGORICAL).withColumn(
        "table_name", F.when(F.col("column_name").isin(order_cols), F.lit("orders")).otherwise(F.lit("feed")))
    for name, cols in (("part", ["p_type", "p_brand"]), ("events", ["event_type"])):
        counts = profile.category_counts(table(spark, sf_dir, name), cols).withColumn("table_name", F.lit(name))
        out = out.unionByName(counts)
    return out


def q_profile_numeric(spark, sf_dir):
    """Invalid, negative, min and max of numeric text and numeric columns."""
    raw = profile.numeric_profile(feed(spark, sf_dir), ["tenure", "MonthlyCharges", "TotalCharges"])
    li = profile.numeric_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    both = raw.withColumn("table_name", F.lit("feed")).unionByName(li.withColumn("table_name", F.lit("lineitem")))
    return both.drop("min_text", "max_text")


def q_profile_decimals(spark, sf_dir):
    """Exact extremes of numbers as text: 17 digits before the point, and exponents beyond any numeric type;
    every fiftieth value is no number."""
    key, text = F.col("o_orderkey"), lambda c: F.lpad(c.cast("string"), 16, "0")
    long = F.concat(F.when(key % 3 == 0, "-").otherwise(""), F.lit("1"), text(key), F.lit("."),
                    F.lpad((key % 100).cast("string"), 2, "0"))
    written = table(spark, sf_dir, "orders").select(
        F.when(key % 50 == 0, F.lit("12,5")).otherwise(long).alias("long"),
        F.concat((key % 7).cast("string"), F.lit("e"), (key % 500).cast("string")).alias("exponent"))
    found = profile.numeric_profile(written, ["long", "exponent"])
    return found.select("column_name", "invalid_or_blank", "negative", "min_text", "max_text")


def q_profile_summary(spark, sf_dir):
    """Profile header of the clean and the fault-injected raw feed against the 21-column contract."""
    clean = profile.profile_summary(feed(spark, sf_dir), RAW_COLUMNS, "customerID")
    dirty = profile.profile_summary(feed(spark, sf_dir, dirty=True).drop("Churn").withColumn("extra", F.lit("x")),
                                    RAW_COLUMNS, "customerID")
    return clean.withColumn("feed", F.lit("clean")).unionByName(dirty.withColumn("feed", F.lit("dirty")))


def q_profile_feed_duplicates(spark, sf_dir):
    """A4 without blank keys: repeated ids of the fault-injected feed."""
    return profile.duplicate_keys(feed(spark, sf_dir, dirty=True), "customerID", ignore_blank_keys=True)


# --- generic segment rates and bands on the native tables -----------------------------------------------------


def q_rate_by_priority(spark, sf_dir):
    """A1 on orders: finished-order rate by priority."""
    return gold.segment_rate_summary(
        table(spark, sf_dir, "orders"), "o_orderpriority",
        flag=F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        measures={"avg_totalprice": "o_totalprice"},
        count_name="orders", flagged_name="finished_orders", rate_name="finished_rate_pct",
        with_timestamp=False,
    )


def q_rate_by_event_type(spark, sf_dir):
    """A1 on events: high-value rate by event type."""
    return gold.segment_rate_summary(
        table(spark, sf_dir, "events"), "event_type",
        flag=F.when(F.col("value") >= 100, 1).otherwise(0),
        measures={"avg_value": "value"},
        count_name="events", flagged_name="high_value_events", rate_name="high_value_rate_pct",
        with_timestamp=False,
    )


def q_toxic_rate_by_quality(spark, sf_dir):
    """A1 on labels: toxic rate by quality label."""
    return gold.segment_rate_summary(
        table(spark, sf_dir, "labels"), "quality", flag="toxic", measures={},
        count_name="documents", flagged_name="toxic_documents", rate_name="toxic_rate_pct",
        with_timestamp=False,
    )


# Band parameters for the native tables (free choices of these example queries).
BALANCE_BANDS = ((0, "negative"), (1000, "low"), (5000, "medium"))
PART_SIZE_BANDS = ((1, 10, "small"), (11, 25, "medium"), (26, 40, "large"))


def q_balance_band(spark, sf_dir):
    """P13 threshold bands of customer balances."""
    cust = table(spark, sf_dir, "customer")
    banded = cust.withColumn("balance_band", threshold_band("c_acctbal", BALANCE_BANDS, "high", op="<"))
    return banded.groupBy("balance_band").agg(
        F.count(F.lit(1)).alias("customers"),
        round_half_up(exact_avg("c_acctbal"), 2).alias("avg_balance"),
    )


def q_part_size_band(spark, sf_dir):
    """P12 integer bands of part sizes."""
    part = table(spark, sf_dir, "part")
    banded = part.withColumn("size_band", band("p_size", PART_SIZE_BANDS, "extra_large"))
    return banded.groupBy("size_band").agg(
        F.count(F.lit(1)).alias("parts"),
        round_half_up(exact_avg("p_retailprice"), 2).alias("avg_retailprice"),
    )


def q_kpis_lineitem(spark, sf_dir):
    """A2 on lineitem: line count, returns, quantity, price and exact net revenue."""
    li = table(spark, sf_dir, "lineitem")
    return li.agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned_lines"),
        round_half_up(F.avg(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)) * 100, 2).alias("return_rate_pct"),
        round_half_up(exact_sum("l_quantity"), 2).alias("total_quantity"),
        round_half_up(exact_avg("l_extendedprice"), 2).alias("avg_extendedprice"),
        round_half_up(exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("net_revenue"),
    )


OPTIONS = tuple(name for name, _ in OPTION_MULTIPLIERS)


# --- verification, round trip, admission, publication, checksums ------------------------------------------------


_LAYERS: dict[tuple[str, str], str] = {}


def run_feed(spark, source, root: str, **options) -> flow.RunSummary:
    return flow.run_layers(spark, source, root, run_ts=FIXED_RUN_TS, source_label=FEED_SOURCE, **options)


def written_layers(spark, sf_dir) -> str:
    """L1 on the derived feed: root of a complete layered run under the shared scratch folder, made once for a session
    and a table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS:
        root = f"{scratch_dir(spark, 'layers')}/lake"
        run_feed(spark, feed(spark, sf_dir), root)
        _LAYERS[key] = root
    return _LAYERS[key]


def run_text(column: str):
    """The run timestamp of a layer as text, so that it is compared like any other value."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def q_layer_summary(spark, sf_dir):
    """V6-V8: rows, columns and tracked counts of every table of a layered run, read back."""
    root = written_layers(spark, sf_dir)
    paths = Lake(spark, root).paths()
    tables = {name: flow.read_gold(spark, root, name) for name in GOLD_TABLES}
    return (
        verify.bronze_summary(spark.read.parquet(paths.bronze))
        .unionByName(verify.silver_summary(spark.read.parquet(paths.silver)))
        .unionByName(verify.gold_summary(tables))
    )


def q_written_segments(spark, sf_dir):
    """K2, A1a-c, P18: the three segment tables of a layered run, read back with their run timestamp."""
    root = written_layers(spark, sf_dir)
    parts = [flow.read_gold(spark, root, name).withColumnRenamed(by, "segment_value").withColumn("segment", F.lit(by))
             for name, by in gold.SEGMENT_TABLES.items()]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("gold_created_at_utc", run_text("gold_created_at_utc"))


def q_written_risk(spark, sf_dir):
    """The customer-risk table of a layered run, read back."""
    risk = flow.read_gold(spark, written_layers(spark, sf_dir), "gold_customer_risk_summary")
    return risk.withColumn("gold_created_at_utc", run_text("gold_created_at_utc"))


def q_copied_silver(spark, sf_dir):
    """Silver of a layered run, copied with every other layer to a second root and read back there."""
    root = written_layers(spark, sf_dir)
    target = LayerPaths(scratch_dir(spark, "copied"))
    copy_layers(spark, Lake(spark, root).paths(), target)
    copied = spark.read.parquet(target.silver)
    return copied.withColumns({c: run_text(c) for c in ("ingested_at_utc", "silver_transformed_at_utc")})


def expected_kpis_from_orders(orders: DataFrame) -> DataFrame:
    """All seven KPIs straight from ``orders``: the feed's charge is 18.25 + (floor(price) % 10051)/100 a month, billed
    for ``key * 31 % 73`` months; an order counts as churned when its status is F."""
    derived = feed_columns(orders)
    cents = F.lit(1825) + F.floor(F.col("o_totalprice")) % 10051
    months = (F.col("o_orderkey") * 31) % 73
    services = sum(F.when(derived[c] == "Yes", 1).otherwise(0) for c in ("PhoneService", *OPTIONS))
    churned = F.count_if(F.col("o_orderstatus") == "F")
    rows = F.count(F.lit(1))
    return orders.agg(
        rows.alias("total_customers"),
        churned.alias("churned_customers"),
        round_half_up(churned / rows * 100, 2).alias("overall_churn_rate_pct"),
        round_half_up(F.avg(cents) / 100, 2).alias("avg_monthly_charges"),
        round_half_up(F.sum(cents) / 100, 2).alias("estimated_monthly_revenue"),
        round_half_up(F.avg(cents * months) / 100, 2).alias("avg_total_charges"),
        round_half_up(F.avg(services), 2).alias("avg_active_service_count"),
    )


def q_kpi_reconciliation(spark, sf_dir):
    """V5: all seven gold KPIs reconciled with the same numbers computed from the source table."""
    actual = gold.executive_kpis(silver(spark, sf_dir), with_timestamp=False)
    return verify.kpi_comparison(actual, expected_kpis_from_orders(table(spark, sf_dir, "orders")))


def q_quality_summary(spark, sf_dir):
    """The failed-critical roll-up of the gate on the fault-injected feed."""
    dirty = bronze(spark, sf_dir, dirty=True)
    return quality.summary(quality.evaluate(dirty, rulesets.bronze_checks()), "bronze.customer_churn",
                           len(dirty.columns))


def q_quality_missing_column(spark, sf_dir):
    """Q1: a bronze without one of its required columns fails the first check; only the row count is
    checked beside it."""
    return quality.evaluate(bronze(spark, sf_dir).drop("contract"), rulesets.bronze_checks())


def q_layers_roundtrip(spark, sf_dir):
    """The feed as a contract CSV, every layer written and gated, gold KPIs read back."""
    base = scratch_dir(spark, "roundtrip")
    write_contract_csv(feed(spark, sf_dir), f"{base}/landing")
    flow.run_layers(spark, f"{base}/landing", f"{base}/layers", run_ts=FIXED_RUN_TS)
    return flow.read_gold(spark, f"{base}/layers", "gold_executive_kpis").drop("gold_created_at_utc")


def q_published_kpis(spark, sf_dir):
    """The gold tables of a layered run are discovered, registered in a catalog schema of their own, and the
    KPI table is read through the catalog. The schema is dropped again; its tables are external, so the data stays."""
    found = publish.discover_tables(spark, written_layers(spark, sf_dir), scope="gold")
    schema = f"strata_{uuid.uuid4().hex[:12]}"
    publish.publish(spark, found, schema, dry_run=False)
    kpis = spark.table(f"{schema}.gold_executive_kpis").drop("gold_created_at_utc")
    spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return kpis


def q_admission(spark, sf_dir):
    """Admission checks of a landing of two parts (expected rows = orders); odd keys landed with the
    first two columns swapped, header included. How many files a part has may differ, so the header check shows 1."""
    base = scratch_dir(spark, "admission")
    odd = F.substring("customerID", -1, 1).isin("1", "3", "5", "7", "9")
    raw = feed(spark, sf_dir)
    swapped = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    write_contract_csv(raw.where(~odd), f"{base}/landing/part-a")
    write_contract_csv(raw.where(odd).select(*swapped), f"{base}/landing/part-b")
    expected = table(spark, sf_dir, "orders").count()
    checks = publish.admit(spark, f"{base}/landing/part-*", expected_rows=expected, id_prefix="C")
    shown = F.when(F.col("name") == "header_matches_contract", F.least("observed_count", F.lit(1))).otherwise(
        F.col("observed_count"))
    return checks.withColumn("observed_count", shown).withColumn("observed_value", shown.cast("string"))


def q_lake_versions(spark, sf_dir):
    """K1, K2, L1: a run commits its layers; a second one, on the fault-injected feed, is stopped by the gate, and
    readers still find the layers of the first through the commit."""
    root = scratch_dir(spark, "versions")
    run_feed(spark, feed(spark, sf_dir), root)
    try:
        run_feed(spark, feed(spark, sf_dir, dirty=True), root)
    except (quality.QualityGateError, flow.LayerValidationError) as stopped:
        outcome = type(stopped).__name__
    lake = Lake(spark, root)
    runs = [n for n in fs.folders(spark, LayerPaths(root).bronze) if n.startswith("v-")]
    kpis = flow.read_gold(spark, root, "gold_executive_kpis").select("total_customers", "churned_customers")
    bronze_rows = spark.read.parquet(lake.paths().bronze).agg(F.count(F.lit(1)).alias("bronze_rows"))
    return kpis.crossJoin(bronze_rows).select(
        F.lit(lake.current().number).cast("bigint").alias("commit_number"),
        F.lit(len(runs)).cast("bigint").alias("runs"), F.lit(outcome).alias("second_run"), "*")


def q_layer_fingerprints(spark, sf_dir):
    """L3, K4: a second run of the same feed and a copy of all seven tables have the fingerprints of the first run,
    observed by the writes; both are compared with those of the tables read back."""
    root = written_layers(spark, sf_dir)
    first = Lake(spark, root).current()
    again = run_feed(spark, feed(spark, sf_dir), scratch_dir(spark, "again"))
    copies = copy_layers(spark, Lake(spark, root).paths(), LayerPaths(scratch_dir(spark, "copies")))
    out = None
    for entry in copies:
        name, seen = entry["table"], first.fingerprints[entry["table"]]
        read = spark.read.parquet(entry["location"])
        row = read.agg(*[v.alias(k) for k, v in fingerprint(read.columns).items()]).select(
            F.lit(name).alias("table_name"), F.lit(entry["layer"]).alias("layer"), "rows",
            F.lit(again.fingerprints[name] == seen).alias("same_again"),
            (F.lit(entry["fingerprint"] == seen) & (F.col("first") == seen["first"])
             & (F.col("second") == seen["second"])).alias("same_copy"))
        out = row if out is None else out.unionByName(row)
    return out


def q_layer_checks(spark, sf_dir):
    """V4, V10, V11, each failing: the gate of a fault-injected feed, its written report, and the completeness of a lake
    that lacks one expected table and has one that nobody expects."""
    root, base = written_layers(spark, sf_dir), scratch_dir(spark, "checks")
    report = f"{base}/quality.json"
    try:
        run_feed(spark, feed(spark, sf_dir, dirty=True), f"{base}/lake", json_report=report)
        gate = "passed"
    except (quality.QualityGateError, flow.LayerValidationError) as stopped:
        gate = type(stopped).__name__
    wanted = [n for n, _, _ in LayerPaths(root).registry()]
    states = verify.layer_completeness(spark, root, [*wanted[1:], "gold_churn_by_region"])
    rows = [("V4", "gate", gate)] + [("V10", name, state) for name, state in states]
    rows += [("V11", "report", p) for p in verify.report_regression(spark, report, "bronze.customer_churn", 25)]
    return spark.createDataFrame(rows, "check string, subject string, outcome string")


FILE_DOCS = 100


def document_files(spark, sf_dir, name: str) -> str:
    """The texts of ``documents`` as plain files of ``FILE_DOCS`` consecutive doc_ids each, one text after another."""
    folder = scratch_dir(spark, name)
    docs = table(spark, sf_dir, "documents").select(
        F.expr(f"doc_id div {FILE_DOCS}").alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    docs.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy(
        "part").text(folder)
    return folder


def text_pins(spark, sf_dir) -> DataFrame:
    """(part, pin): the SHA-256 that each file of :func:`document_files` must have, from the texts themselves; that of
    part 1 is wrong."""
    docs = table(spark, sf_dir, "documents").groupBy(F.expr(f"doc_id div {FILE_DOCS}").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))).alias("docs"))
    whole = F.concat(F.array_join(F.transform("docs", lambda d: d["text"]), "\n"), F.lit("\n"))
    return docs.select("part", F.when(F.col("part") == 1, F.lit("0" * 64)).otherwise(F.sha2(whole, 256)).alias("pin"))


def part_of(path: str):
    """The part folder in the path of a document file."""
    return F.regexp_extract(path, "part=([0-9]+)", 1).cast("bigint").alias("part")


def q_file_checksums(spark, sf_dir):
    """Files written from ``documents``, streamed and hashed by tasks, against one pin for each; the pin of one
    part is wrong. ``n_blocks``: digests of 64 KB parts."""
    folder = document_files(spark, sf_dir, "files")
    sums = file_checksums(spark, folder, block_bytes=1 << 16)
    rows = sums.select(part_of("path"), "length", "sha256", F.size("blocks").cast("bigint").alias("n_blocks"))
    return rows.join(text_pins(spark, sf_dir), "part", "full").select(
        "part", "length", "sha256", "n_blocks",
        F.when(F.col("sha256").eqNullSafe(F.col("pin")), "PASS").otherwise("FAIL").alias("status"))


def q_installed_files(spark, sf_dir):
    """The same files installed by tasks: bytes written, and the digests of the copies read back."""
    folder = document_files(spark, sf_dir, "landing")
    flat = f"{scratch_dir(spark, 'flat')}/files"
    names = blocks.listed(spark, folder).withColumn("target", F.concat(F.lit(f"{flat}/"), part_of("path"), F.lit(".txt")))
    written = blocks.copied(names).agg(F.sum("written").alias("staged_bytes"))
    staged = written.first()["staged_bytes"]  # one number; the copy has run
    zone = f"{scratch_dir(spark, 'zone')}/documents"
    copies = publish.install(spark, flat, zone)
    back = file_checksums(spark, zone).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("sha256").alias("read_back"))
    return copies.join(back, "file").select(
        F.regexp_extract("file", "[0-9]+", 0).cast("bigint").alias("part"), "length", "written", "sha256",
        (F.col("read_back") == F.col("sha256")).alias("same"), F.lit(staged).cast("bigint").alias("staged_bytes"))


def q_text_checksums(spark, sf_dir):
    """SHA-256 of every whole document text (digests of files: q_file_checksums)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


def usage_records(spark, sf_dir) -> DataFrame:
    """Every event as a usage record (usage_date in UTC, customer, amount)."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("usage_date"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type"),
        F.col("value").alias("revenue"),
    )


def q_usage_quality(spark, sf_dir):
    """The daily-usage rules on events as usage records."""
    return quality.evaluate(usage_records(spark, sf_dir), rulesets.usage_checks())


def q_usage_daily(spark, sf_dir):
    """Daily rollup: records, distinct customers (two-level aggregate, no driver set) and revenue."""
    return usage_records(spark, sf_dir).groupBy("usage_date").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("customer_id").alias("active_customers"),
        round_half_up(exact_sum("revenue"), 2).alias("revenue"),
    )


def message_records(spark, sf_dir) -> DataFrame:
    """Every conversation turn as a (label, message) record with its content hash and length."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select(
        F.col("role").alias("label"),
        F.col("text").alias("message"),
        F.sha2(F.col("text"), 256).alias("message_sha256"),
        F.length("text").alias("message_length"),
    )


def q_message_quality(spark, sf_dir):
    """The message-feed rules on conversations."""
    return quality.evaluate(message_records(spark, sf_dir), rulesets.message_checks())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_feed_bronze": q_feed_bronze,
    "q_feed_silver": q_feed_silver,
    "q_churn_by_contract": q_churn_by_contract,
    "q_churn_by_tenure_band": q_churn_by_tenure_band,
    "q_churn_by_payment_group": q_churn_by_payment_group,
    "q_churn_by_segments": q_churn_by_segments,
    "q_customer_risk": q_customer_risk,
    "q_risk_level_counts": q_risk_level_counts,
    "q_risk_top100": q_risk_top100,
    "q_executive_kpis": q_executive_kpis,
    "q_quality_bronze": q_quality_bronze,
    "q_quality_dirty": q_quality_dirty,
    "q_quality_silver": q_quality_silver,
    "q_quality_orders": q_quality_orders,
    "q_quality_lineitem": q_quality_lineitem,
    "q_quality_events": q_quality_events,
    "q_dup_keys_lineitem": q_dup_keys_lineitem,
    "q_dup_keys_conversations": q_dup_keys_conversations,
    "q_unique_orders": q_unique_orders,
    "q_unique_lineitem": q_unique_lineitem,
    "q_negative_balance": q_negative_balance,
    "q_profile_missing": q_profile_missing,
    "q_profile_categories": q_profile_categories,
    "q_profile_numeric": q_profile_numeric,
    "q_profile_decimals": q_profile_decimals,
    "q_profile_feed_duplicates": q_profile_feed_duplicates,
    "q_profile_summary": q_profile_summary,
    "q_rate_by_priority": q_rate_by_priority,
    "q_rate_by_event_type": q_rate_by_event_type,
    "q_toxic_rate_by_quality": q_toxic_rate_by_quality,
    "q_balance_band": q_balance_band,
    "q_part_size_band": q_part_size_band,
    "q_kpis_lineitem": q_kpis_lineitem,
    "q_layer_summary": q_layer_summary,
    "q_kpi_reconciliation": q_kpi_reconciliation,
    "q_layers_roundtrip": q_layers_roundtrip,
    "q_admission": q_admission,
    "q_published_kpis": q_published_kpis,
    "q_text_checksums": q_text_checksums,
    "q_file_checksums": q_file_checksums,
    "q_installed_files": q_installed_files,
    "q_lake_versions": q_lake_versions,
    "q_layer_fingerprints": q_layer_fingerprints,
    "q_layer_checks": q_layer_checks,
    "q_written_segments": q_written_segments,
    "q_written_risk": q_written_risk,
    "q_copied_silver": q_copied_silver,
    "q_quality_summary": q_quality_summary,
    "q_quality_missing_column": q_quality_missing_column,
    "q_usage_quality": q_usage_quality,
    "q_usage_daily": q_usage_daily,
    "q_message_quality": q_message_quality,
}
