"""Publication (K8-K12): table naming, discovery by commit marker, catalog registration, scope selection, dry run, and landing
admission.

Registration uses the Spark catalog (``CREATE TABLE ... USING <fmt> LOCATION ...``): the data stays where the
layers wrote it. By default only the gold layer is published (governed exposure).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans.lake import Lake, entities
from strata.sources import blocks, fs
from strata.sources.files import CORRUPT_COLUMN, file_checksums, first_lines, read_contract_csv
from strata.spec import RAW_COLUMNS

SCOPES = ("all", "bronze", "silver", "gold")
COMMIT_MARKERS = ("_delta_log", "_SUCCESS")


def quote_identifier(identifier: str) -> str:
    """Back-tick quoting; embedded back-ticks are doubled."""
    return "`" + identifier.replace("`", "``") + "`"


def table_name_for(layer: str, folder: str) -> str:
    """Gold tables keep their folder name; bronze and silver tables get the layer as prefix."""
    return f"{layer}_{folder}" if layer in ("bronze", "silver") else folder


def discover_tables(spark: SparkSession, root: str, scope: str = "all") -> list[tuple[str, str, str]]:
    """K8 on any file system: the committed tables, as sorted (name, layer, location). Entities with commits
    (:mod:`strata.plans.lake`) have the tables of their last one. Others are found at
    ``<root>/<layer>/<entity>[/<table>]``: a table is a folder with a commit marker (``_SUCCESS`` or ``_delta_log``); its data files and
    partition folders are never listed, so the work follows the number of tables, not of files. Folders without a
    marker (unfinished writes) and hidden folders (staging) are no tables."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    base, found = root.rstrip("/"), []
    versioned = entities(spark, base)
    for entity in versioned:
        if commit := Lake(spark, base, entity).current():
            found += commit.registry(scope)

    def look(layer: str, location: str, depth: int) -> None:
        if any(fs.exists(spark, f"{location}/{m}") for m in COMMIT_MARKERS):
            found.append((table_name_for(layer, location.rsplit("/", 1)[-1]), layer, location))
        elif depth:
            for name in fs.folders(spark, location):
                if "=" not in name:
                    look(layer, f"{location}/{name}", depth - 1)

    for layer in SCOPES[1:] if scope == "all" else (scope,):
        for name in set(fs.folders(spark, f"{base}/{layer}")).difference(versioned):
            look(layer, f"{base}/{layer}/{name}", 2)
    return sorted(found)


def publish(
    spark: SparkSession,
    entries: list[tuple[str, str, str]],
    schema: str,
    fmt: str = "parquet",
    scope: str = "gold",
    catalog: str | None = None,
    dry_run: bool = True,
) -> list[dict]:
    """Register the tables of ``scope`` in the catalog (or only list the statements when ``dry_run``)."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    namespace = quote_identifier(schema)
    if catalog is not None:
        namespace = f"{quote_identifier(catalog)}.{namespace}"
    selected = [e for e in entries if scope == "all" or e[1] == scope]
    plan = [{"table": None, "layer": None, "location": None,
             "statement": f"CREATE SCHEMA IF NOT EXISTS {namespace}", "action": "create_schema"}]
    for name, layer, location in selected:
        location_sql = location.replace("'", "\\'")
        plan.append({
            "table": name,
            "layer": layer,
            "location": location,
            "statement": f"CREATE TABLE IF NOT EXISTS {namespace}.{quote_identifier(name)} USING {fmt} "
                         f"LOCATION '{location_sql}'",
            "action": "register",
        })
    if not dry_run:
        for step in plan:
            spark.sql(step["statement"])
            if step["table"] and fmt != "delta":
                table = f"{namespace}.{quote_identifier(step['table'])}"
                point_at(spark, table, step["location"])
                recover_partitions(spark, table)
    for step in plan:
        step["action"] = ("would_" if dry_run else "") + step["action"]
    return plan


def point_at(spark: SparkSession, table: str, location: str) -> None:
    """Let a registered table read another version of its layer; one that already does is left alone."""
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if rows["Location"].rstrip("/").removeprefix("file:") != location.rstrip("/").removeprefix("file:"):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location.replace(chr(39), chr(92) + chr(39))}'")
        spark.sql(f"REFRESH TABLE {table}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register the ``key=value`` folders of a partitioned layer; a table without any needs none."""
    columns = [r[0] for r in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    if "# Partition Information" in columns:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def register_temp_views(spark: SparkSession, entries: list[tuple[str, str, str]], fmt: str = "parquet",
                        scope: str = "all") -> list[str]:
    """Expose layer tables outside the governed (gold) catalog scope as session-scoped temporary views,
    only on request. Returns the view names."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    names = []
    for name, layer, location in entries:
        if scope == "all" or layer == scope:
            spark.read.format(fmt).load(location).createOrReplaceTempView(name)
            names.append(name)
    return names


# --- landing admission (K12, Q20-Q24) ------------------------------------------------------------------------


def _check(order: int, name: str, dimension: str, count, rule: str) -> list:
    """The columns of one critical check row from its number of violations."""
    return [F.lit(order).alias("check_order"), F.lit(name).alias("name"), F.lit(dimension).alias("dimension"),
            F.lit("critical").alias("severity"), F.when(count == 0, "PASS").otherwise("FAIL").alias("status"),
            count.cast("string").alias("observed_value"), count.cast("bigint").alias("observed_count"),
            F.lit(rule).alias("rule")]


def header_violations(spark: SparkSession, path: str, contract=RAW_COLUMNS) -> DataFrame:
    """One row (n): files of ``path`` whose first line is not the contract header, empty files included (Q20)."""
    files = len(spark.read.text(path).inputFiles())  # of Spark's own index, which has the empty ones too
    matching = F.count_if(F.regexp_replace("line", '^\ufeff|"', "") == F.lit(",".join(contract)))
    return first_lines(spark, path).agg((F.lit(files) - matching).alias("n"))


Pins = str | dict[str, str] | DataFrame


def checksum_rows(spark: SparkSession, path: str, pins: DataFrame, recursive: bool = False) -> DataFrame:
    """Q24: (file, length, sha256, pin, status) of every file under ``path`` and of every pin (file, pin): FAIL for a
    digest other than the pinned one, a file without a pin, and a pin without a file."""
    sums = file_checksums(spark, path, recursive=recursive).withColumn("file", F.element_at(F.split("path", "/"), -1))
    both = sums.select("file", "length", "sha256").join(pins.select("file", "pin"), "file", "full")
    return both.withColumn("status", F.when(F.col("sha256") == F.col("pin"), "PASS").otherwise("FAIL"))


def checksum_violations(spark: SparkSession, path: str, pins: Pins) -> DataFrame:
    """One row (n): the rows of :func:`checksum_rows` that fail. ``pins`` is the digest of a single file, a manifest
    (file name -> digest), or a table (file, pin). Exactly the files that are read are hashed."""
    if isinstance(pins, str):
        # one pin is one file: none or several files are violations too
        return file_checksums(spark, path, recursive=False).agg(
            (F.count_if(F.col("sha256") != pins) + F.abs(F.count(F.lit(1)) - 1)).alias("n"))
    if isinstance(pins, dict):
        pins = spark.createDataFrame(sorted(pins.items()), "file string, pin string")
    rows = checksum_rows(spark, path, pins)
    return rows.agg((F.count_if(F.col("status") == "FAIL") + F.when(F.count("length") == 0, 1).otherwise(0)).alias("n"))


def install(spark: SparkSession, path: str, destination: str, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """Copy the files of ``path`` (a file or a folder) byte for byte below ``destination`` by tasks, and return what
    was written: (file, length, written, sha256, blocks). A lost task writes its files again; nothing passes through the
    driver but their names."""
    files = blocks.listed(spark, path, recursive=False)
    single = fs.is_file(spark, path)
    target = F.lit(destination) if single else F.concat(F.lit(f"{destination.rstrip('/')}/"), F.col("file"))
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).withColumn("target", target)
    done = blocks.copied(files, block_bytes).drop("path", "target")
    manifest = f"{destination.rstrip('/').rpartition('/')[0]}/_manifest"
    done.write.mode("overwrite").parquet(manifest)  # the copy runs once
    return spark.read.schema(done.schema).parquet(manifest)


def admit(spark: SparkSession, path: str, expected_rows: int | None = None, id_column: str = "customerID",
          id_prefix: str | None = None, checksum: Pins | None = None,
          contract=RAW_COLUMNS) -> DataFrame:
    """Admission checks (Q20-Q24) of a landing CSV, a file or a folder of files, as a check DataFrame.

    The first line of every file is compared with the contract (names and order). The rows are read PERMISSIVE with a
    corrupt-record column, so malformed lines are counted instead of failing the job; row count, malformed lines and
    id prefix are one aggregate. ``checksum``: see :func:`checksum_violations`.
    """
    contract = list(contract)
    raw = read_contract_csv(spark, path, mode="PERMISSIVE", enforce_header=False, keep_corrupt=True)
    checks = [
        Q.row_count_positive(name="file_not_empty", rule="File must contain data rows."),
        # a line is malformed when the parser flags it or when no contract field holds a value (e.g. ",,,,");
        # the predicate reads every contract column, so every line is fully parsed
        Q.violation("malformed_rows",
                    F.col(CORRUPT_COLUMN).isNotNull() | F.coalesce(*[F.col(c) for c in contract]).isNull(),
                    dimension="validity", rule="Every line must parse with the contract schema."),
    ]
    if expected_rows is not None:
        checks.append(Q.row_count_equals(expected_rows))
    if id_prefix is not None:
        checks.append(Q.violation(
            "id_prefix", ~F.coalesce(F.col(id_column).startswith(id_prefix), F.lit(False)), dimension="validity",
            rule=f"{id_column} must start with {id_prefix}.",
        ))
    out = header_violations(spark, path, contract).select(*_check(
        1, "header_matches_contract", "validity", F.col("n"), "Every header must equal the contract columns in order."))
    rows = Q.evaluate(raw, checks)
    out = out.unionByName(rows.withColumn("check_order", F.col("check_order") + 1))
    if checksum is not None:
        out = out.unionByName(checksum_violations(spark, path, checksum).select(*_check(
            len(checks) + 2, "checksum_matches", "integrity", F.col("n"), "Files must match the pinned SHA-256.")))
    return out


class AdmissionError(RuntimeError):
    pass


def promote(spark: SparkSession, path: str, destination: str, force: bool = False, **admit_kwargs) -> int:
    """Install the landing files byte for byte. Tasks copy them to a staging name beside ``destination``, the checks
    run on that copy, and a rename puts it in place; refuses to overwrite unless ``force``, and even then what was there
    stays until the rename. Returns the number of rows installed."""
    if not force and fs.exists(spark, destination):
        raise FileExistsError(f"Refusing to overwrite {destination}; pass force=True to replace it.")
    parent, _, name = destination.rstrip("/").rpartition("/")
    staged = f"{parent}/_installing-{uuid.uuid4().hex[:12]}/{name}"
    try:
        copies = install(spark, path, staged)
        short = copies.where("written != length").count()
        if short:
            raise AdmissionError(f"{short} files changed while they were copied")
        # rows of the copy: the name of a hidden folder does not matter to a path given in full
        rows = admit(spark, staged, **admit_kwargs).collect()
        failed = [r for r in rows if r["status"] == "FAIL"]
        if failed:
            raise AdmissionError("; ".join(f"{r['name']}={r['observed_value']}" for r in failed))
        fs.replace(spark, staged, destination)
    except AnalysisException as exc:
        raise AdmissionError(str(exc)) from exc
    finally:
        fs.delete(spark, staged.rpartition("/")[0])
    return next(r["observed_count"] for r in rows if r["name"] == "file_not_empty")
