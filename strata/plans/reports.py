"""Reports (K5-K7): the quality report as JSON and Markdown, and the profile as Markdown.

The inputs are already aggregated on Spark (tens of check rows, a few profile rows per column), so rendering
them as text on the driver is cheap. ``checks_json`` builds the same JSON on Spark for a table sink.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import QualityResult
from strata.sources import fs

# Titles, labels and column headings of the two reports ("--:" columns are right-aligned).
QUALITY_TITLE = "Bronze Customer Churn Data Quality Report"
QUALITY_FACTS = (("Dataset", "dataset"), ("Checked at UTC", "checked_at_utc"), ("Row count", "row_count"),
                 ("Column count", "column_count"), ("Failed critical checks", "failed_critical_count"))
CHECKS_HEADING = "Checks"
CHECK_COLUMNS = (("Check", "---", "name"), ("Dimension", "---", "dimension"), ("Severity", "---", "severity"),
                 ("Status", "---", "status"), ("Observed", "---:", "observed_value"), ("Rule", "---", "rule"))
PROFILE_TITLE = "Customer Churn Raw Data Profile"
PROFILE_FACTS = ("Input file", "Row count", "Column count")
SCHEMA_HEADING = "Schema Check"
SCHEMA_FACTS = ("Missing expected columns", "Unexpected columns")
MISSING_HEADING = "Missing Values"
MISSING_COLUMNS = (("Column", "---"), ("Missing rows", "---:"))
DUPLICATES_HEADING = "Duplicate {}"
DUPLICATES_FACT = "Duplicate `{}` values"
NUMERIC_HEADING = "Numeric Checks"
NUMERIC_COLUMNS = (("Column", "---"), ("Invalid/blank numeric values", "---:"), ("Negative values", "---:"),
                   ("Min", "---:"), ("Max", "---:"))
CATEGORIES_HEADING = "Category Distributions"
CATEGORY_COLUMNS = (("Value", "---"), ("Rows", "---:"))
SAMPLE_HEADING = "Sample Rows"

#: categories of one column that the page itself lists; the table beside it has them all
LISTED_CATEGORIES = 1000
ALL_CATEGORIES = "All values of every column, most frequent first: `{}`"


def _row(cells) -> str:
    return "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"


def _table(columns, rows) -> str:
    """A Markdown table; ``columns`` are (heading, alignment) pairs."""
    return "\n".join([_row(c[0] for c in columns), _row(c[1] for c in columns), *map(_row, rows)])


def _facts(pairs) -> str:
    return "\n".join(f"- {label}: `{value}`" for label, value in pairs)


def _document(*blocks: str) -> str:
    """Blocks of text with one empty line between them."""
    return "\n\n".join(blocks) + "\n"


def quality_json(result: QualityResult) -> str:
    return json.dumps(result.as_dict(), indent=2)


def quality_markdown(result: QualityResult, title: str = QUALITY_TITLE) -> str:
    return _document(
        f"# {title}",
        _facts((label, getattr(result, name)) for label, name in QUALITY_FACTS),
        f"## {CHECKS_HEADING}",
        _table(CHECK_COLUMNS, ([c[name] for _, _, name in CHECK_COLUMNS] for c in result.checks)))


def write_quality_reports(spark: SparkSession, result: QualityResult, json_path: str | None,
                          markdown_path: str | None) -> None:
    """Write the reports that have a path, on any file system."""
    for path, render in ((json_path, quality_json), (markdown_path, quality_markdown)):
        if path:
            fs.write_text(spark, path, render(result))


def checks_json(checks_df: DataFrame, dataset: str, column_count: int, checked_at: str) -> DataFrame:
    """One row with the report as JSON text, built on Spark (for writing next to the check table)."""
    ordered = F.array_sort(F.collect_list(F.struct(
        "check_order", "name", "dimension", "severity", "status", "observed_value", "rule")))
    return checks_df.agg(
        F.to_json(
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(checked_at).alias("checked_at_utc"),
                F.max(F.when(F.col("name") == "row_count_positive", F.col("observed_count"))).alias("row_count"),
                F.lit(column_count).alias("column_count"),
                F.count_if((F.col("severity") == "critical") & (F.col("status") == "FAIL")).alias(
                    "failed_critical_count"),
                ordered.alias("checks"),
            )
        ).alias("report")
    )


def build_profile_report(df: DataFrame, input_path: str, expected_columns, key: str, categorical, numeric,
                         sample_columns, title: str = PROFILE_TITLE, key_label: str = "Customer IDs",
                         categories_path: str | None = None) -> str:
    """V12 + K7: profile ``df`` on Spark and render the Markdown report. Only aggregated rows reach the driver: one
    per column, the most frequent categories of each categorical column, five sample rows. All categories, however
    many, are written by Spark as CSV to ``categories_path`` (column_name, category_value, row_count), in the order of
    the report, and the report is made from that table."""
    from strata.operators import profile as P

    prof = P.profile(df, expected_columns, key, categorical, numeric, sample_columns)
    head = prof["summary"].first()
    missing = {r["column_name"]: r["missing_rows"] for r in prof["missing_by_column"].collect()}
    numbers = {r["column_name"]: r for r in prof["numeric"].collect()}
    blocks = [
        f"# {title}",
        _facts(zip(PROFILE_FACTS, (input_path, head["row_count"], prof["column_count"]))),
        f"## {SCHEMA_HEADING}",
        _facts(zip(SCHEMA_FACTS, (", ".join(prof[k]) or "None" for k in ("missing_expected_columns",
                                                                         "unexpected_columns")))),
        f"## {MISSING_HEADING}",
        _table(MISSING_COLUMNS, ([c, missing[c]] for c in prof["columns"])),
        f"## {DUPLICATES_HEADING.format(key_label)}",
        _facts([(DUPLICATES_FACT.format(key), head["duplicate_key_values"])]),
        f"## {NUMERIC_HEADING}",
        _table(NUMERIC_COLUMNS, (
            [c, r["invalid_or_blank"], r["negative"], r["min_text"], r["max_text"]]
            for c, r in ((c, numbers[c]) for c in numeric if c in numbers))),
        f"## {CATEGORIES_HEADING}",
    ]
    categories = prof["categories"]
    if categories_path:
        P.ordered_categories(categories).write.mode("overwrite").option("header", True).option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(categories_path)
        categories = df.sparkSession.read.schema(categories.schema).option("header", True).csv(categories_path)
        blocks.append(ALL_CATEGORIES.format(categories_path))
    for column in categorical:
        ranked = categories.where(F.col("column_name") == column).orderBy(
            F.desc("row_count"), "category_value").limit(LISTED_CATEGORIES + 1).collect()
        rows = [[r["category_value"], r["row_count"]] for r in ranked]
        if len(rows) > LISTED_CATEGORIES:
            rows = rows[:LISTED_CATEGORIES] + [["(more values)", ""]]
        blocks += [f"### {column}", _table(CATEGORY_COLUMNS, rows)]
    blocks += [f"## {SAMPLE_HEADING}", _table([(c, "---") for c in sample_columns], prof["sample_rows"].collect())]
    return _document(*blocks)
