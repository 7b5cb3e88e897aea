"""Distributed profiler.

Every profile is a Spark aggregate in long form, so it scales with the table and never keeps ids in driver
memory:

* ``missing_by_column``: ONE aggregate with a ``count_if`` per column, then a stack to long form;
* ``category_counts``: unpivot -> ``groupBy(column, value).count()``; the unpivot sits in the same stage as the
  partial aggregation, so one scan and one small shuffle serve every column;
* ``numeric_profile``: ONE aggregate of invalid / negative counts and min / max per column; numeric columns are taken
  as they are, text is compared as decimals of any size, exactly (blank or no finite number -> invalid);
* ``duplicate_keys``: ``groupBy(keys).count()`` with partial aggregation (hot keys collapse per task);
* ``profile_summary``: row count, schema diff and non-blank duplicate ids from ONE grouped pass over the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from strata.functions import is_blank, is_missing, strip_whitespace
from strata.functions.expr import decimal_key

MISSING_LABEL = "<missing>"


def _stripped(c: str) -> Column:
    return strip_whitespace(c)


def missing_by_column(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, missing_rows): NULL, or for text blank after stripping all whitespace."""
    columns = list(columns or df.columns)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    missing = [is_missing(c, strip_all_whitespace=True) if c in text else F.col(c).isNull() for c in columns]
    agg = df.agg(*[F.count_if(m).alias(f"_m{i}") for i, m in enumerate(missing)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing_rows"))
                      for i, c in enumerate(columns)])
    return agg.select(F.inline(pairs))


def category_counts(df: DataFrame, columns) -> DataFrame:
    """(column_name, category_value, row_count) with blank values labelled ``<missing>``; order by rows desc, value."""
    columns = list(columns)
    labelled = df.select(
        *[F.coalesce(F.nullif(_stripped(c), F.lit("")), F.lit(MISSING_LABEL)).alias(c) for c in columns]
    )
    long = labelled.unpivot([], columns, "column_name", "category_value")
    return long.groupBy("column_name", "category_value").agg(F.count(F.lit(1)).alias("row_count"))


def ordered_categories(counts: DataFrame) -> DataFrame:
    """Categories by descending count, value as deterministic tie-break."""
    return counts.orderBy("column_name", F.desc("row_count"), "category_value")


def parse_number(df: DataFrame, c: str) -> Column:
    """A numeric column itself, NULL where it is not finite; text as a sortable key of the decimal number that it
    holds, NULL when it holds none."""
    if not isinstance(df.schema[c].dataType, NumericType):
        return decimal_key(F.col(c).cast("string"))
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.col(c))
    return F.col(c)


def numeric_profile(df: DataFrame, columns) -> DataFrame:
    """(column_name, invalid_or_blank, negative, min_value, max_value, min_text, max_text) in one aggregate. The texts
    are the numbers as they are written (the first of several ways to write one), the values those as doubles."""
    columns = list(columns)
    aggs = []
    for i, c in enumerate(columns):
        v = parse_number(df, c)
        number = isinstance(df.schema[c].dataType, NumericType)
        both = F.when(v.isNotNull(), F.struct(v.alias("v"), F.trim(F.col(c).cast("string")).alias("text")))
        aggs += [
            F.count_if(v.isNull()).alias(f"_i{i}"),
            F.count_if(v < (0 if number else "1")).alias(f"_n{i}"),  # keys of negative numbers are before that of zero
            (F.min(v).cast("string") if number else F.min(both)["text"]).alias(f"_lo{i}"),
            (F.max(v).cast("string") if number else F.max(both)["text"]).alias(f"_hi{i}"),
        ]
    agg = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_i{i}").alias("invalid_or_blank"),
                F.col(f"_n{i}").alias("negative"),
                F.col(f"_lo{i}").cast("double").alias("min_value"),
                F.col(f"_hi{i}").cast("double").alias("max_value"),
                F.col(f"_lo{i}").alias("min_text"),
                F.col(f"_hi{i}").alias("max_text"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return agg.select(F.inline(rows))


def duplicate_keys(df: DataFrame, keys, ignore_blank_keys: bool = False) -> DataFrame:
    """One row: number of distinct key values occurring more than once, and the rows they cover."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if ignore_blank_keys:
        df = df.filter(~reduce(lambda a, b: a | b, [is_missing(k) for k in keys]))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("duplicated_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )


def schema_diff(columns, expected) -> dict:
    """Q25: missing and unexpected columns versus a contract (metadata only, no job)."""
    return {
        "missing_expected_columns": [c for c in expected if c not in columns],
        "unexpected_columns": [c for c in columns if c not in expected],
    }


def profile_summary(df: DataFrame, expected_columns, key: str) -> DataFrame:
    """Profile header in one grouped pass: row count, column count, missing / unexpected contract columns (Q25)
    and the number of non-blank key values occurring more than once (A4, blanks excluded).

    Rows are counted as the sum of the per-key counts, so the row count and the duplicate count share one
    shuffle of the key column (with partial aggregation per task).
    """
    diff = schema_diff(list(df.columns), list(expected_columns))
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(", ".join(diff["missing_expected_columns"]) or "None").alias("missing_expected_columns"),
        F.lit(", ".join(diff["unexpected_columns"]) or "None").alias("unexpected_columns"),
        F.count_if((F.col("_n") > 1) & ~is_missing(key)).alias("duplicate_key_values"),
    )


def sample_rows(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` the sample is deterministic (top-n, no full sort)."""
    if order_by:
        return df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)).limit(n)
    return df.limit(n)


def profile(df: DataFrame, expected_columns, key: str, categorical, numeric, sample_columns=None) -> dict:
    """The whole profile as lazy DataFrames plus metadata (row count is one small aggregate)."""
    columns = list(df.columns)
    return {
        "columns": columns,
        "column_count": len(columns),
        **schema_diff(columns, list(expected_columns)),
        "summary": profile_summary(df, expected_columns, key),
        "missing_by_column": missing_by_column(df),
        "categories": category_counts(df, [c for c in categorical if c in columns]),
        "numeric": numeric_profile(df, [c for c in numeric if c in columns]),
        "sample_rows": df.select(*(sample_columns or columns)).limit(5),
    }


__all__ = [
    "category_counts",
    "duplicate_keys",
    "is_blank",
    "missing_by_column",
    "numeric_profile",
    "ordered_categories",
    "parse_number",
    "profile",
    "profile_summary",
    "sample_rows",
    "schema_diff",
]
