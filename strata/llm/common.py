"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.session import scratch_dir, ship_code  # noqa: F401
from strata.sources import fs

WHITESPACE = r"\x20\x09-\x0D"
WHITESPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The whole table, only the named columns."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, lineage cut, safe to re-read."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove the files of tables made by :func:`written` that nothing reads any more."""
    for table in tables:
        fs.delete(table.sparkSession, table.scratch_path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space, in order (no empty strings)."""
    return F.array_remove(F.split(text, f"[{WHITESPACE}]+"), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes of a string, as columns ``h1`` and ``h2``."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("second"), value).alias("h2")]
