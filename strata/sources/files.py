"""File sources: the contract CSV reader (S1), layer readers (S2, S3) and file checksums."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources import blocks
from strata.spec import RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def read_contract_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_SCHEMA,
    mode: str = "FAILFAST",
    enforce_header: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Explicit all-string schema, header row, never inferred.

    ``enforce_header`` (``enforceSchema=false``) makes Spark compare the file header with the schema names and
    fail on a reordered or renamed header instead of silently mapping by position. ``mode="PERMISSIVE"`` with
    ``keep_corrupt`` adds ``_corrupt_record`` so an admission check can count malformed lines; FAILFAST only
    raises for rows and columns actually parsed, so a count-only validation does not prove the file is clean.
    """
    if keep_corrupt:
        schema = StructType(list(schema.fields) + [StructField(CORRUPT_COLUMN, StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", mode)
        .option("enforceSchema", not enforce_header)
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.csv(path)


def write_contract_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a raw feed as CSV with a header, keeping whitespace-only values (the writer trims by default).

    With the default mode an existing folder is never replaced: ``FileExistsError`` is raised instead.
    """
    try:
        (
            df.write.mode(mode)
            .option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    except AnalysisException as exc:
        if "PATH_ALREADY_EXISTS" in str(exc) or "already exists" in str(exc):
            raise FileExistsError(f"Refusing to overwrite {path}; pass force=True to replace it.") from exc
        raise


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer folder in ``fmt`` (``parquet`` by default; ``delta`` when its package is on the classpath)."""
    return spark.read.format(fmt).load(path)


def file_checksums(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True,
                   block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """(path, length, sha256, blocks) of every file that Spark lists under ``path``. Tasks stream the files, so a
    file may have any size; ``blocks`` holds the SHA-256 of every ``block_bytes`` of it, so that a damaged part can be
    found (:func:`strata.sources.blocks.damaged_blocks`)."""
    return blocks.file_digests(blocks.listed(spark, path, glob, recursive), block_bytes)


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, line): the first line of every file with any bytes. Tasks read the beginning of each file only."""
    return blocks.first_lines(blocks.listed(spark, path, recursive=False))
