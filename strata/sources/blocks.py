"""Files read and written by tasks, block by block.

The names come from Spark's own listing (``binaryFile`` without its content), which deals large files out to tasks of
their own. A task opens its files through Arrow's file systems (local folders, ``s3://``, ``gs://``, ``hdfs://``) and
never holds more than one block, so a file may have any size. A task that is lost starts its files anew: reading has
no effect, and a copy overwrites what the lost task had written of the same file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.session import ship_code

BLOCK_BYTES = 64 << 20
READ_BYTES = 1 << 20
#: bytes of a first line; a longer one is returned cut, so it equals no header
LINE_BYTES = 1 << 20


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it, for a path as Spark lists it (nothing in it is escaped)."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def listed(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length) of every file that Spark reads under ``path``; contents are not touched. Spark leaves out files
    without any bytes."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def per_file(files: DataFrame, columns: str, work: Callable[..., tuple]) -> DataFrame:
    """``files`` (path and whatever ``work`` needs) with the ``columns`` that ``work`` gives for each row."""
    more = StructType.fromDDL(columns)
    schema = StructType(files.schema.fields + more.fields)
    arrow = to_arrow_schema(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([row | dict(zip(more.names, work(**row)))], schema=arrow)

    ship_code(files.sparkSession)
    return files.mapInArrow(batches, schema)


def digests(blocks: Iterator[bytes], block_bytes: int) -> tuple[int, str, list[str]]:
    """Length, SHA-256 of the whole, and SHA-256 of every ``block_bytes`` of a stream of bytes."""
    whole, block, parts, length = hashlib.sha256(), hashlib.sha256(), [], 0
    for data in blocks:
        whole.update(data)
        view = memoryview(data)
        while len(view):
            room = block_bytes - length % block_bytes
            block.update(view[:room])
            length += min(room, len(view))
            view = view[room:]
            if length % block_bytes == 0:
                parts.append(block.hexdigest())
                block = hashlib.sha256()
    if length % block_bytes:
        parts.append(block.hexdigest())
    return length, whole.hexdigest(), parts


def stream(path: str, size: int = READ_BYTES) -> Iterator[bytes]:
    """The bytes of a file, in pieces."""
    fs, name = opened(path)
    with fs.open_input_stream(name, compression=None) as source:
        while data := source.read(size):
            yield data


def file_digests(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``files`` (path, ...) with ``sha256`` of each file and ``blocks``, that of every ``block_bytes`` of it."""
    def work(path: str, **_) -> tuple:
        _, whole, parts = digests(stream(path, min(READ_BYTES, block_bytes)), block_bytes)
        return whole, parts

    return per_file(files, "sha256 string, blocks array<string>", work)


def copied(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Copy every ``path`` to its ``target``; with the bytes written and their digests, taken on the way."""
    def work(path: str, target: str, **_) -> tuple:
        fs, name = opened(target)
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(name, compression=None) as out:
            def through() -> Iterator[bytes]:
                for data in stream(path):
                    out.write(data)
                    yield data

            return digests(through(), block_bytes)

    return per_file(files, "written long, sha256 string, blocks array<string>", work)


def first_lines(files: DataFrame) -> DataFrame:
    """``files`` with the first ``line`` of each. Only its beginning is read."""
    def work(path: str, **_) -> tuple:
        fs, name = opened(path)
        data = b""
        with fs.open_input_stream(name) as source:  # compressed files by their ending, as Spark reads them
            while b"\n" not in data and len(data) < LINE_BYTES and (more := source.read(1 << 12)):
                data += more
        line = data.partition(b"\n")[0].removesuffix(b"\r")
        return (line.decode("utf-8", "replace"),)

    return per_file(files, "line string", work)


def damaged_blocks(found: DataFrame, pins: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, first_byte) of every block of ``found`` (file, blocks) whose digest is not that of ``pins`` (file,
    blocks); a block that one side lacks is damaged too."""
    pairs = found.select("file", "blocks").join(pins.select("file", F.col("blocks").alias("pinned")), "file")
    each = pairs.select("file", F.posexplode(F.arrays_zip("blocks", "pinned")).alias("block", "both"))
    return each.where(~F.col("both.blocks").eqNullSafe(F.col("both.pinned"))).select(
        "file", "block", (F.col("block") * F.lit(block_bytes).cast("long")).alias("first_byte"))
