"""Token files: the ids of all documents one after another, with Elias-Fano encoded boundaries.

Documents are range-partitioned and sorted by doc_id. A task encodes its texts and emits blocks of about ``BLOCK_IDS``
ids; Spark writes the blocks as plain files through its commit protocol (a lost task leaves nothing behind) on any
file system it knows, and reads them back as binary files. A block is

    magic, length of the block, shard, number of the block in the shard, bytes per id, documents, null doc_ids, ids
    Elias-Fano sequence of the doc_ids (differences to the first)
    Elias-Fano sequence of the end offsets of the documents
    the ids, two bytes each when the vocabulary allows it, else four

followed by one newline (the record separator of the writer). An Elias-Fano sequence of n values up to u takes
n * (2 + log2(u / n)) bits: the low bits packed, the high bits in unary, and the position of every 128th one for
``select``, which finds the offset of any document without decoding the others.

Defined results: a null or empty text is one end id; rows with a null doc_id come first; repeated doc_ids follow each
other in the order of a hash of their texts; a very long text is a block of its own; an empty table gives an empty file; further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from strata.llm.common import ship_code, text_or_empty, written
from strata.llm.tokens import encoder

BLOCK_IDS = 1 << 20
BLOCK_DOCS = 1 << 16
BLOCKS_PER_FILE = 8
MAGIC = b"EFTK"
HEADER = struct.Struct("<4sQIIBIIQ")
EF_HEADER = struct.Struct("<IQB")
SAMPLE = 128


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``top``."""

    def __init__(self, size: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.size, self.top, self.low_bits, self.low, self.high, self.samples = size, top, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        size, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // size).bit_length() - 1) if size else 0
        wanted = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> wanted) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        high = np.zeros((int(ones[-1]) + 8) // 8 if size else 0, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(size, top, low_bits, low, high, ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return EF_HEADER.pack(self.size, self.top, self.low_bits) + b"".join(
            x.tobytes() for x in (self.low, self.high, self.samples))

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence at ``at`` and the position after it."""
        size, top, low_bits = EF_HEADER.unpack_from(data, at)
        at += EF_HEADER.size
        parts = []
        for kind, n in (("u1", (size * low_bits + 7) // 8), ("u1", ((top >> low_bits) + size + 7) // 8 if size else 0),
                        ("<u4", -(-size // SAMPLE))):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(size, top, low_bits, *parts), at

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and the bytes up to its one."""
        at, rank = int(self.samples[i // SAMPLE]), i // SAMPLE * SAMPLE
        byte = at >> 3
        left = i - rank + 1
        value = int(self.high[byte]) & (0xFF << (at & 7))
        while value.bit_count() < left:
            left -= value.bit_count()
            byte += 1
            value = int(self.high[byte])
        for _ in range(left - 1):
            value &= value - 1
        position = 8 * byte + (value & -value).bit_length() - 1
        first = i * self.low_bits
        some = int.from_bytes(self.low[first >> 3:(first + self.low_bits + 7) >> 3].tobytes(), "little")
        low = some >> (first & 7) & ((1 << self.low_bits) - 1)
        return (position - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.size]
        bits = np.unpackbits(self.low, bitorder="little")[:self.size * self.low_bits]
        bits = bits.reshape(self.size, self.low_bits).astype(np.int64)
        low = (bits << np.arange(self.low_bits)).sum(axis=1) if self.low_bits else 0
        return ((ones - np.arange(self.size)) << self.low_bits) + low


def make_block(shard: int, number: int, docs: list[int | None], sizes: list[int], ids: bytes, width: int) -> bytes:
    """One block; ``ids`` are the little-endian unsigned 32-bit ids of all its documents, in ascending doc_id order."""
    known = np.array([d for d in docs if d is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    body = struct.pack("<q", first) + EliasFano.of(known - first).to_bytes()
    body += EliasFano.of(np.cumsum(np.array(sizes, np.int64))).to_bytes()
    body += ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return HEADER.pack(MAGIC, HEADER.size + len(body), shard, number, width, len(docs), len(docs) - len(known),
                       len(ids) // 4) + body


class Block:
    """A block read back: ``doc_ids``, ``ends`` (Elias-Fano) and ``ids_of`` each document."""

    def __init__(self, data: memoryview, at: int = 0):
        magic, self.length, self.shard, self.number, self.width, self.docs, nulls, self.ids = HEADER.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a token block")
        here = at + HEADER.size
        (first,) = struct.unpack_from("<q", data, here)
        known, here = EliasFano.from_bytes(data, here + 8)
        self.doc_ids = [None] * nulls + (known.all() + first).tolist()
        self.ends, here = EliasFano.from_bytes(data, here)
        self.data = np.frombuffer(data, "<u2" if self.width == 2 else "<u4", self.ids, here)

    def span(self, i: int) -> tuple[int, int]:
        """Start and end of document i among the ids of the block, through ``select``."""
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def ids_of(self, start: int, end: int) -> bytes:
        return self.data[start:end].astype("<u4").tobytes()


def blocks_of(content: bytes) -> Iterator[Block]:
    """The blocks of one file."""
    data, at = memoryview(content), 0
    while at < len(data):
        block = Block(data, at)
        yield block
        at += block.length + 1


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int,
                      block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents in ascending doc_id order; shard k holds smaller doc_ids than shard k + 1."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        docs, sizes, parts, total = [], [], [], 0

        def block() -> pa.RecordBatch:
            made = make_block(shard, number, docs, sizes, b"".join(parts), 2 if vocabulary <= 1 << 16 else 4)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])

        for batch in source:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("_t"))):
                docs.append(doc)
                sizes.append(len(ids) // 4 + 1)
                parts += (ids, end)
                total += sizes[-1]
                if total >= block_ids or len(docs) >= BLOCK_DOCS:
                    yield block()
                    docs, sizes, parts, total, number = [], [], [], 0, number + 1
        if docs:
            yield block()

    spark = docs.sparkSession
    ship_code(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_t"))
    ordered = chosen.repartitionByRange(shards, "doc_id", F.xxhash64("_t")).sortWithinPartitions(
        "doc_id", F.xxhash64("_t"))
    (ordered.mapInArrow(batches, "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", BLOCKS_PER_FILE).text(folder))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document: shard, block, doc_id, start (in the block), n_tokens, ids_crc32, block_ids, and the ids."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for content in batch.column("content"):
                for block in blocks_of(content.as_buffer()):
                    ends = np.array([block.ends.select(i) for i in range(block.docs)], np.int64)
                    starts = np.concatenate(([0], ends[:-1]))
                    ids = [block.ids_of(a, b) for a, b in zip(starts.tolist(), ends.tolist())]
                    same = lambda x, kind: pa.array(np.full(block.docs, x), kind)
                    columns = [same(block.shard, pa.int32()), same(block.number, pa.int32()),
                               pa.array(block.doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                               pa.array(ends - starts, pa.int64()),
                               pa.array([zlib.crc32(x) for x in ids], pa.int64()), same(block.ids, pa.int64())]
                    names = ["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32", "block_ids"]
                    if with_ids:
                        columns.append(pa.array(ids, pa.binary()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    ship_code(spark)
    schema = "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long, block_ids long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(batches, schema + (", ids binary" if with_ids else ""))


def document_offsets(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) with ``start`` counted over all shards: one small sum per shard, then one
    per block of a shard."""
    rows = written(rows, "token-index")
    blocks = rows.groupBy("shard", "block").agg(F.max("block_ids").alias("ids"))
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", before(W.orderBy("shard")).alias("shard_start"))
    starts = (blocks.select("shard", "block", before(W.partitionBy("shard").orderBy("block")).alias("block_start"))
              .join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base")))
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
