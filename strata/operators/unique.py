"""Key uniqueness with little shuffle (A4, Q4): a map of hashes, none / one / many, and a second look at the many.

Counting keys exactly by ``groupBy`` shuffles every key, also where next to all are unique. Here a task sorts the hashes
of its keys, cut to ``bits`` binary digits, and sends them as differences, packed: two to three bytes a key whatever
the keys are, and a hot key once. Tasks of the second step merge the sorted runs of one range of hashes and note which
hashes stand there more than once, as bits of a filter of fixed size. Only rows that the filter lets through are grouped
by their keys. All rows of a repeated key pass, so the count is exact; of the unique keys about ``rows / 2 ** bits``
and ``many / FILTER_BITS`` pass in vain.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.functions import is_missing
from strata.session import ship_code

BITS = 40
FILTER_BITS = 26
#: hashes that a task sorts at a time
RUN_KEYS = 1 << 22


def pack(values: np.ndarray) -> bytes:
    """Ascending whole numbers as compressed differences, byte plane after byte plane."""
    steps = np.diff(values, prepend=0).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = steps.view(np.uint8).reshape(-1, 8)[:, :width].T
    data = np.ascontiguousarray(planes).tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], width * size, "zstd", asbytes=True), np.uint8).reshape(width, size)
    steps = np.zeros((size, 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.reshape(-1).view("<u8").astype(np.int64))


def hash_runs(hashes: DataFrame, slices: int, bits: int = BITS) -> DataFrame:
    """(slice, n, once, many) of the hashes ``h``: sorted runs of the distinct cut hashes of a task by range, those that
    the run has more than once, and the number of rows."""
    shift = (bits - slices.bit_length() + 1)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, held = [], 0
        for batch in source:
            some.append(batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - bits))
            held += batch.num_rows
            if held >= RUN_KEYS:
                yield runs(np.concatenate(some))
                some, held = [], 0
        if held:
            yield runs(np.concatenate(some))

    def runs(values: np.ndarray) -> pa.RecordBatch:
        once, times = np.unique(values.astype(np.int64), return_counts=True)
        edges = np.searchsorted(once, np.arange(slices + 1, dtype=np.int64) << shift)
        total = np.concatenate(([0], np.cumsum(times)))
        rows = []
        for k in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[k], edges[k + 1])
            rows.append((k, int(total[edges[k + 1]] - total[edges[k]]), pack(once[part]), pack(once[part][times[part] > 1])))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["slice", "n", "once", "many"])

    ship_code(hashes.sparkSession)
    return hashes.mapInArrow(batches, "slice int, n long, once binary, many binary")


def merged(runs: DataFrame, slices: int, bits: int = BITS) -> DataFrame:
    """(slice, n, filter): the rows of every range of hashes and the bits of those that stand there more than once."""
    width = (1 << FILTER_BITS) // slices

    def merge(table: pa.Table) -> pa.Table:
        once = np.concatenate([unpack(x) for x in table.column("once").to_pylist()])
        many = [unpack(x) for x in table.column("many").to_pylist()]
        values, times = np.unique(once, return_counts=True)
        found = np.concatenate([values[times > 1], *many])
        places = (found >> (bits - FILTER_BITS)) % width
        there = np.zeros(width, bool)
        there[places] = True
        number = table.column("slice")[0].as_py()
        return pa.table({"slice": pa.array([number], pa.int32()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
                         "filter": pa.array([np.packbits(there, bitorder="little").tobytes()], pa.binary())})

    return runs.groupBy("slice").applyInArrow(merge, "slice int, n long, filter binary")


def repeated_keys(df: DataFrame, keys, ignore_blank_keys: bool = False, slices: int | None = None,
                  bits: int = BITS) -> DataFrame:
    """The row of :func:`strata.operators.profile.duplicate_keys` (duplicate_keys, duplicated_rows, distinct_keys), for
    keys that are mostly unique. The first pass runs at the call; ``slices`` (a power of two) ranges of hashes, each
    merged by one task, default to sixteen times the shuffle partitions."""
    if not FILTER_BITS <= bits <= 62:
        raise ValueError(f"bits must be from {FILTER_BITS} to 62")
    keys = [keys] if isinstance(keys, str) else list(keys)
    if ignore_blank_keys:
        df = df.filter(~reduce(lambda a, b: a | b, [is_missing(k) for k in keys]))
    spark = df.sparkSession
    if slices is None:
        slices = min(1 << 16, 1 << (16 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    hashed = df.select(*keys, F.xxhash64(*keys).alias("h"))
    width, rows, there = (1 << FILTER_BITS) // slices // 8, 0, np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for r in merged(hash_runs(hashed.select("h"), slices, bits), slices, bits).toLocalIterator():
        rows += r["n"]  # the filters of all ranges together have 2 ** FILTER_BITS bits
        there[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["filter"], np.uint8)
    shared = spark.sparkContext.broadcast(there)

    def passing(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            place = (batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            yield batch.filter(pa.array(shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0))

    per_key = hashed.mapInArrow(passing, hashed.schema).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    many = F.col("_n") > 1
    found = per_key.agg(F.count_if(many).alias("duplicate_keys"),
                        F.coalesce(F.sum(F.when(many, F.col("_n"))), F.lit(0)).cast("bigint").alias("duplicated_rows"))
    return found.withColumn("distinct_keys", F.lit(rows).cast("bigint") - F.col("duplicated_rows") + F.col("duplicate_keys"))
