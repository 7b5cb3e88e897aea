"""SimHash near-dedup by multi-index hashing.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Two fingerprints link when they
differ in at most ``max_bits`` bits; documents in one connected component are near-duplicates.

The search splits a fingerprint into ``segments``. If two fingerprints differ in at most r bits, then for
r = s * segments + e some one of the first e + 1 segments differs in at most s bits, or one of the others in at most
s - 1. Each fingerprint therefore fetches, per segment, the table rows whose segment lies in the small Hamming ball
around its own, and the complete distance decides. A segment should have about as many bits as the number of distinct
fingerprints has binary digits, so that a fetch finds about one row; the operator derives ``segments`` from that
number. The links found are the same for every choice.

Groups of copies are contracted before the search, so that it never lists the pairs within a group:

1. equal fingerprints become one row (partial aggregation);
2. within every bucket (segment, value) each fingerprint is compared with a few leaders of the bucket, the least
   fingerprints under different hashes: at most ``leaders`` comparisons a row, and dense groups fall into one component;
3. the ball search then joins only rows of different components: in each bucket the most frequent component is set
   apart, and its rows are compared with the other rows only, never among themselves.

Step 3 is exact for any outcome of step 2, which only saves work: every pair of different components within reach is
compared, and pairs within one component cannot change the result.

Defined results: a bit set in exactly half of the hashes is zero; very long texts are hashed whole, in blocks; a null or
empty text has fingerprint zero and links like any other; fewer words than a shingle count
as one shingle; rows with a null doc_id take part and get the component of their fingerprint (null if no linked row has
a doc_id); repeated rows get the same result each; an empty table gives no rows; further columns pass through ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import forget, ship_code, text_or_empty, written
from strata.llm.components import components

SHINGLE = 4
MAX_BITS = 4
LEADERS = 4
SEED = 42

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one UTF-8 text; bit i is set when over half of the shingle hashes have it set."""
    words = _WORD.findall(text.translate(_TO_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    span = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[span - 1:])], np.uint64)
    counts = np.zeros(64, np.int64)
    for block in range(0, len(values), 1 << 14):
        bits = np.unpackbits(values[block:block + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values), bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, keep: Column, shingle: int = SHINGLE) -> DataFrame:
    """(row, fp): ``keep`` as ``row`` and the fingerprint of the whole text as a signed 64-bit integer."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = np.array([fingerprint(t, shingle) for t in batch.column("_t").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out.view(np.int64))], ["row", "fp"])
            del batch
            pa.default_memory_pool().release_unused()  # an idle worker process stays beside its executor

    ship_code(docs.sparkSession)
    chosen = docs.select(keep.alias("row"), text_or_empty().cast("binary").alias("_t"))
    return chosen.mapInArrow(batches, chosen.select("row", F.lit(0).cast("long").alias("fp")).schema)


def segment_layout(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment; together they cover all 64 bits."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def flips(width: int, radius: int) -> list[int]:
    """The masks that flip up to ``radius`` of ``width`` bits."""
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << i) for m in masks for i in range(width)}
    return sorted(m - (1 << 64) if m >> 63 else m for m in masks)  # as signed 64-bit integers


def radii(segments: int, max_bits: int) -> list[int]:
    """The ball to search in each segment; -1 for a segment that needs no search."""
    whole, rest = divmod(max_bits, segments)
    return [whole if k <= rest else whole - 1 for k in range(segments)]


def choose_segments(distinct: int, max_bits: int = MAX_BITS) -> int:
    """The number of segments with the least work for ``distinct`` fingerprints; every choice finds the same links.

    A probe is a shuffled row, a fetched row one comparison, which costs about a tenth of it."""
    def work(segments: int) -> float:
        total = 0.0
        for (_, width), radius in zip(segment_layout(segments), radii(segments, max_bits)):
            ball = sum(comb(width, k) for k in range(radius + 1))
            total += distinct * ball + 0.1 * distinct * distinct * ball / 2 ** width
        return total

    return min(range(2, max_bits + 2), key=work) if max_bits else 1


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long")) if width < 64 else fp


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def leader_links(fps: DataFrame, layout: list[tuple[int, int]], max_bits: int, leaders: int = LEADERS) -> DataFrame:
    """Links (a, b) between each fingerprint and the near ones among the leaders of its buckets."""
    table = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("seg"), _segment(F.col("fp"), *s).alias("value")) for k, s in enumerate(layout)])
    ).alias("s")).select("fp", "s.*")
    ranks = [F.struct(F.xxhash64(F.lit(k), "fp"), F.col("fp").alias("fp")) for k in range(leaders)]
    heads = table.groupBy("seg", "value").agg(
        F.count(F.lit(1)).alias("n"), F.array_distinct(F.array(*[F.min(r)["fp"] for r in ranks])).alias("heads"))
    return (table.join(heads.where("n > 1").drop("n"), ["seg", "value"])
            .select(F.col("fp").alias("a"), F.explode("heads").alias("b"))
            .where((F.col("a") != F.col("b")) & _near("a", "b", max_bits)).distinct())


def ball_links(labelled: DataFrame, layout: list[tuple[int, int]], max_bits: int) -> DataFrame:
    """Links between different components of ``labelled`` (fp, root): the multi-index search."""
    def probe(k: int, shift: int, width: int):
        return lambda mask: F.struct(F.lit(k).alias("seg"),
                                     _segment(F.col("fp"), shift, width).bitwiseXOR(mask).alias("value"))

    keys, probes = [], []
    for k, ((shift, width), radius) in enumerate(zip(layout, radii(len(layout), max_bits))):
        keys.append(F.struct(F.lit(k).alias("seg"), _segment(F.col("fp"), shift, width).alias("value")))
        if radius >= 0:
            masks = F.array(*[F.lit(m).cast("long") for m in flips(width, radius)])
            probes.append(F.transform(masks, probe(k, shift, width)))
    table = labelled.select("fp", "root", F.explode(F.array(*keys)).alias("s")).select("fp", "root", "s.*")
    probing = labelled.select("fp", "root", F.explode(F.concat(*probes)).alias("s")).select("fp", "root", "s.*")
    # the component with most table rows of a bucket; a bucket without another component still meets foreign probes
    common = (table.groupBy("seg", "value", "root").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("seg", "value").agg(F.max_by("root", F.struct("n", "root")).alias("common")))
    table = table.join(common, ["seg", "value"]).select(
        "seg", "value", F.col("fp").alias("b"), F.col("root").alias("root_b"),
        (F.col("root") == F.col("common")).alias("b_common"))
    probing = probing.join(common, ["seg", "value"]).select(
        "seg", "value", F.col("fp").alias("a"), F.col("root").alias("root_a"),
        (F.col("root") == F.col("common")).alias("a_common"))
    reach = (F.col("root_a") != F.col("root_b")) & _near("a", "b", max_bits)
    foreign = probing.where(~F.col("a_common")).join(table, ["seg", "value"]).where(reach)
    own = probing.where("a_common").join(table.where(~F.col("b_common")), ["seg", "value"]).where(reach)
    return foreign.select("root_a", "root_b").unionByName(own.select("root_a", "root_b")).select(
        F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct()


def near_groups(fingerprints: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None) -> DataFrame:
    """(fp, group, component_id) of every distinct fingerprint of ``fingerprints`` (doc_id, fp)."""
    fps = written(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fps")
    layout = segment_layout(segments or choose_segments(fps.count(), max_bits))
    first = components(leader_links(fps.select("fp"), layout, max_bits))
    roots = fps.join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    roots = written(roots, "roots")
    second = components(ball_links(roots.select("fp", "root"), layout, max_bits)).select(
        F.col("node").alias("root"), F.col("root").alias("top"))
    tops = roots.join(second, "root", "left").select("fp", "doc_id", F.coalesce("top", "root").alias("top"))
    ids = tops.groupBy("top").agg(F.min("doc_id").alias("component_id"))
    groups = written(tops.join(ids, "top").select("fp", F.col("top").alias("group"), "component_id"), "groups")
    forget(fps, roots)
    return groups


def near_duplicates(docs: DataFrame, keep: Column | None = None, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Every row of ``docs`` as ``row`` (or only ``keep``, which must hold doc_id), its ``fp``, its ``group`` (the
    least fingerprint of the component) and ``component_id`` (the smallest doc_id)."""
    small = keep if keep is not None else F.struct("doc_id")
    marked = written(with_fingerprints(docs, small, shingle), "simhash")
    groups = near_groups(marked.select("row.doc_id", "fp"), max_bits).withColumnRenamed("fp", "_fp")
    if keep is None:  # the texts are hashed again rather than written a second time
        forget(marked)
        marked = with_fingerprints(docs, F.struct("*"), shingle)
    return marked.join(groups, F.col("fp") == F.col("_fp")).drop("_fp")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group, that with the smallest doc_id, with exactly the columns of ``docs``."""
    first = near_duplicates(docs).where(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["group"]).select("row.*")
