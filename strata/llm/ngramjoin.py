"""Similarity join of word n-gram sets (Jaccard) as a blocked sparse matrix product.

Documents are rows, n-grams columns of a sparse 0/1 matrix; the overlap of two documents is an entry of the product of
the matrix with its transpose. Only entries that can reach the bounds are computed:

1. Every text becomes its set of n-gram hashes (64 bits). Equal sets become one row, so copies never meet each other.
2. Columns are ordered by how many documents of a batch share them (a sketch of fixed size, summed over all batches),
   rare ones first, then by hash. Two sets within the threshold must share one of the first n - ceil(t n) + 1 columns
   of each; only this part of the matrix is multiplied. A passage that a third of all documents share stands at the end
   of their order.
3. The least and the greatest row of a column and the one that shares most of its columns with others are its leaders.
   Among copies with edits the last is the least edited one, which most of them are near. Each row is compared with the
   three leaders that it meets most often, and the links found are contracted: dense groups of near copies become one
   component without listing their pairs.
4. The product proper is then taken block by block, a block being a column and a class of set sizes: rows of different
   components only, the most frequent component of a column against the others only. A pair comes out of a block if its
   sizes are within the threshold and as much stands behind the column in both sets as the overlap needs: that holds
   at the first column that a linked pair shares.
5. The overlap count of a pair is accumulated over the prefixes, and the pair discarded if the count and the rest of the
   larger set cannot make up the overlap that the sizes demand; what remains is decided by the whole sets.

Nothing is capped: step 3 only saves work, pairs within one component cannot change the result, and every pair of
different components within the threshold passes all bounds of step 4.

Defined results: a null or empty text has an empty set and is linked with nothing, its component is its own doc_id;
texts of fewer words than an n-gram have their whole sequence as the only element; rows with a null doc_id take part
and get the smallest doc_id of their component (null if none); repeated rows get the same result each, ties do not
arise (the component is the smallest doc_id); very long texts are taken whole; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import forget, ship_code, text_or_empty, written
from strata.llm.components import components

NGRAM = 4
#: two sets are linked if 100 * intersection >= PERCENT * union
PERCENT = 85
#: cells of the column sketch; a power of two
CELLS = 1 << 21
#: bits of the filter that keeps only the sets that some pair needs; a power of two
FILTER_BITS = 1 << 26
TOGETHER_WORDS = 1 << 19
_SEED, _SHORT_SEED = 42, 43
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _gram_sets(texts: list[list[bytes]], ngram: int) -> Iterator[np.ndarray]:
    number = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in number), np.uint64, len(number))[words]
    grams = np.zeros(max(0, len(hashed) - ngram + 1), np.uint64)
    for k in range(ngram):
        grams = grams * _MULTIPLIER + hashed[k:k + len(grams)]
    grams = (grams ^ grams >> np.uint64(31)) * _MIX
    grams ^= grams >> np.uint64(29)
    ends = np.cumsum(sizes)
    for text, start, n in zip(texts, (ends - sizes).tolist(), sizes.tolist()):
        if n >= ngram:
            yield np.unique(grams[start:start + n - ngram + 1])
        else:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(text), _SHORT_SEED)] if n else [], np.uint64)


def gram_sets(texts: list[bytes], ngram: int = NGRAM) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each UTF-8 text, A-Z lower-cased; a bounded amount is in work at a time."""
    some, held = [], 0
    for text in texts:
        some.append(text.translate(_TO_LOWER).split())
        held += len(some[-1])
        if held >= TOGETHER_WORDS:
            yield from _gram_sets(some, ngram)
            some, held = [], 0
    yield from _gram_sets(some, ngram)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), _signed(np.concatenate(sets) if sets else np.zeros(0, np.uint64)))


def _signatures(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """128 bits that name each set, as two columns."""
    both = np.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "S16") if sets else np.zeros(0, "S16")
    pairs = np.frombuffer(both.tobytes(), "<u8").reshape(-1, 2)
    return _signed(pairs[:, 0].copy()), _signed(pairs[:, 1].copy())


def _texts(docs: DataFrame, *keep: str) -> DataFrame:
    ship_code(docs.sparkSession)
    return docs.select(*keep, F.xxhash64(text_or_empty()).alias("text"), text_or_empty().cast("binary").alias("_t"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back. The shuffles behind it are needed no more; the driver's garbage collection is what
    lets Spark remove their files."""
    out = written(df, name)
    df.sparkSession._jvm.System.gc()
    return out


def sizes_and_sketch(docs: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(doc_id, n, s1, s2) of every row, and rows with a ``cell`` of the sketch: how many documents share its columns
    with others of their batch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, names = np.zeros(CELLS, np.int64), ["doc_id", "n", "s1", "s2", "cell", "times"]
        doc_type = pa.int64()
        for batch in source:
            doc_type = batch.schema.field("doc_id").type
            sets = list(gram_sets(batch.column("_t").to_pylist(), ngram))
            grams, times = np.unique(np.concatenate(sets), return_counts=True)
            many = times > 1
            np.add.at(cells, (grams[many] & np.uint64(CELLS - 1)).astype(np.int64), times[many])
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              *_signatures(sets), none, none], names)
        used = np.flatnonzero(cells)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), doc_type), none, none, none, pa.array(used),
                                          pa.array(cells[used])], names)

    return _texts(docs, "doc_id").mapInArrow(
        batches, f"doc_id {kind}, n long, s1 long, s2 long, cell long, times long")


def column_classes(marked: DataFrame) -> np.ndarray:
    """How often the columns of each cell are shared, as a number of binary digits: ``CELLS`` small numbers."""
    def packed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            cells, digits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "digits"))
            yield pa.RecordBatch.from_arrays([pa.array([cells.astype("<i4").tobytes()], pa.binary()),
                                              pa.array([digits.astype("u1").tobytes()], pa.binary())], ["cells", "digits"])

    digits = F.length(F.bin(F.sum("times"))).alias("digits")
    counted = marked.where("cell is not null").groupBy("cell").agg(digits)
    out = np.zeros(CELLS, np.uint8)
    for r in counted.mapInArrow(packed, "cells binary, digits binary").toLocalIterator():
        out[np.frombuffer(r["cells"], "<i4")] = np.frombuffer(r["digits"], "u1")
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def prefixes(docs: DataFrame, classes: np.ndarray, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(s1, s2, text, n, prefix): the first columns of the set of every text in the common order, and a hash of the
    text."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sets, firsts = list(gram_sets(batch.column("_t").to_pylist(), ngram)), []
            for s in sets:
                order = np.lexsort((s, shared.value[(s & np.uint64(CELLS - 1)).astype(np.int64)]))
                firsts.append(s[order[:prefix_length(len(s), percent)]])
            yield pa.RecordBatch.from_arrays(
                [*_signatures(sets), batch.column("text"), pa.array([len(s) for s in sets], pa.int64()), _lists(firsts)],
                ["s1", "s2", "text", "n", "prefix"])

    return _texts(docs).mapInArrow(batches, "s1 long, s2 long, text long, n long, prefix array<long>").where("n > 0")


def whole_sets(docs: DataFrame, needed: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(sid, n, grams) of the sets of ``needed`` (sid, s1, s2, text). The texts are cut again rather than written: a bit
    array of fixed size, by the hash of the text, leaves out most texts that no pair needs."""
    spark = docs.sparkSession
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    place = F.col("text").bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = needed.groupBy(F.shiftright(place, 10).alias("part")).agg(F.collect_set(
        place.bitwiseAND(F.lit(1023)).cast("int")).alias("bits"))
    for r in rows.toLocalIterator():  # at most FILTER_BITS bits, in parts of 1024
        at = r["part"] * 1024 + np.array(r["bits"], np.int64)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    shared = spark.sparkContext.broadcast(bits)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            text = batch.column("text").to_numpy()
            at = text & np.int64(FILTER_BITS - 1)
            wanted = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0
            once = np.zeros(len(text), bool)
            once[np.unique(text, return_index=True)[1]] = True  # copies within a batch
            chosen = batch.column("_t").filter(pa.array(wanted & once))
            sets = list(gram_sets(chosen.to_pylist(), ngram))
            yield pa.RecordBatch.from_arrays([*_signatures(sets), _lists(sets)], ["s1", "s2", "grams"])

    found = _texts(docs).mapInArrow(batches, "s1 long, s2 long, grams array<long>")
    found = found.join(needed, ["s1", "s2"]).select("sid", "grams")
    return found.groupBy("sid").agg(F.first("grams").alias("grams")).select(
        "sid", F.size("grams").cast("long").alias("n"), "grams")


def sizes_fit(n_a: str, n_b: str, percent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def enough(overlap: Column, n_a: str, n_b: str, percent: int) -> Column:
    """Whether an intersection of this size (or a bound of it) reaches the threshold."""
    return (100 + percent) * overlap >= percent * (F.col(n_a) + F.col(n_b))


def possible(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that the overlap of their prefixes and the rest of the larger set leave."""
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("prefix").alias(f"p_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("p_a", "p_b"))
    rest = F.ceil(F.lit(percent) * F.greatest("n_a", "n_b") / 100) - 1
    return both.where(sizes_fit("n_a", "n_b", percent) & enough(overlap + rest, "n_a", "n_b", percent)).select("a", "b")


def confirmed(docs: DataFrame, sets: DataFrame, pairs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets reach the threshold."""
    pairs = _kept(possible(sets, pairs, percent), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    needed = written(sets.select("sid", "s1", "s2", "text").join(needed, "sid"), "needed")
    vectors = _kept(whole_sets(docs, needed, ngram), "vectors")
    side = lambda x: vectors.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("grams").alias(f"g_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("g_a", "g_b")).cast("long")
    links = _kept(both.where(sizes_fit("n_a", "n_b", percent) & enough(overlap, "n_a", "n_b", percent))
                    .select("a", "b"), "links")
    forget(pairs, needed, vectors)
    return links


def size_class(n: Column, percent: int) -> Column:
    """Sets within the threshold are at most one class apart (classes are a little wider than the threshold)."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / (percent - 0.1)))).cast("int")


def block_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows of different components that the bounds leave, from the blocks of ``entries`` (gram, sid, n,
    place, root)."""
    common = (entries.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("rows"))
              .groupBy("gram").agg(F.max_by("root", F.struct("rows", "root")).alias("common"), F.count(F.lit(1)).alias("roots"))
              .where("roots > 1").drop("roots"))
    entries = entries.join(common, "gram").withColumn("class", size_class(F.col("n"), percent))
    foreign = F.col("root") != F.col("common")
    # the first column that both share stands here in the smaller set, as no other set is smaller than itself
    small = entries.where(enough(F.col("n") - F.col("place"), "n", "n", percent)).select(
        "gram", F.explode(F.array("class", F.col("class") + 1)).alias("class"), F.col("sid").alias("a"),
        F.col("n").alias("n_a"), F.col("place").alias("place_a"), F.col("root").alias("root_a"), foreign.alias("f_a"))
    large = entries.select("gram", "class", F.col("sid").alias("b"), F.col("n").alias("n_b"),
                           F.col("place").alias("place_b"), F.col("root").alias("root_b"), foreign.alias("f_b"))
    fits = ((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))) & (
        100 * F.col("n_a") >= percent * F.col("n_b")) & (F.col("root_a") != F.col("root_b")) & enough(
        F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")), "n_a", "n_b", percent)
    keys = ["gram", "class"]
    met = small.where("f_a").join(large, keys).where(fits).unionByName(
        small.where("not f_a").join(large.where("f_b"), keys).where(fits))
    return met.select("a", "b").distinct()


def leaders(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each row of ``shared`` (gram, sid, n, low, high) and the leaders that it meets most often."""
    common = shared.groupBy("sid").agg((F.count(F.lit(1)) / F.first("n")).alias("share"))
    middle = shared.select("gram", "sid").join(common, "sid").groupBy("gram").agg(
        F.max_by("sid", F.struct("share", "sid")).alias("middle"))
    often = lambda head: F.mode(F.when(F.col(head) != F.col("sid"), F.col(head)), True)
    led = shared.join(middle, "gram").groupBy(F.col("sid").alias("a")).agg(
        F.array_distinct(F.array(often("middle"), often("low"), often("high"))).alias("heads"))
    return led.select("a", F.explode("heads").alias("b")).where("b is not null")


def similar_sets(docs: DataFrame, marked: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(s1, s2, sid, root) of every distinct non-empty set: its number and the number that stands for its component."""
    found = prefixes(docs, column_classes(marked), ngram, percent)
    sets = found.groupBy("s1", "s2").agg(
        F.min("text").alias("text"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    sets = _kept(sets.select(F.monotonically_increasing_id().alias("sid"), "*"), "sets")
    entries = sets.select("sid", "n", F.posexplode("prefix").alias("place", "gram"))
    heads = entries.groupBy("gram").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high")
    shared = _kept(entries.join(heads, "gram"), "columns")
    links = confirmed(docs, sets, leaders(shared), ngram, percent)
    first = written(components(links).select(F.col("node").alias("sid"), "root"), "first")
    labelled = _kept(shared.drop("low", "high").join(first, "sid", "left")
                       .withColumn("root", F.coalesce("root", "sid")), "labelled")
    forget(shared)
    more = confirmed(docs, sets, block_pairs(labelled, percent), ngram, percent)
    roots = sets.select("s1", "s2", "sid").join(first, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    label = lambda x: roots.select(F.col("sid").alias(x), F.col("root").alias(f"root_{x}"))
    joined = more.join(label("a"), "a").join(label("b"), "b").select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    top = components(joined).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return written(roots.join(top, "root", "left").select(
        "s1", "s2", "sid", F.coalesce("top", "root").alias("root")), "classes")


def similar_documents(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    marked = written(sizes_and_sketch(docs, ngram), "marked")
    classes = similar_sets(docs, marked, ngram, percent)
    rows = marked.where("cell is null").drop("cell", "times")
    filled = rows.where("n > 0")
    ids = (filled.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id")).join(classes, ["s1", "s2"])
           .groupBy("root").agg(F.min("doc_id").alias("component_id")))
    of_set = classes.join(ids, "root").select("s1", "s2", "component_id")
    return filled.join(of_set, ["s1", "s2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
