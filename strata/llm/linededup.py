"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n_docs, max_doc, fresh) rows sorted by the 128-bit hash of the line's key. Documents arrive
in batches, disjoint by doc_id. A batch is reduced to one row per key (partial aggregation: a line that a third of all
documents hold reaches the shuffle once a task), merge-anti-joined with the keys of the runs so far, and written as a
run of its own in which the keys that no run held are marked ``fresh``. A key is therefore fresh in exactly one run,
so the keys of all runs are their fresh rows, without a distinct. When a level holds ``fan_out`` runs, they are merged
into one run of the next level: after n batches, log(n) levels remain to be joined.

What documents lose is a small table beside their texts. It is broadcast if its size, which is counted first, is at most
``MAX_BROADCAST_ENTRIES``; a larger one meets the texts in a shuffled join.

Defined results: a null or empty text is one empty line; rows with a null doc_id neither count nor lose lines; repeated
rows count as one document and lose the same lines; very long texts and lines are split and hashed whole; there are no
ties, as the largest doc_id that holds a line keeps it; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm.common import WHITESPACE_CHARS, ascii_lower, hash128, text_or_empty, written
from strata.session import scratch_dir
from strata.sources import fs

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FAN_OUT = 2
#: documents that lose lines plus line positions, 40 bytes each at most, up to which they are broadcast
MAX_BROADCAST_ENTRIES = 500_000
KEY = ["h1", "h2"]


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2, batch) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), F.posexplode(F.split(text_or_empty(), "\n")))
    keyed = lines.where(F.length("col") >= min_chars).select(
        "doc_id", "text_hash", "pos", ascii_lower(F.btrim("col", F.lit(WHITESPACE_CHARS))).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "text_hash", "pos", *hash128(F.col("key")),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"))


class LineRuns:
    """The levelled runs. ``add`` takes a batch, ``counts`` gives the documents and the largest doc_id of every key."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.folder = scratch_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.folder}/level={level}/run={self.made}"
        self.made += 1
        rows.sortWithinPartitions(*KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, n_docs long, max_doc long, fresh boolean").parquet(*paths)

    def paths(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def add(self, lines: DataFrame) -> None:
        """Merge-anti-join one batch of :func:`line_rows` with the runs, write its own run, compact full levels."""
        own = (lines.select(*KEY, "doc_id").distinct()
               .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc")))
        if self.paths():
            held = self._read(self.paths()).where("fresh").select(*KEY)
            fresh = own.join(held.hint("merge"), KEY, "left_anti").withColumn("fresh", F.lit(True))
            known = own.join(held.hint("merge"), KEY, "left_semi").withColumn("fresh", F.lit(False))
            own = fresh.unionByName(known)
        else:
            own = own.withColumn("fresh", F.lit(True))
        self._write(own, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            self._write(self._merged(self.levels[level]), level + 1)
            self.levels[level] = []
            level += 1

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy(*KEY).agg(
            F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"), F.bool_or("fresh").alias("fresh"))

    def counts(self) -> DataFrame:
        merged = self._read(self.paths()) if len(self.paths()) == 1 else self._merged(self.paths())
        return merged.select(*KEY, "n_docs", "max_doc")


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``n_lines``, ``n_dropped`` and ``kept_text``: lines whose key is in at
    least ``min_docs`` documents stay in the largest doc_id only."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "lines")
    rows = line_rows(docs, min_chars, batches)
    rows.write.partitionBy("batch").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    runs = LineRuns(spark, fan_out)
    for batch in range(batches):
        runs.add(rows.where(F.col("batch") == batch))
    shared = runs.counts().where(F.col("n_docs") >= min_docs).select(*KEY, "max_doc")
    losing = (rows.join(shared, KEY).where(F.col("doc_id") < F.col("max_doc"))
              .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("_drop"))
              .withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"}))
    losing = written(losing, "lines-dropped")
    fs.delete(spark, folder)
    fs.delete(spark, runs.folder)
    size = losing.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_drop")), F.lit(0))).first()
    if sum(size) <= MAX_BROADCAST_ENTRIES:
        losing = F.broadcast(losing)  # the texts stay where they are
    whole = docs.select(F.struct("*").alias("row"), text_or_empty().alias("_t"))
    joined = whole.join(losing, (F.col("row.doc_id") == F.col("_doc"))
                        & (F.xxhash64("_t") == F.col("_hash")), "left")
    split = joined.select("row", "_t", "_drop", F.split("_t", "\n").alias("_lines"))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop")), lambda i: F.get("_lines", i))
    return split.select(
        "row", F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.col("_t")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its shared lines gone: the same rows and columns, new ``text`` (and ``n_chars``, where there is
    one) for the documents that lost lines."""
    done = drop_shared_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("kept_text").cast(kind)).otherwise(F.col("row.n_chars"))
    return done.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
