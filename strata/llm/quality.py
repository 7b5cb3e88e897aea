"""Quality rules with adaptive thresholds [native].

Fixed base rules reject obvious junk. Every other document is compared with its own population: the metrics of the
documents that pass the base rules are summarised per language and source in mergeable quantile sketches, and a
document is rejected when one of its metrics lies beyond the fence ``q75 + k * max(iqr, floor)`` (for word length also
below ``q25 - k * max(iqr, floor)``) of its group.

The sketch is a log-linear histogram over integers: a value keeps its six leading bits, so a bucket is exact up to 63
and within 1/32 of the value above. Two sketches merge by adding counts, which is exactly what a partial aggregation
does: a source that holds a third of all rows reaches the shuffle as a few hundred counts, and the same counts merge
further into the sketch of a language and of the corpus, which serve the groups with fewer than ``min_docs`` documents.
Integer buckets make the result independent of the order in which sketches meet.

Defined results: null text has no words and fails the base rules; null languages and sources form their own groups;
a value at a fence is within it; very long texts are counted whole, within the row that holds them;
repeated rows are judged alike, each by itself; an empty table gives no rows; a table of the operator may carry any
further columns, they pass through untouched inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from strata.llm.common import WHITESPACE, forget, text_or_empty, words_of, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: metric: (floor of the interquartile range, whether low values are rejected too)
METRICS = {
    "symbols": (50, False),
    "dup_lines": (150, False),
    "repeats": (100, False),
    "word_length": (100, True),
}
FENCE = 3
MIN_DOCS = 100
SALTS = 64


def with_base(docs: DataFrame, keep_row: bool = True) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang``, ``source``, the base counts and ``base_failed``."""
    row = [F.struct("*").alias("row")] if keep_row else [F.struct("doc_id").alias("row")]
    out = docs.select(*row, "lang", "source", text_or_empty().alias("_t"))
    carried = ["row", "lang", "source"]
    out = out.select(
        *carried,
        words_of(F.col("_t")).alias("_words"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{WHITESPACE}]")).alias("_lines"),
    )
    out = out.select(
        *carried, "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        )).alias("_grams"),
    )
    # only documents with a repeated window need the positions of the windows that occur again
    out = out.withColumn("_sorted", F.when(
        F.size("_grams") > F.size(F.array_distinct("_grams")),
        F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get("_sorted", k)["h"] == x["h"], F.lit(False))
    out = out.withColumn("_again", F.transform(
        F.filter("_sorted", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1))), lambda x: x["i"]))
    covered = F.array_distinct(F.concat(
        "_again", F.transform("_again", lambda i: i + 1), F.transform("_again", lambda i: i + 2)))
    out = out.withColumn("n_repeat_words", F.when(F.col("_again").isNull(), 0).otherwise(F.size(covered)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(*carried, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"))


def bucket(value: Column) -> Column:
    """The value with all but its six leading bits set to zero (values below 64 unchanged)."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return value - F.pmod(value, step)


def metric_buckets() -> dict[str, Column]:
    """Per-mille ratios (word length: hundredths of a character) of a document, as buckets of the sketch."""
    per = lambda a, b, scale: bucket(F.expr(f"({scale} * {a}) div greatest({b}, 1)"))
    return {
        "symbols": per("n_symbols", "n_words", 1000),
        "dup_lines": per("n_dup_lines", "n_lines", 1000),
        "repeats": per("n_repeat_words", "n_words", 1000),
        "word_length": per("word_chars", "n_words", 100),
    }


def sketches(based: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, metric, bucket, n) over the documents that pass the base rules."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), b.alias("bucket")) for m, b in metric_buckets().items()])
    return (based.where(~F.col("base_failed"))
            .select("lang", "source", F.explode(rows).alias("s")).select("lang", "source", "s.*")
            .groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """The sketches of one coarser level: counts of equal buckets added."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """Documents, first and third quartile of each sketch. A group has at most some thousand buckets."""
    group = W.partitionBy(*keys, "metric")
    running = group.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    marked = sketch.withColumn("cum", F.sum("n").over(running)).withColumn("total", F.sum("n").over(group))
    reached = lambda q: F.min(F.when(4 * F.col("cum") >= q * F.col("total"), F.col("bucket")))
    return marked.groupBy(*keys, "metric").agg(
        F.max("total").alias("docs"), reached(1).alias("q25"), reached(3).alias("q75"))


def thresholds(sketch: DataFrame, min_docs: int = MIN_DOCS, fence: int = FENCE) -> DataFrame:
    """One row per (lang, source): ``high_<metric>`` and ``low_<metric>``, from the finest sketch of min_docs or more."""
    def named(df: DataFrame, level: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in ("docs", "q25", "q75")],
                         F.struct("docs", "q25", "q75").alias(level))

    own = named(quartiles(sketch, "lang", "source"), "own")
    lang = named(quartiles(merged(sketch, "lang"), "lang"), "by_lang").withColumnsRenamed(
        {"lang": "l_lang", "metric": "l_metric"})
    corpus = named(quartiles(merged(sketch)), "corpus").withColumnRenamed("metric", "c_metric")
    chosen = (own
              .join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("metric") == F.col("l_metric")))
              .join(corpus, F.col("metric") == F.col("c_metric"))
              .withColumn("q", F.when(F.col("own.docs") >= min_docs, F.col("own"))
                          .when(F.col("by_lang.docs") >= min_docs, F.col("by_lang")).otherwise(F.col("corpus"))))
    high, low = [], []
    for metric, (floor, _) in METRICS.items():
        reach = fence * F.greatest(F.col("q.q75") - F.col("q.q25"), F.lit(floor))
        mine = F.col("metric") == metric
        high.append(F.max(F.when(mine, F.col("q.q75") + reach)).alias(f"high_{metric}"))
        low.append(F.max(F.when(mine, F.col("q.q25") - reach)).alias(f"low_{metric}"))
    return chosen.groupBy("lang", "source").agg(*high, *low)


def judge(docs: DataFrame, keep_row: bool = True, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` with its base counts, ``base_failed``, ``kept`` and ``failed_metrics``; ``row`` holds the
    whole row, or with ``keep_row=False`` its doc_id alone. The counts are written once for the sketches, and read again
    for the verdict unless this needs the whole rows: then they are computed anew beside them, which costs less than
    writing the texts."""
    based = written(with_base(docs, False), "quality-base")
    limits = written(thresholds(sketches(based), min_docs), "quality-limits")
    if keep_row:
        forget(based)
        based = with_base(docs, True)
    limits = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"}).withColumn(
        "t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # a salt from the row number also keeps Spark from pushing a filter on the verdict below the counts, where it would
    # evaluate their expressions once more for every use
    salted = based.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    joined = salted.join(limits, F.col("lang").eqNullSafe(F.col("t_lang"))
                         & F.col("source").eqNullSafe(F.col("t_source"))
                         & (F.col("_salt") == F.col("t_salt")), "left")
    beyond = []
    for metric, value in metric_buckets().items():
        out = value > F.col(f"high_{metric}")
        if METRICS[metric][1]:
            out = out | (value < F.col(f"low_{metric}"))
        beyond.append(F.when(out, F.lit(metric)))
    failed = F.array_compact(F.array(*beyond))
    return joined.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
        F.array_join(failed, ",").alias("failed_metrics"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with exactly the columns of ``docs``."""
    return judge(docs).where("kept").select("row.*")
