"""Quality rules against a brute-force version, and their edge cases."""

import collections
import re

import edge
from pyspark.sql import functions as F

from conftest import SF001
from strata.llm import quality
from strata.llm.common import table, written


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = list(zip(words, words[1:], words[2:]))
    often = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def counts(df):
    return sorted(map(tuple, df.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed").collect()), key=str)


def test_counts_equal_a_brute_force_version(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text", "lang", "source")
    expected = sorted(((r["doc_id"], *base(r["text"])) for r in docs.collect()), key=str)
    assert counts(quality.judge(docs, keep_row=False)) == expected


def test_edge_cases(spark):
    expected = sorted(((r[0], *base(r[1])) for r in edge.rows()), key=str)
    docs = edge.documents(spark)
    assert counts(quality.judge(docs, keep_row=False)) == expected
    assert quality.judge(edge.none(spark), keep_row=False).count() == 0
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert good.where("text is null").count() == 0
    assert good.where("doc_id = 5").count() == 3  # repeated rows are judged alike, each by itself
    assert quality.keep_good(edge.none(spark)).count() == 0


def test_labelled_good_documents_stay_and_bad_ones_go(spark):
    sf = SF001.replace("0.001", "0.1")
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    judged = quality.judge(docs, keep_row=False).select("row.doc_id", "base_failed", "kept")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    by = {r["quality"]: r for r in judged.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
    assert by[1]["kept"] > 0.995 and by[0]["kept"] < 0.05


def test_sketches_merge_and_stay_within_their_error(spark):
    values = spark.range(1, 5001).select((F.col("id") * F.col("id")).alias("v"))
    row = values.select(F.max((F.col("v") - quality.bucket(F.col("v"))) / F.col("v")).alias("error"),
                        F.max(F.when(F.col("v") < 64, F.col("v") - quality.bucket(F.col("v")))).alias("small")).first()
    assert row["error"] < 1 / 32 and row["small"] == 0
    docs = table(spark, SF001, "documents", "doc_id", "text", "lang", "source")
    whole = quality.sketches(written(quality.with_base(docs, False), "test"))
    parts = [quality.sketches(written(quality.with_base(docs.where(F.col("doc_id") % 2 == k), False), "test"))
             for k in (0, 1)]
    keys = ["lang", "source", "metric", "bucket"]
    merged = parts[0].unionByName(parts[1]).groupBy(*keys).agg(F.sum("n").alias("n"))
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_main_path_is_native(spark):
    from conftest import plan_text

    docs = table(spark, SF001, "documents", "doc_id", "text", "lang", "source")
    plan = plan_text(quality.judge(docs, keep_row=False)) + plan_text(quality.with_base(docs, False))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
