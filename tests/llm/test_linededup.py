"""Line dedup against a brute-force version, the invariants of the runs, and edge cases."""

import collections

import edge
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from strata.llm import linededup
from strata.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def fast(docs, **options):
    done = linededup.drop_shared_lines(docs, **options)
    return sorted(map(tuple, done.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)


def test_equals_a_brute_force_version(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert fast(docs) == slow(rows)
    assert sum(r[2] for r in slow(rows, 10, 2)) > 0
    assert fast(docs, min_chars=10, min_docs=2) == slow(rows, 10, 2)


@pytest.mark.parametrize("batches, fan_out", [(1, 2), (7, 2), (9, 3)])
def test_any_number_of_batches_gives_the_same(spark, batches, fan_out):
    docs = edge.documents(spark)
    assert fast(docs, batches=batches, fan_out=fan_out) == slow([r[:2] for r in edge.rows()])


def test_edge_cases(spark):
    docs = edge.documents(spark)
    out = linededup.without_shared_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text is null").count() == 2  # texts that lose nothing stay as they are
    changed = {r["doc_id"]: r["n_chars"] for r in out.where("doc_id >= 100 and doc_id < 200").collect()}
    assert changed[105] == 1 and all(changed[100 + i] == len(edge.sentence(10 + i, 55)) + 1 for i in range(5))
    assert linededup.without_shared_lines(edge.none(spark)).count() == 0


def test_runs_hold_each_key_fresh_once_and_compact(spark):
    runs = linededup.LineRuns(spark, fan_out=2)
    for batch in range(5):
        runs.add(spark.range(batch * 10, batch * 10 + 30).select(
            F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(batch).cast("long").alias("doc_id")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    rows = runs._read(runs.paths())
    assert rows.where("fresh").groupBy("h1", "h2").count().where("count > 1").count() == 0
    assert rows.where("fresh").count() == 70
    counts = {r["h1"]: (r["n_docs"], r["max_doc"]) for r in runs.counts().collect()}
    assert counts[0] == (1, 0) and counts[25] == (3, 2) and counts[69] == (1, 4)
