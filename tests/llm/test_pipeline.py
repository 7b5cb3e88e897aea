"""The pipeline against the brute-force versions of its stages, on a table with every awkward case."""

import edge
import pytest
from test_linededup import slow as slow_lines
from test_quality_rules import base
from test_simhash import slow_fingerprint, slow_groups

import corpus_pipeline
from strata.llm import packing
from strata.llm.common import written
from strata.session import scratch_dir


@pytest.fixture(scope="module")
def folder(spark):
    """Tables of a small run: clean documents, copies, near copies, shared lines, junk, and a benchmark item."""
    root = scratch_dir(spark, "test-pipeline")
    shared = "this line of more than forty characters stands in many documents"
    leak = edge.sentence(777, 40)
    rows = [(i, edge.sentence(i, 120) + "\n" + shared, "en", "a", 1) for i in range(20)]
    rows += [(100 + i, edge.sentence(3, 120) + "\n" + shared, "en", "a", 1) for i in range(5)]  # copies of 3
    rows += [(200, edge.sentence(50, 80) + "\n" + leak + "\n" + edge.sentence(51, 80), "en", "a", 1)]
    rows += [(300, "junk " * 100, "en", "a", 1), (301, "too short", "en", "a", 1), (302, None, "en", "a", 1)]
    rows += [(400, edge.sentence(60, 3000), "de", None, 1)]
    spark.createDataFrame(rows, edge.SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()] if name != "pack" else docs
        docs = written(stage(spark, docs, folder), name)
        seen[name] = docs
        if name != "pack":
            assert docs.columns == columns
        after = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str) if name != "pack" else None
        if name == "quality_rules":
            assert after == sorted(((d, t) for d, t in before if not base(t)[5]), key=str)
        elif name == "line_dedup":
            assert [(d, t) for d, t in after] == [(d, t) for d, _, _, t in slow_lines(before)]
            assert sum("this line of" in t for _, t in after) == 1
        elif name == "near_dedup":
            groups = slow_groups([(d, slow_fingerprint(t)) for d, t in before])
            assert {d for d, _ in after} == set(groups.values()) and len(after) == len(set(groups.values()))
            assert not {d for d, _ in after} & set(range(100, 104))  # 104 kept the shared line
        elif name == "decontaminate":
            assert {d for d, _ in before} - {d for d, _ in after} == {200}
    placed = seen["pack"].collect()
    assert {p["doc_id"] for p in placed} == {r["doc_id"] for r in seen["decontaminate"].collect()}
    assert all(0 <= p["offset"] and p["offset"] + p["length"] <= packing.CAPACITY for p in placed)


def test_run_gives_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_awkward_tables(spark, tmp_path):
    for name, docs in (("edge", edge.documents(spark)), ("none", edge.none(spark))):
        bench = spark.createDataFrame([], "item_id long, text string")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, f"{tmp_path}/{name}"), "stage")
            assert out.columns == docs.columns
        assert corpus_pipeline.pack(spark, docs, "").count() >= 0
