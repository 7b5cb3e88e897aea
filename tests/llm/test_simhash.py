"""SimHash fingerprints bit by bit, and near-duplicate groups against all pairs."""

import random
import re

import edge
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash
from strata.llm.components import components


def slow_fingerprint(text, shingle=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, max_bits=4):
    """Smallest doc_id by fingerprint, from all pairs."""
    fps = sorted({fp for _, fp in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {}
    for doc, fp in rows:
        if doc is not None:
            least[find(fp)] = min(least.get(find(fp), doc), doc)
    return {fp: least.get(find(fp)) for fp in fps}


def test_fingerprint_of_any_text():
    rng = random.Random(1)
    texts = ["", "a", "A b", " a  B\tc\nd ", "é É İ", "x " * 40000]
    texts += [" ".join(rng.choice(["Aa", "b", "cé", "dd"]) for _ in range(rng.randint(1, 50))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == slow_fingerprint(t)


def clustered(seed, size=700):
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(size // 4)]
    while len(fps) < size:  # chains and dense balls around a few centres
        f = fps[rng.randrange(len(fps) if rng.random() < .3 else 5)]
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            f ^= 1 << bit
        fps.append(f)
    return [(rng.randrange(10**6), f) for f in fps]


@pytest.mark.parametrize("segments", [None, 1, 2, 3, 4, 5])
def test_groups_equal_all_pairs_for_every_layout(spark, segments):
    if segments == 1:
        max_bits = 1  # one segment: the ball around the whole fingerprint
    else:
        max_bits = 4
    rows = clustered(segments or 9)
    signed = [(d, int(np.uint64(f).view(np.int64))) for d, f in rows]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    got = {int(np.int64(r["fp"]).view(np.uint64)): r["component_id"]
           for r in simhash.near_groups(df, max_bits, segments).collect()}
    assert got == slow_groups(rows, max_bits)


def test_search_alone_is_exact(spark):
    """Without the leaders the ball search finds every component by itself."""
    rows = clustered(3, 300)
    fps = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for _, f in rows], "fp long").distinct()
    labelled = fps.select("fp", F.col("fp").alias("root"))
    found = components(simhash.ball_links(labelled, simhash.segment_layout(3), 4))
    sizes = found.groupBy("root").count().agg(F.sum("count")).first()[0]
    slow = {}
    for fp, doc in slow_groups([(i, f) for i, (_, f) in enumerate(rows)]).items():
        slow.setdefault(doc, set()).add(fp)
    assert sizes == sum(len(s) for s in slow.values() if len(s) > 1)


def test_edge_cases(spark):
    docs = edge.documents(spark)
    rows = [(r[0], slow_fingerprint(r[1])) for r in edge.rows()]
    want = slow_groups(rows)
    got = simhash.near_duplicates(docs, F.struct("doc_id")).select("row.doc_id", "fp", "component_id").collect()
    assert sorted(((r[0], int(np.int64(r[1]).view(np.uint64)), r[2]) for r in got), key=str) == sorted(
        ((d, f, want[f]) for d, f in rows), key=str)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 5").count() == len({f for d, f in rows if d == 5 and want[f] == 5})
    groups = simhash.near_duplicates(docs, F.struct("doc_id")).select("group").distinct().count()
    assert kept.count() == groups == len(set(want.values())) + 1  # doc_id 5 has a text in each of two groups
    assert simhash.without_near_duplicates(edge.none(spark)).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(200)] + [(1001, 1001)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1201), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
