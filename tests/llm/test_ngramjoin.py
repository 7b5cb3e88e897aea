"""The n-gram join against all pairs, on real documents, on groups of near copies, and on awkward tables."""

import random

import edge
import numpy as np
import pytest

from conftest import SF001
from strata.llm import ngramjoin
from strata.llm.common import table


def shingles(text, n=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return set()
    return {" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows):
    """(doc_id, n_shingles, component_id) of every (doc_id, text), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i] = top[top[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def check(spark, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = sorted(map(tuple, ngramjoin.similar_documents(docs).collect()), key=str)
    assert got == brute(rows)
    return got


def test_documents(spark):
    rows = [tuple(r) for r in table(spark, SF001, "documents", "doc_id", "text").collect()]
    got = check(spark, rows)
    assert len({c for _, _, c in got}) < len(rows)


def edited(rng, words, share):
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_near_copies_around_the_threshold(spark):
    rng = random.Random(4)
    rows, doc = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([3, 6, 7, 9, 20, 60, 150]))]
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05, 0.08):
            rows.append((doc, " ".join(edited(rng, base, share))))
            doc += 1
        rows.append((doc, " ".join(base + [f"y{k}" for k in range(len(base) // 6)])))
        doc += 1
    check(spark, rows)


def test_a_chain_of_links_and_a_common_passage(spark):
    """Neighbours in the chain are linked, its ends are far apart; all other documents share a long passage."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(80)]
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        words[2 * i] = f"v{i}"
        rows.append((100 - i, " ".join(words)))
    rows += [(200 + i, " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randint(1, 40))])) for i in range(80)]
    got = check(spark, rows)
    assert {c for d, _, c in got if d <= 100} == {61}


def test_block_pairs_find_all_without_leaders(spark, monkeypatch):
    """The exact product alone, as if step 3 had found nothing."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(edited(rng, base, 0.02))) for i in range(30)]
    real = ngramjoin.confirmed
    calls = []

    def second_only(docs, sets, pairs, *args):
        calls.append(1)
        return real(docs, sets, pairs.limit(0) if len(calls) == 1 else pairs, *args)

    monkeypatch.setattr(ngramjoin, "confirmed", second_only)
    check(spark, rows)


def test_a_dense_group_is_contracted_around_its_middle(spark, monkeypatch):
    """Copies with a few to many edits: most are near the least edited one, the rows with extreme numbers need not be."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(0, 5)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    left, real = [], ngramjoin.block_pairs

    def counted(*args):
        left.append(real(*args).count())
        return real(*args)

    monkeypatch.setattr(ngramjoin, "block_pairs", counted)
    check(spark, rows)
    assert left[0] < 400


def test_leaders_are_the_rows_that_share_most(spark):
    """Row 5 shares all of its columns; the least and the greatest row of every column share few of theirs."""
    rows = [(g, 5, 10) for g in range(8)] + [(g, 3, 10) for g in range(4)] + [(g, 4, 10) for g in range(4, 8)]
    rows += [(0, 1, 10), (4, 1, 10), (1, 9, 10), (5, 9, 10)]
    shared = spark.createDataFrame(rows, "gram long, sid long, n long").selectExpr(
        "*", "min(sid) over (partition by gram) low", "max(sid) over (partition by gram) high")
    got = {tuple(r) for r in ngramjoin.leaders(shared).collect()}
    assert {(a, 5) for a in (1, 3, 4, 9)} <= got and all(a != b for a, b in got)


def test_edge_cases(spark):
    docs = edge.documents(spark)
    got = sorted(map(tuple, ngramjoin.similar_documents(docs).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngramjoin.similar_documents(edge.none(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 5, 6, 7, 20, 100, 333])
def test_prefix_meets_every_linked_pair(n):
    """With the prefix length used, sets at the threshold cannot miss each other in any order."""
    for m in range(n, n * 100 // 85 + 1):
        least = -(-85 * (n + m) // 185)
        if least <= n:
            # shared columns all stand at the end of both orders, the worst case
            assert n - least < ngramjoin.prefix_length(n) and m - least < ngramjoin.prefix_length(m)


def test_gram_sets():
    texts = [b"", b"One", b"one two three", b"a b c d", b"A B  c\nd\x0be", b"x y x y x y x y"]
    sizes = [len(s) for s in ngramjoin.gram_sets(texts)]
    assert sizes == [len(shingles(t.decode())) for t in texts] == [0, 1, 1, 1, 2, 2]
    a, b = ngramjoin.gram_sets([b"a b c d", b"a b C d q"])
    assert len(np.intersect1d(a, b)) == 1


def test_very_long_texts_are_taken_whole(spark):
    """Two texts of a million words that differ at their ends only, and one that is not near."""
    words = [f"w{i}" for i in range(1_000_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:900_000])), (3, " ".join(words[:800_000])), (4, " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngramjoin.similar_documents(docs).collect()))
    assert got == [(1, 999_997, 1), (2, 899_997, 1), (3, 799_997, 1), (4, 999_997, 4)]
