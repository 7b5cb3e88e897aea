"""Periodic runs against brute force over all periods, and the transform against plain convolution."""

import hashlib
import itertools
import random

import edge
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import SF001
from strata.llm import periods
from strata.llm.common import table


def brute(words):
    """(start, length, period) of all runs, by comparing every word with the one p places later, for every p."""
    found, n = {}, len(words)
    for p in range(1, n // periods.COPIES + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if length >= max(periods.LEAST, periods.COPIES * p):
                found.setdefault((start, length), p)  # the smallest period comes first
    return sorted((a, n, p) for (a, n), p in found.items())


def by_operator(texts):
    number = {}
    words = np.array([number.setdefault(w, len(number) + 1) for t in texts for w in t], np.int64)
    out = [[] for _ in texts]
    for i, *run in periods.runs_of(words, np.array([len(t) for t in texts], np.int64)).tolist():
        out[i].append(tuple(run))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def same(texts):
    got = by_operator(texts)
    for text, runs in zip(texts, got):
        want = sorted(brute(text), key=lambda r: (r[0], r[2]))
        assert runs == want, text


def test_every_short_text():
    texts = [t for n in range(0, 13) for t in itertools.product("ab", repeat=n)]
    same(texts)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_random_texts_with_repetitions(alphabet):
    rng = random.Random(alphabet)
    texts = []
    for _ in range(300):
        text = []
        while len(text) < rng.randint(1, 400):
            unit = [rng.randrange(alphabet) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33, 40]))]
            text += unit * rng.choice([1, 1, 2, 3, 4, 5, 9])
            text += unit[:rng.randint(0, len(unit))]
        texts.append(text)
    same(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5))
def test_any_text(texts):
    same(texts)


def test_long_periods_and_many_parts(monkeypatch):
    rng = random.Random(7)
    texts = [[rng.random() for _ in range(p)] * 4 + [0] * k for p, k in ((255, 3), (256, 1), (257, 9), (1000, 0), (64, 77))]
    texts += [t[:-1 - k] for k, t in enumerate(texts)]  # a word short of four copies
    same(texts)
    monkeypatch.setattr(periods, "TOGETHER_NUMBERS", 64)
    same(texts[:3] + [[1, 2] * 30, [5] * 200])


def test_a_zero_modulo_the_prime_is_no_match(monkeypatch):
    monkeypatch.setattr(periods, "differences", lambda blocks, *_: np.zeros_like(blocks))  # all distances look equal
    same([[1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 9], [4] * 9, list(range(40)), [1, 1, 2] * 8])


@pytest.mark.parametrize("fields", [periods.FIELDS, periods.FIELDS[1:]])
def test_transform_is_exact(monkeypatch, fields):
    monkeypatch.setattr(periods, "FIELDS", fields)
    monkeypatch.setattr(periods, "field", periods.Field)
    rng = np.random.default_rng(5)
    for width in (4, 8, 64, 1024, 1 << 14):
        f = periods.Field(2 * width)
        x = rng.integers(0, f.prime, (5, width))
        wide = f.reduced(np.concatenate([x, x[::-1]], axis=1).astype(f.kind))
        assert (f.inverse(f.transform(wide)) == wide).all()
        got = periods.differences(x, x[::-1]) % f.prime
        for r in range(5):
            window = x[r].tolist() + x[4 - r].tolist()
            for d in {1, 2, width // 2, width}:
                assert got[r, d - 1] == sum((window[i] - window[i + d]) ** 2 for i in range(width)) % f.prime


def test_the_second_field_gives_the_same_runs(monkeypatch):
    monkeypatch.setattr(periods, "FIELDS", periods.FIELDS[1:])
    monkeypatch.setattr(periods, "field", periods.Field)
    same([[1, 2, 3] * 9 + [4] * 20, list(range(50)) * 4, [7, 8] * 3])


def expected(doc, text):
    words = periods.with_repetition(doc, (text or "").encode().split())
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(words), len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_documents(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text").where("length(text) < 8000")
    got = sorted(map(tuple, periods.find_runs(docs, periods.with_repetition).collect()))
    assert got == sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())
    assert sum(r[2] > 0 for r in got) > 10


def test_edge_cases(spark):
    docs = edge.documents(spark)
    got = [tuple(r) for r in periods.find_runs(docs, periods.with_repetition).collect()]
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 10000]
    assert len(got) == len(edge.rows())
    assert all(expected(*r) in got for r in short)
    assert periods.find_runs(edge.none(spark)).count() == 0


def test_a_very_long_text(spark):
    """A text of 400,000 equal words, and one that repeats 30,000 different words four times."""
    text = "a " * 400_000
    unit = " ".join(f"w{i}" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, " ".join([unit] * 4))], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periods.find_runs(docs, with_collapsed=True).collect()}
    assert (rows[1]["start"], rows[1]["length"], rows[1]["period"], rows[1]["collapsed"]) == (0, 400_000, 1, "a")
    assert (rows[2]["start"], rows[2]["length"], rows[2]["period"]) == (0, 120_000, 30_000)
    assert rows[2]["collapsed"] == unit and [r.asDict() for r in rows[2]["runs"]] == [
        {"start": 0, "length": 120_000, "period": 30_000}]
