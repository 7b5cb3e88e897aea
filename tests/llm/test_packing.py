"""Packing: the subset-sum step against enumeration, and the placement of every id."""

import itertools
import random
import zlib

import edge
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest import SF001
from strata.llm import packing
from strata.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_best_fill_is_the_closest_multiset():
    rng = random.Random(5)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 5))}
        target = rng.randint(0, 60)
        copies = packing.best_fill(counts, target)
        assert all(0 < n <= counts[x] for x, n in copies.items())
        sums = {sum(x * n for x, n in zip(counts, some))
                for some in itertools.product(*[range(c + 1) for c in counts.values()])}
        assert sum(x * n for x, n in copies.items()) == max(s for s in sums if s <= target)


def test_packer_places_everything_once():
    rng = random.Random(1)
    packer = packing.Packer(capacity=64, pool=32)
    docs = [np.arange(rng.choice([1, 3, 20, 40, 64, 65, 300]), dtype="<u4").tobytes() for _ in range(500)]
    for number, ids in enumerate(docs):
        packer.add(number, ids)
    packer.fill(0)
    back, sequences = {}, {}
    for doc, start, ids, sequence, offset in packer.out:
        back.setdefault(doc, {})[start] = ids
        sequences.setdefault(sequence, []).append((offset, len(ids) // 4))
    for number, ids in enumerate(docs):
        assert b"".join(back[number][s] for s in sorted(back[number])) == ids
    totals = []
    for pieces in sequences.values():
        pieces.sort()
        assert [a for a, _ in pieces] == list(itertools.accumulate([0] + [n for _, n in pieces[:-1]]))
        totals.append(sum(n for _, n in pieces))
    assert max(totals) == 64 and sum(t < 64 for t in totals) <= 1


def check(spark, docs):
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(((d, *ids) for d, ids in (
        (r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in docs.collect())),
        key=str)
    pieces = packing.pack(docs, PATH).collect()
    assert sum(p["length"] for p in pieces) == sum(len(w) - 1 for w in want)
    by_sequence = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for some in by_sequence.values():
        at = 0
        for p in sorted(some, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    return want, pieces, by_sequence


def test_ids_are_those_of_the_tokenizer(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text")
    want, pieces, sequences = check(spark, docs)
    got = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        assert p["start"] == len(got.get(p["doc_id"], b"")) // 4
        got[p["doc_id"]] = got.get(p["doc_id"], b"") + p["ids"]
    for doc, *ids in want:
        assert zlib.crc32(got[doc]) == zlib.crc32(np.array(ids, "<u4").tobytes())
    tokens = sum(p["length"] for p in pieces)
    assert 1024 * len(sequences) < 1.01 * tokens + 1024


def test_edge_cases(spark):
    check(spark, edge.documents(spark))
    assert packing.pack(edge.none(spark), PATH).count() == 0


def test_workers_forget_chunks_after_a_task(spark):
    """Idle Python workers stay beside an executor while other stages need its memory."""
    docs = table(spark, SF001, "documents", "doc_id", "text").repartition(16)
    assert packing.pack(docs, PATH).count() > 0

    def held(source):
        import pyarrow as pa

        from strata.llm import tokens

        for batch in source:
            known = [len(e.known) + len(e.words) for (path, _), e in tokens._ENCODERS.items() if path == PATH]
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64())], ["known"])

    seen = [r["known"] for r in spark.range(64).repartition(16).mapInArrow(held, "known long").collect()]
    assert seen and not any(seen)
