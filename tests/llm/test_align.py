"""Alignment against a byte-by-byte version that encodes every text whole, on real, random and awkward texts."""

import hashlib
import random
from collections import Counter, defaultdict

import edge
import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from conftest import SF001
from strata.llm import align
from strata.llm.common import table

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
BYTES = {c: b for b, c in align.Encoder(A_PATH).alphabet.items()}


def tokens(text):
    """(ids, bytes) of both sides, None if a side does not give back the text."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(BYTES[c] for c in A.id_to_token(i))) for i in a]
    b = [(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace(chr(0x2581), " ").encode())
         for i, p in ((i, B.id_to_piece(i)) for i in B.encode(text))]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else None


def by_bytes(text):
    """(groups, links) of one text: which tokens hold each byte, and where both sides end a token."""
    both = tokens(text)
    if both is None:
        return [], []
    held = []
    for side in both:
        held.append([k for k, (_, x) in enumerate(side) for _ in x])
    links = sorted(set(zip(*held)))
    groups, a_ids, b_ids, last = [], [], [], (None, None)
    for at, (x, y) in enumerate(zip(*held)):
        if x != last[0]:
            a_ids.append(both[0][x][0])
        if y != last[1]:
            b_ids.append(both[1][y][0])
        last = (x, y)
        if at + 1 == len(held[0]) or held[0][at + 1] != x and held[1][at + 1] != y:
            groups.append((a_ids, b_ids))
            a_ids, b_ids = [], []
    return groups, [(both[0][x][0], both[1][y][0]) for x, y in links]


def expected(rows):
    made = [(d, *by_bytes(t)) for d, t in rows]
    count = Counter(pair for _, _, links in made for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for doc, groups, links in made:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else "",
                    sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links)))
    return sorted(out, key=str)


def check(spark, docs):
    got = sorted(map(tuple, align.align(docs, A_PATH, B_PATH).collect()), key=str)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_documents(spark):
    check(spark, table(spark, SF001, "documents", "doc_id", "text").repartition(3))


def test_many_parcels(spark, monkeypatch):
    from strata.llm import common

    docs = table(spark, SF001, "documents", "doc_id", "text").limit(60).coalesce(1)
    seen = align.parcels(docs, A_PATH, B_PATH)
    assert seen.select("parcel").distinct().count() == 1
    # the same documents in 20 tasks, so in 20 parcels, get the same counts
    check(spark, common.written(docs, "some").repartition(20))


def test_edge_cases(spark):
    check(spark, edge.documents(spark))
    assert align.align(edge.none(spark), A_PATH, B_PATH).count() == 0


SOME = ["a", "Hello", " ", "  ", "\n", "\t", ".", "it's", "'ll", "12", "<s>", "</s>", "<unk>", "<0x0A>", "<|endoftext|>", "é",
        "漢字", "\U0001f600", "é", chr(0x2581), chr(0x3000), chr(0xa0), "\x00", "\x1e", "\r", "ñandú", "zzqx", "​", "İ"]


def of_aligner(texts):
    work = align.Aligner(A_PATH, B_PATH) if not ALIGNERS else ALIGNERS[0]
    ALIGNERS[:] = [work]
    chunks, counts, links, link_sizes, digests = work.parcel(pa.array(texts, pa.large_string()))
    starts = np.cumsum(link_sizes) - link_sizes
    out = []
    for mine, (n_a, n_b, n_groups), digest in zip(chunks, counts.tolist(), digests):
        pairs = [divmod(int(x), len(B)) for k in mine for x in links[starts[k]:starts[k] + link_sizes[k]]]
        out.append((n_a, n_b, n_groups, digest, Counter(pairs)))
    return out


ALIGNERS: list = []


def same(texts):
    for text, got in zip(texts, of_aligner(texts)):
        groups, links = by_bytes(text)
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        want = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                hashlib.sha256(written.encode()).hexdigest() if groups else "", Counter(links))
        assert got == want, text
        assert align.groups_of(text, A_PATH, B_PATH) == groups


def test_random_texts():
    rng = random.Random(6)
    same(["".join(rng.choice(SOME) for _ in range(rng.randint(0, 14))) for _ in range(1500)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(texts):
    same(texts)


def test_pointer_jumping_on_chains():
    """One chain over all tokens: every token ends inside one of the other side, but for the last."""
    a, b = np.array([3] * 50 + [2]), np.array([2] + [3] * 50)
    a_group, b_group, of_a, of_b = align.aligned(np.zeros(51), a, np.zeros(51), b)
    assert set(a_group) == set(b_group) == {0} and len(of_a) == 101
    a_group, b_group, _, _ = align.aligned(np.zeros(4), np.array([1, 2, 3, 1]), np.zeros(3), np.array([3, 2, 2]))
    assert a_group.tolist() == [0, 0, 1, 1] and b_group.tolist() == [0, 1, 1]


def test_a_long_text_is_one_parcel():
    """A text longer than a parcel, with parts that must be encoded whole."""
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdeéß.,\n") for _ in range(rng.randint(1, 9))) for _ in range(450_000))
    assert len(text.encode()) > align.PARCEL_BYTES
    same([text[:60_000], text[:30_000].replace("a", "  ")])
    n_a, n_b, n_groups, digest, links = of_aligner([text])[0]
    assert digest and n_groups < min(n_a, n_b) and links.total() >= max(n_a, n_b)
    assert n_a == len(A.encode(" " + text, add_special_tokens=False).ids) and n_b == len(B.encode(text))
