"""Chunked encoding against the tokenizer itself, on real and on random texts; token files and Elias-Fano."""

import random
import zlib

import edge
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from strata.llm import tokenfile, tokens
from strata.llm.common import table
from strata.session import scratch_dir

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


#: strings of added tokens at every place, alone, doubled, in other case and cut short
ADDED = [t.replace("X", x) for x in ("<|endoftext|>", "<|startoftext|>") for t in (
    "X", "XX", "X one two", "one X two", "oneXtwo", "one two X", " X ", "X\n\nX", "one X X two X")]
ADDED += ["<|EndOfText|> a", "<|endoftext| > a", "<|endof text|>", "< |endoftext|>"]


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("as_text", [False, True])
def test_strings_of_added_tokens(name, as_text):
    path = public_tokenizers.path(name)
    untouched = Tokenizer.from_file(path)
    if as_text:
        untouched.encode_special_tokens = True
    assert list(tokens.Encoder(path, as_text).encode(ADDED)) == [ids_of(untouched, t) for t in ADDED]


@pytest.mark.parametrize("name", FILES)
def test_chunked_encoding_equals_whole_encoding(spark, name):
    coder = tokens.Encoder(public_tokenizers.path(name))
    texts = [r["text"] or "" for r in table(spark, SF001, "documents", "text").collect()]
    rng = random.Random(3)
    some = "ab cA'sS'll\n\t  .,!éßİΣς́ 12½²٣\x1c  漢\U0001f600<|endoftext|>_-\r"
    texts += ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += ["".join(chr(rng.randint(1, 0x24f)) for _ in range(30)) for _ in range(1000)]
    untouched = Tokenizer.from_file(public_tokenizers.path(name))
    assert list(coder.encode(texts)) == [ids_of(untouched, t) for t in texts]


CODERS = [tokens.Encoder(public_tokenizers.path(name)) for name in FILES]
PLAIN = [Tokenizer.from_file(public_tokenizers.path(name)) for name in FILES]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(texts):
    for coder, plain in zip(CODERS, PLAIN):
        assert list(coder.encode(texts)) == [ids_of(plain, t) for t in texts]


def test_a_full_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    monkeypatch.setattr(tokens, "TOGETHER_CHARS", 100)
    coder = tokens.Encoder(public_tokenizers.path(FILES[0]))
    texts = [edge.sentence(i, 9) for i in range(40)]
    assert list(coder.encode(texts)) == [coder.whole(t) for t in texts]
    assert len(coder.known) < 60


def test_elias_fano_selects_every_value():
    rng = np.random.default_rng(2)
    for size, top in ((0, 0), (1, 0), (1, 10**12), (5, 3), (1000, 1000), (3000, 10**9), (129, 128)):
        values = np.sort(rng.integers(0, top + 1, size))
        data = tokenfile.EliasFano.of(values).to_bytes()
        back, end = tokenfile.EliasFano.from_bytes(memoryview(b"xx" + data + b"yy"), 2)
        assert end == 2 + len(data)
        assert back.all().tolist() == values.tolist()
        assert [back.select(i) for i in range(size)] == values.tolist()
        if size >= 1000:  # near-minimal space: 2 + log2(u / n) bits a value, and the samples
            assert 8 * len(data) < size * (3.5 + np.log2(top / size + 1)) + 200


def expected(docs, coder, end):
    at, out = 0, []
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    for r in sorted(docs.collect(), key=order):
        ids = coder.whole(r["text"] or "") + np.array([end], "<u4").tobytes()
        out.append((r["doc_id"], at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def read_back(spark, docs, **options):
    folder = scratch_dir(spark, "test-tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenfile.write_token_files(docs, folder, path, end_id=1, vocabulary=49408, **options)
    rows = tokenfile.document_offsets(tokenfile.read_token_files(spark, folder)).collect()
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_files_hold_every_document_in_order(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text")
    want = expected(docs, CODERS[1], 1)
    assert read_back(spark, docs) == want
    assert read_back(spark, docs, block_ids=700) == want  # many blocks and files


def test_edge_cases(spark):
    docs = edge.documents(spark)
    got, want = read_back(spark, docs), expected(docs, CODERS[1], 1)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in want)
    assert got[-1][1] + got[-1][2] == want[-1][1] + want[-1][2]
    assert read_back(spark, edge.none(spark)) == []


def test_tokenizer_is_the_public_one():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    ids = tokenizer.encode("some words, 12 of them", add_special_tokens=False).ids
    assert np.frombuffer(next(CODERS[0].encode(["some words, 12 of them"])), "<u4").tolist() == ids
