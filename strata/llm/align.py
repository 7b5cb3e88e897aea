"""Alignment of the tokens that two tokenizers make of the same texts, by pointer jumping.

Both cut the bytes of a text, preceded by a space, into tokens. Tokens of the two sides that share a byte are linked;
the connected components are the groups between the byte offsets at which both sides end a token. Every token points
to the farthest-right token that overlaps it (one that ends a group points to itself). Successor doubling, vectorised
over all tokens of a batch, takes each to the terminal token of its component in a logarithmic number of rounds, and
terminal tokens label the groups.

A link's weight is the number of documents of the whole corpus that hold its pair of ids. Texts are worked on in
parcels of bounded size, or of one text if it is longer. A parcel keeps its distinct chunks (no token of either side
crosses a space between two other characters) with their links, its documents as lists of chunks, and counts its pairs
once. The counts of all parcels are added up by pair, and each parcel fetches those of its own pairs: nothing is
broadcast, and no task holds more than a parcel.

Defined results: null and empty texts, and texts of which a side does not give back the bytes, have no tokens: all
counts are zero and ``groups_sha256`` is ''; ties for the highest count of an id are all best; very long texts are a
parcel of their own; rows with a null doc_id and repeated rows are documents like any other and counted each; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import ship_code, text_or_empty, written
from strata.llm.tokens import Encoder, Sequences, per_group, pieces_of

PARCEL_BYTES = 1 << 21
#: chunks that a process aligns at a time, and those that it remembers
ALIGNED_TOGETHER = 1 << 15
REMEMBERED = 250_000
SPACE_MARK = chr(0x2581)


def farthest_right(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The successor of every token, those of A first: the last token of the other side that overlaps it, if that ends
    later or the token is of A, else itself. The ends are those of consecutive tokens over the same bytes."""
    n = len(a_ends)
    of_a = n + np.searchsorted(b_ends, a_ends)
    over = np.searchsorted(a_ends, b_ends)
    of_b = np.where(a_ends[over] > b_ends, over, n + np.arange(len(b_ends))) if n else np.zeros(0, np.int64)
    return np.concatenate([of_a, of_b])


def terminals(successor: np.ndarray) -> np.ndarray:
    """The token at the end of every chain of successors, by doubling."""
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor
        successor = further


def aligned(a_ids: np.ndarray, a_bytes: np.ndarray, b_ids: np.ndarray, b_bytes: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group of each A token, group of each B token, A token of each link, B token of each link) for the tokens of
    any number of texts over the same bytes; groups are numbered from 0 in order, ``*_bytes`` are lengths."""
    a_ends, b_ends = np.cumsum(a_bytes), np.cumsum(b_bytes)
    n = len(a_ends)
    last = terminals(farthest_right(a_ends, b_ends))
    ends = np.zeros(n + len(b_ends) + 1, np.int64)
    ends[last[n:] + 1] = 1
    group = np.cumsum(ends)[last]
    first_b = np.searchsorted(b_ends, a_ends - a_bytes, "right")
    some = np.searchsorted(b_ends, a_ends) - first_b + 1
    of_a = np.repeat(np.arange(n), some)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(some) - some - first_b, some)
    return group[:n], group[n:], of_a, of_b


class Aligner(Encoder):
    """Tokens of both sides by chunk: A of a byte-level tokenizers file, B of a sentencepiece model."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=b_path)
        super().__init__(a_path, special_as_text=True)
        if not self.keeps_spaces:
            raise ValueError("the first tokenizer must be a byte-level one")
        byte_of = {c: b for b, c in self.alphabet.items()}
        self.a_pieces = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.a_pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        names = [self.pieces.id_to_piece(i) for i in range(len(self.pieces))]
        if any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names):
            raise ValueError("pieces of the second tokenizer cross spaces")
        self.b_pieces = [bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace(SPACE_MARK, " ").encode()
                         for i, name in enumerate(names)]
        self.a_bytes, self.b_bytes = (np.array(list(map(len, x)), np.int64) for x in (self.a_pieces, self.b_pieces))
        self.remembered = REMEMBERED
        self.odd += "| $"  # a space at the end is a piece of its own

    def _forget(self) -> None:
        super()._forget()
        self.links, self.counts, self.groups = Sequences(), Sequences(), []

    def _learn(self, chunks: list[str]) -> list[str]:
        first = self.chunk_ids.count
        chunks = super()._learn(chunks)
        for at in range(0, len(chunks), ALIGNED_TOGETHER):
            some = chunks[at:at + ALIGNED_TOGETHER]
            numbers = np.arange(first + at, first + at + len(some))
            sizes = self.chunk_ids.sizes(numbers)
            self.add(some, self.chunk_ids.gather(numbers, sizes), sizes)
        return chunks

    def add(self, chunks: list[str], a_ids: np.ndarray, a_sizes: np.ndarray) -> None:
        """Align chunks, each with the space before it, whose A ids are known. ``links`` gets the pairs of each,
        ``counts`` its numbers of tokens of A, of B and of groups, ``groups`` its groups as text (None: the bytes of a
        side differ)."""
        found = self.pieces.encode([c[1:] for c in chunks], num_threads=1) if chunks else []
        data = [c.encode() for c in chunks]
        pieces = self.b_pieces
        good = np.fromiter((b"".join([pieces[x] for x in ids]) == d for ids, d in zip(found, data)), bool, len(chunks))
        # byte-level tokens are made of the bytes themselves, so their number tells whether all are there
        good &= per_group(self.a_bytes[a_ids], a_sizes) == np.fromiter(map(len, data), np.int64, len(chunks))
        b_sizes = np.array([len(x) if g else 0 for x, g in zip(found, good)], np.int64)
        b_ids = np.array([y for x, g in zip(found, good) if g for y in x], np.int64)
        a_ids, a_sizes = a_ids[np.repeat(good, a_sizes)].astype(np.int64), np.where(good, a_sizes, 0)
        a_group, b_group, of_a, of_b = aligned(a_ids, self.a_bytes[a_ids], b_ids, self.b_bytes[b_ids])
        chunk_of_a = np.repeat(np.arange(len(chunks)), a_sizes)
        self.links.add(a_ids[of_a] * len(self.b_pieces) + b_ids[of_b], np.bincount(chunk_of_a[of_a], minlength=len(chunks)))
        cuts = np.flatnonzero(np.diff(a_group, prepend=-1))  # the first A token of each group
        n_groups = np.bincount(chunk_of_a[cuts], minlength=len(chunks))
        self.counts.add(np.stack([a_sizes, b_sizes, n_groups], axis=1).ravel(), np.full(len(chunks), 3))
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        a_cuts = [*cuts.tolist(), len(a_ids)]
        b_cuts = [*np.flatnonzero(np.diff(b_group, prepend=-1)).tolist(), len(b_ids)]
        made = [",".join(a_text[a:c]) + "|" + ",".join(b_text[b:d])
                for a, c, b, d in zip(a_cuts, a_cuts[1:], b_cuts, b_cuts[1:])]
        at = 0
        for n, g in zip(n_groups.tolist(), good.tolist()):
            self.groups.append(";".join(made[at:at + n]) if g else None)
            at += n

    def parcel(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """The texts of a parcel: the chunks of each (places among those of the parcel), counts of A, B and groups, the
        links of all chunks with the number of each, and the digests of the groups."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
        odd = pc.match_substring_regex(spaced, self.odd).to_numpy(zero_copy_only=False)
        numbers, per_text = self.numbers(spaced.filter(pa.array(~odd)))
        mine = iter(np.split(numbers, np.cumsum(per_text)[:-1]))
        chunks = []
        for row, is_odd in enumerate(odd.tolist()):
            if is_odd:  # a chunk of its own, not remembered
                text = spaced[row].as_py()
                ids = np.frombuffer(self.whole(text), "<u4")
                chunks.append(np.array([self.chunk_ids.count]))
                self.chunk_ids.add(ids, np.array([len(ids)], np.int64))
                self.add([text], ids, np.array([len(ids)], np.int64))
            else:
                chunks.append(next(mine))
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        digests, groups = [], self.groups
        for i, numbers in enumerate(chunks):
            some = [groups[k] for k in numbers.tolist()]
            if empty[i] or None in some:
                chunks[i] = np.zeros(0, np.int64)
                digests.append("")
            else:
                digests.append(hashlib.sha256(";".join(filter(None, some)).encode()).hexdigest())
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        used, places = np.unique(np.concatenate(chunks), return_inverse=True)
        three = np.full(len(used), 3)
        counts = self.counts.gather(used, three).reshape(-1, 3).astype(np.int64)
        per_doc = np.stack([per_group(counts[places, k], sizes) for k in range(3)], axis=1)
        link_sizes = self.links.sizes(used)
        return np.split(places, np.cumsum(sizes)[:-1]), per_doc, self.links.gather(used, link_sizes), link_sizes, digests


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def parcels(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of three kinds, by ``parcel``: documents (kind 0: counts, digest and the places of their chunks in
    ``data``), the chunks of the parcel (kind 1: places of their pairs in ``data``, how many in ``sizes``), and its
    pairs (kind 2: ``pair``, its ``place``, and ``times``, the number of documents that hold it)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["parcel", "kind", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "data", "sizes", "pair",
             "place", "times"]
    schema = (f"parcel long, kind int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, data binary, sizes binary, pair long, place int, times long")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in source:
            at = 0
            for texts in pieces_of(batch.column("_t"), PARCEL_BYTES):
                for out in rows(number, batch.column("doc_id").slice(at, len(texts)), *work.parcel(texts)):
                    columns = [out.get(n) for n in names]
                    size = len(out["kind"])
                    types = [work_types.get(n) or batch.column("doc_id").type for n in names]
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(size, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t)
                         for c, t in zip(columns, types)], names)
                at += len(texts)
                number += 1

    def rows(parcel, ids, chunks, per_doc, links, link_sizes, digests) -> Iterator[dict]:
        pairs, link_places = np.unique(links, return_inverse=True)
        doc_sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        places = np.concatenate(chunks) if chunks else np.zeros(0, np.int64)
        n_links = per_group(link_sizes[places], doc_sizes)
        # the pairs of each document once: of its distinct chunks, all links
        doc_chunk = np.unique(np.repeat(np.arange(len(chunks)), doc_sizes) * max(1, len(link_sizes)) + places)
        doc, chunk = np.divmod(doc_chunk, max(1, len(link_sizes)))
        some = link_sizes[chunk]
        starts = np.cumsum(link_sizes) - link_sizes
        at = np.repeat(starts[chunk] - np.cumsum(some) + some, some) + np.arange(some.sum())
        held = np.unique(np.repeat(doc, some) * max(1, len(pairs)) + link_places[at])
        times = np.bincount(held % max(1, len(pairs)), minlength=len(pairs)) if len(pairs) else pairs
        same = lambda x, n: np.full(n, x)
        n = len(chunks)
        yield {"parcel": same(parcel, n), "kind": same(0, n), "doc_id": ids, "n_a": per_doc[:, 0], "n_b": per_doc[:, 1],
               "n_groups": per_doc[:, 2], "n_links": n_links, "groups_sha256": digests,
               "data": [c.astype("<u4").tobytes() for c in chunks]}
        yield {"parcel": [parcel], "kind": [1], "data": [link_places.astype("<u4").tobytes()],
               "sizes": [link_sizes.astype("<u4").tobytes()]}
        if len(pairs):
            yield {"parcel": same(parcel, len(pairs)), "kind": same(2, len(pairs)), "pair": pairs.astype(np.int64),
                   "place": np.arange(len(pairs)), "times": times}

    work_types = {n: pa.int64() for n in names} | {"kind": pa.int32(), "place": pa.int32(), "groups_sha256": pa.string(),
                                                   "data": pa.binary(), "sizes": pa.binary(), "doc_id": None}
    ship_code(docs.sparkSession)
    return docs.select("doc_id", text_or_empty().alias("_t")).mapInArrow(batches, schema)


def weighed(parcel: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one parcel with n_best and count_sum; ``counts`` (place, count, best) are those of its pairs."""
    kinds = parcel.column("kind").to_numpy()
    docs = parcel.filter(pa.array(kinds == 0))
    chunk_row = parcel.filter(pa.array(kinds == 1))
    links = np.frombuffer(chunk_row.column("data")[0].as_py(), "<u4").astype(np.int64)
    sizes = np.frombuffer(chunk_row.column("sizes")[0].as_py(), "<u4").astype(np.int64)
    places = [np.frombuffer(b, "<u4").astype(np.int64) for b in docs.column("data").to_pylist()]
    doc_sizes = np.fromiter(map(len, places), np.int64, len(places))
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    out = []
    for name in ("best", "count"):
        of_pair = np.zeros(len(counts), np.int64)
        of_pair[counts.column("place").to_numpy()] = counts.column(name).to_numpy()
        out.append(per_group(per_group(of_pair[links], sizes)[places], doc_sizes))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1]))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row of ``docs`` (doc_id, text):
    ``a_path`` is a byte-level tokenizers file, ``b_path`` a sentencepiece model, both on every node."""
    made = written(parcels(docs, a_path, b_path), "parcels")
    b_size = _piece_count(b_path)
    pairs = made.where("kind = 2").select("parcel", "pair", "place", "times")
    totals = pairs.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("a", F.expr(f"pair div {b_size}"))
    most = totals.groupBy("a").agg(F.max("count").alias("most"))
    totals = totals.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    counts = pairs.drop("times").join(totals, "pair").select(F.col("parcel").alias("of"), "place", "count", "best")
    rest = made.where("kind < 2").drop("pair", "place", "times")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rest.groupBy("parcel").cogroup(counts.groupBy("of")).applyInArrow(
        weighed, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, "
                 "count_sum long")


def _piece_count(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return len(SentencePieceProcessor(model_file=path))


def groups_of(text: str, a_path: str, b_path: str) -> list[tuple[list[int], list[int]]]:
    """The groups of one text: ids of A and of B. Empty if it has no tokens."""
    work = aligner(a_path, b_path)
    chunks, _, _, _, digests = work.parcel(pa.array([text], pa.large_string()))
    if not digests[0]:
        return []
    a = np.frombuffer(work.whole(" " + text), "<u4").astype(np.int64)
    b = np.array(work.pieces.encode(text), np.int64)
    a_group, b_group, _, _ = aligned(a, work.a_bytes[a], b, work.b_bytes[b])
    return [(a[a_group == g].tolist(), b[b_group == g].tolist()) for g in range(a_group[-1] + 1)]
