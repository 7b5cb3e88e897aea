"""Packing of documents into sequences of a fixed number of tokens by minimum bin slack.

Every task packs the documents that it reads: no shuffle, and the result of a task does not depend on any other, so a
lost one is simply done again. A document is its token ids and an end id. Whole multiples of the capacity become
sequences of their own; the rest of a document waits in a pool of bounded size. The pool is a multiset of lengths: the
longest waiting piece opens a window, and a subset-sum dynamic programme over the other lengths, one big integer as a
bitset and one shift per copy class, finds the multiset that fills the window closest to its capacity. The copies of
each length are read back from the bitsets, and the pattern found is used as often as its lengths are there. Where no
multiset fills the window, one more piece is cut to fill it. A task therefore pads one sequence at most, its last.

Defined results: a null or empty text is one end id; a very long text is cut into whole sequences and a rest; of pieces of
equal length the one that came last is placed first; repeated rows are packed each; rows with a null doc_id are packed
like any other; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import ship_code, text_or_empty
from strata.llm.tokens import encoder

CAPACITY = 1024
END_ID = 0
POOL = 4096
#: chunks that the encoder of a task remembers; with the pieces in work about 400 MB
REMEMBERED = 500_000
OUT = "doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def best_fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """Copies of each length, at most ``counts``, with the largest sum that is not above ``target``. Longer lengths are
    taken first, so the short ones stay for windows that need them."""
    bits, steps, mask = 1, [], (1 << (target + 1)) - 1
    for length in sorted((x for x in counts if 0 < x <= target and counts[x]), reverse=True):
        steps.append((length, bits))
        left, some = min(counts[length], target // length), 1
        while left:
            some = min(some, left)
            bits |= (bits << (some * length)) & mask
            left -= some
            some *= 2
        if bits >> target & 1:
            break
    total, copies = bits.bit_length() - 1, {}
    for length, before in reversed(steps):
        taken = 0
        while not before >> (total - taken * length) & 1:
            taken += 1
        if taken:
            copies[length] = taken
            total -= taken * length
    return copies


class Packer:
    """Packs pieces (doc, start, ids as bytes) into sequences; ``out`` takes (piece, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, pool: int = POOL):
        self.capacity, self.pool = capacity, pool
        self.waiting: dict[int, list] = {}
        self.held = self.sequences = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids in pieces:
            self.out.append((doc, start, ids, self.sequences, at))
            at += len(ids) // 4
        self.sequences += 1

    def _take(self, length: int) -> tuple:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
        self.held -= 1
        return piece

    def _wait(self, piece: tuple) -> None:
        self.waiting.setdefault(len(piece[2]) // 4, []).append(piece)
        self.held += 1

    def add(self, doc, ids: bytes) -> None:
        step = 4 * self.capacity
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self._emit([(doc, at // 4, ids[at:at + step])])
        if whole < len(ids):
            self._wait((doc, whole // 4, ids[whole:]))
        if self.held >= self.pool:
            self.fill(self.pool // 2)

    def fill(self, leave: int) -> None:
        """Fill windows until at most ``leave`` pieces wait."""
        while self.held > leave:
            longest = max(self.waiting)
            counts = {x: len(p) for x, p in self.waiting.items()}
            counts[longest] -= 1
            copies = best_fill(counts, self.capacity - longest)
            slack = self.capacity - longest - sum(x * n for x, n in copies.items())
            copies[longest] = copies.get(longest, 0) + 1
            times = min(len(self.waiting[x]) // n for x, n in copies.items()) if not slack else 1
            for _ in range(times):
                pieces = [self._take(x) for x, n in copies.items() for _ in range(n)]
                if slack and self.waiting:  # nothing fits any more: cut what is longest among the rest
                    doc, start, ids = self._take(max(self.waiting))
                    pieces.append((doc, start, ids[:4 * slack]))
                    self._wait((doc, start + slack, ids[4 * slack:]))
                self._emit(pieces)


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
         pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.
    ``tokenizer`` is the path of a tokenizers file on every node."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer), Packer(capacity, pool)
        coder.remembered = REMEMBERED
        first_sequence = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()

        def rows() -> pa.RecordBatch:
            pieces, packer.out = packer.out, []
            docs, starts, ids, sequences, offsets = zip(*pieces)
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in docs], doc_type), pa.array(starts, pa.int64()),
                pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                pa.array([d[1] for d in docs], pa.int64()),
                pa.array([first_sequence + s for s in sequences], pa.int64()), pa.array(offsets, pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        doc_type = pa.int64()
        for batch in source:
            doc_type = batch.schema.field("doc_id").type
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("_t"))):
                ids += end
                packer.add((doc, len(ids) // 4), ids)
                if len(packer.out) >= 2048:
                    yield rows()
            pa.default_memory_pool().release_unused()
        coder.rest()
        packer.fill(0)
        if packer.out:
            yield rows()

    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("_t")).mapInArrow(batches, OUT.format(kind=kind))
