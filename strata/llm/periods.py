"""Periodic runs in word sequences by block convolution.

A run is a maximal stretch of consecutive words in which words one period apart are equal, of at least ``COPIES``
periods (its smallest) and ``LEAST`` words. It is found at the dyadic scale B with B/2 < period <= B (the first scale
takes all periods up to 4): words become numbers, and blocks of B words that start every B/2 words are laid over the
following window at all distances up to B at once. The sum of squared differences is a convolution; a number theoretic
transform modulo a prime gives it in exact integers, for all blocks of a batch of texts in one array; blocks with a word
that does not stand again within B words can have no zero and are left out. A run so long
holds, at this scale, a whole block together with its copy one period later, and no smaller distance can match there,
because a block at least as long as the smallest period of its surroundings recurs at multiples of it only. So the
first distance without a mismatch is the only seed of a block. A zero modulo the prime is compared word by word, and
the next zero is tried if it was none.

Seeds of consecutive blocks with one distance lie in one stretch and are joined; each stretch is then extended to both
sides, by less than one block step. Time is O(n log^2 n) for a text of n words, whatever it holds; memory is bounded
by the longest text of a batch. Every text is worked on in the task that reads it: no shuffle, and a lost task is
simply done again.

Defined results: a null or empty text has no words and no runs; ties of the strongest run go to the smallest start,
then the smallest period; very long texts are searched whole, at all scales; rows with a null doc_id and repeated rows
are taken each for itself; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import ship_code, text_or_empty

COPIES = 4
LEAST = 6
FIRST_SCALE = 4
#: (kind of number, prime, primitive root, longest transform); products of residues are exact in the kind's mantissa
FIELDS = ((np.float64, 11 * (1 << 21) + 1, 3, 1 << 21), (np.longdouble, 15 * (1 << 27) + 1, 31, 1 << 27))
#: stages of a transform after which sums are reduced
LAZY = 3
#: words of a batch of texts, and numbers in one array of transforms
TOGETHER_WORDS = 1 << 17
TOGETHER_NUMBERS = 1 << 15


class Field:
    """Integers modulo a prime, as whole numbers from -prime/2 to prime/2, and transforms of one size over them."""

    def __init__(self, size: int):
        self.kind, self.prime, root, _ = next(f for f in FIELDS if size <= f[3])
        self.size = size
        self._one_by = 1 / self.kind(self.prime)
        root = pow(root, (self.prime - 1) // size, self.prime)
        self.halves = [size >> k for k in range(1, size.bit_length())]
        self.forth = [self._powers(pow(root, size // (2 * h), self.prime), h) for h in self.halves]
        self.back = [self._powers(pow(root, size - size // (2 * h), self.prime), h) for h in self.halves]
        place = np.zeros(1, np.int64)
        while len(place) < size:
            place = np.concatenate([2 * place, 2 * place + 1])
        #: where the frequency -k stands, if k stands here: a transform leaves them with the bits of k reversed
        self.negative = place[(size - place) % size]
        self.shrink = self.reduced(np.array([pow(size, self.prime - 2, self.prime)], self.kind))

    def _powers(self, base: int, n: int) -> np.ndarray:
        out = np.ones(1, self.kind)
        while len(out) < n:  # doubling
            factor = self.reduced(np.array([pow(base, len(out), self.prime)], self.kind))
            out = np.concatenate([out, self.reduced(out * factor)])
        return out[:n]

    def reduced(self, values: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """``values`` modulo the prime; they must be exact."""
        times = values * self._one_by
        np.rint(times, out=times)
        times *= self.prime
        return np.subtract(values, times, out=times if out is None else out)

    def transform(self, rows: np.ndarray) -> np.ndarray:
        """Number theoretic transform of every row, in bit-reversed order of frequencies."""
        n = len(rows)
        for stage, w in enumerate(self.forth):
            pairs = rows.reshape(n, -1, 2, len(w))
            a, b = pairs[:, :, 0], pairs[:, :, 1]
            rows = np.empty_like(pairs)
            np.add(a, b, out=rows[:, :, 0])
            less = a - b
            less *= w
            self.reduced(less, rows[:, :, 1])
            if stage % LAZY == LAZY - 1:
                self.reduced(rows[:, :, 0], rows[:, :, 0])
        return self.reduced(rows.reshape(n, self.size))

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        """The rows whose :meth:`transform` is ``rows``."""
        n = len(rows)
        for stage, w in enumerate(reversed(self.back)):
            pairs = rows.reshape(n, -1, 2, len(w))
            a, b = pairs[:, :, 0], self.reduced(pairs[:, :, 1] * w)
            rows = np.empty_like(pairs)
            np.add(a, b, out=rows[:, :, 0])
            np.subtract(a, b, out=rows[:, :, 1])
            if stage % LAZY == LAZY - 1:
                rows = self.reduced(rows)
        return self.reduced(self.reduced(rows.reshape(n, self.size)) * self.shrink)


@lru_cache(maxsize=None)
def field(size: int) -> Field:
    return Field(size)


def differences(blocks: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, between every block of B numbers (row of ``blocks``) and the
    window of 2 B numbers that it begins and ``after`` ends, at the distances 1..B."""
    n, width = blocks.shape
    f = field(2 * width)
    wide = np.zeros((2 * n, 2 * width), f.kind)
    f.reduced(blocks.astype(f.kind), wide[:n, :width])
    f.reduced(after.astype(f.kind), wide[n:, :width])
    squares = np.zeros((n, 2 * width + 1), f.kind)
    squares[:, 1:width + 1], squares[:, width + 1:] = wide[:n, :width], wide[n:, :width]
    np.cumsum(f.reduced(squares * squares), axis=1, out=squares)
    wide = f.transform(wide)
    block, window = wide[:n], wide[n:]
    # ``after`` stands B places later: the even frequencies (first half) keep their sign, the odd ones change it
    np.negative(window[:, width:], out=window[:, width:])
    window += block
    both = f.inverse(f.reduced(block[:, f.negative] * window))[:, 1:width + 1]
    total = squares[:, width:width + 1] + squares[:, width + 1:] - squares[:, 1:width + 1]
    return f.reduced(total - 2 * both)


def recurrence(words: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many words after each word the same one stands again in its text; more than any text is long: nowhere."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), len(words) + 1)
    again = (words[order[1:]] == words[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def _first_matches(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, scale: int) -> np.ndarray:
    """The first distance up to ``scale`` at which the block at each start recurs before the end of its text; 0: none."""
    span = np.arange(scale)
    at = starts[:, None] + scale + span
    after = np.where(at < ends[:, None], words[np.minimum(at, len(words) - 1)], 0)
    zero = differences(words[at - scale], after) == 0
    zero &= at + 1 <= ends[:, None]
    out = np.zeros(len(starts), np.int64)
    left = np.flatnonzero(zero.any(axis=1))
    while len(left):
        first = zero[left].argmax(axis=1)
        here = starts[left][:, None] + span
        equal = (words[here] == words[here + first[:, None] + 1]).all(axis=1)
        out[left[equal]] = first[equal] + 1
        zero[left[~equal], first[~equal]] = False
        left = left[~equal]
        left = left[zero[left].any(axis=1)]
    return out


def _extended(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: np.ndarray, end: np.ndarray,
              period: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches [lo, hi) of words that equal those one period later, extended by up to ``step`` words either way."""
    grown = []
    for edge, way in ((lo - 1, -1), (hi, 1)):
        more = np.zeros(len(lo), np.int64)
        for some in range(0, len(lo), max(1, (1 << 18) // step)):
            part = slice(some, some + max(1, (1 << 18) // step))
            at = edge[part, None] + way * np.arange(step)
            p = period[part, None]
            good = (at >= first[part, None]) & (at + p < end[part, None])
            at = np.where(good, at, first[part, None])
            good &= words[at] == words[np.where(good, at + p, at)]
            more[part] = np.where(good.all(axis=1), step, (~good).argmax(axis=1))
        grown.append(more)
    return lo - grown[0], hi + grown[1]


def runs_of(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(text, start, length, period) of every run, sorted so. ``words`` are the numbers of the words of all texts, one
    text after another; ``sizes`` the numbers of words of the texts."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    found, scale = [], FIRST_SCALE
    apart, width = recurrence(words, ends, sizes), 1  # the largest recurrence in the block of ``width`` at each word
    while True:
        step = scale // 2
        smallest = 1 if scale == FIRST_SCALE else step + 1
        texts = np.flatnonzero(sizes >= max(LEAST, COPIES * smallest))
        if not len(texts):
            break
        while width < scale:
            apart, width = np.maximum(apart[:-width], apart[width:]), 2 * width
        rows = -(-sizes[texts] // step)
        row_text = np.repeat(texts, rows)
        row_start = begins[row_text] + step * (np.arange(len(row_text)) - np.repeat(np.cumsum(rows) - rows, rows))
        period = np.zeros(len(row_text), np.int64)
        # a block recurs within ``scale`` words only if all its words do
        able = np.flatnonzero(row_start < len(apart))
        able = able[apart[row_start[able]] <= scale]
        some = max(4, TOGETHER_NUMBERS // (4 * scale))
        for at in range(0, len(able), some):
            part = able[at:at + some]
            period[part] = _first_matches(words, row_start[part], ends[row_text[part]], scale)
        period[period < smallest] = 0
        seeds = np.flatnonzero(period)
        if len(seeds):
            joined = (np.diff(seeds) == 1) & (np.diff(row_text[seeds]) == 0) & (np.diff(period[seeds]) == 0)
            heads, tails = seeds[np.r_[True, ~joined]], seeds[np.r_[~joined, True]]
            text, p = row_text[heads], period[heads]
            lo, hi = _extended(words, row_start[heads], row_start[tails] + scale, begins[text], ends[text], p, step)
            length = hi - lo + p
            long = length >= np.maximum(LEAST, COPIES * p)
            found.append(np.stack([text, lo - begins[text], length, p], axis=1)[long])
        scale *= 2
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, length, period) with the greatest length / period; ties: the smallest start, then period."""
    best = None
    for run in runs:  # in ascending order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [w for w, k in zip(words, keep.tolist()) if k]
    return b" ".join(words)


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of bytes other than ASCII white space."""
    return text.split()


COLUMNS = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string")


def find_runs(docs: DataFrame, reshape: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
              with_collapsed: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the number of words and of runs, the strongest run (start,
    length, period, a thousand times length / period), and digests of all runs and of the text without repetitions;
    with ``with_collapsed`` also ``runs`` (start, length, period) and that text, ``collapsed``. ``reshape`` may change
    the words of a document before the search."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            docs, texts, held = [], [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("_t").to_pylist()):
                words = words_of(text)
                texts.append(reshape(doc, words) if reshape else words)
                docs.append(doc)
                held += len(words)
                if held >= TOGETHER_WORDS:
                    yield searched(docs, texts, batch.schema.field("doc_id").type)
                    docs, texts, held = [], [], 0
            if docs:
                yield searched(docs, texts, batch.schema.field("doc_id").type)

    def searched(docs: list, texts: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
        number = defaultdict(count(1).__next__)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for text, *run in runs_of(words, sizes).tolist():
            runs.setdefault(text, []).append((run[0], run[1], run[2]))
        rows = []
        for i, text in enumerate(texts):
            mine = sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))
            best = strongest(mine)
            short = collapsed(text, mine)
            listed = "".join(f"{a},{b},{c}\n" for a, b, c in mine)
            rows.append((docs[i], len(text), len(mine), *(best or (None,) * 3),
                         best and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(),
                         hashlib.sha256(short).hexdigest(),
                         *(([dict(zip(keys, r)) for r in mine], short.decode()) if with_collapsed else ())))
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string(), *more_kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    keys = ("start", "length", "period")
    names = ["doc_id", "n_words", "n_runs", *keys, "exponent_milli", "runs_sha256", "collapsed_sha256"]
    more, more_kinds = "", []
    if with_collapsed:
        names += ["runs", "collapsed"]
        more = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
        more_kinds = [pa.list_(pa.struct([(k, pa.int64()) for k in keys])), pa.string()]
    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", text_or_empty().cast("binary").alias("_t"))
    return chosen.mapInArrow(batches, f"doc_id {kind}, {COLUMNS}{more}")


def with_repetition(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document with the repetition that the query plants by the CRC-32 of its id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]
