"""Token ids of whole texts by a tokenizer file, faster than encoding each text on its own.

A byte-level BPE tokenizer cuts a text at least before every space that stands between two other characters; one that
drops white space cuts at every white space. The ids of a text are therefore the ids of its chunks, one after another.
Texts are cut by Arrow's string functions, the distinct chunks of a batch are looked up once, and the ids of all texts
are gathered from one array. A worker process remembers about ``REMEMBERED`` chunks. New chunks of Latin letters and
signs are cut into words by the tokenizer's pattern, and each new word goes through the tokenizer's BPE model alone;
other chunks, and texts with unusual white space or the string of an added token, are encoded whole. The ids are those
of ``Tokenizer.encode(text, add_special_tokens=False)`` of the file as it is: the string of an added token is that
token, unless ``special_as_text`` is set.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

REMEMBERED = 1_000_000
TOGETHER_CHARS = 1 << 22
#: fixed value: how byte-level pre-tokenization cuts a text
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: a control character that no chunk holds
MARK = "\x1e"
#: ASCII and other white space and separators on which libraries may differ
UNUSUAL = "[" + "".join(map(chr, (
    0x0b, 0x0c, *range(0x1c, 0x20), 0x85, 0xa0, 0x1680, 0x180e, *range(0x2000, 0x2010), *range(0x2028, 0x2030), 0x205f,
    0x2060, 0x3000, 0xfeff))) + "]"
#: white space beside a space: a cut there depends on what follows
BESIDE_SPACE = " [ \n\t\r]|[\n\t\r] "
#: above it, letters and numbers may differ between versions of Unicode; white space at an end meets the next chunk
NOT_SIMPLE = f"[^\x01-{chr(0x24f)}]|^ ?[\n\t\r]|[ \n\t\r]$|^$"


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is a visible Latin-1 one, else
    the next one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Sequences:
    """Integer sequences one after another in one growing array, by number."""

    def __init__(self):
        self.flat, self.starts, self.used, self.count = np.zeros(1024, np.uint32), np.zeros(257, np.int64), 0, 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        ends = self.used + np.cumsum(sizes)
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(sizes) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used:self.used + len(values)] = values
        self.starts[self.count + 1:self.count + 1 + len(sizes)] = ends
        self.used += len(values)
        self.count += len(sizes)

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.starts[numbers + 1] - self.starts[numbers]

    def gather(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The sequences of the given numbers, joined; ``sizes`` are theirs."""
        ends = np.cumsum(sizes)
        shift = self.starts[numbers] - ends + sizes
        return self.flat[np.repeat(shift, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def strings(column: pa.Array) -> list[str]:
    """The values of a column without nulls; much faster than ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


def per_group(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of ``sizes``; ``counts`` are the sizes of the groups."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Encoder:
    """Encodes texts with one tokenizer; use :func:`encoder` to get the one of this process."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.keeps_spaces = pre.get("type") == "ByteLevel"
        if self.keeps_spaces:
            pattern = MARK + "|" + BYTE_LEVEL.replace(r"[^\s", rf"[^{MARK}\s")
        else:
            pattern = " |" + pre["pretokenizers"][0]["pattern"]["Regex"]
        self.between = MARK if self.keeps_spaces else " "
        self.words_of = regex.compile(pattern).findall
        self.normal = self.tokenizer.normalizer
        self.alphabet = byte_alphabet()
        added = [] if special_as_text else [regex.escape(t["content"]) for t in spec.get("added_tokens", ())]
        self.remembered = REMEMBERED
        self.odd = "|".join([UNUSUAL, *[BESIDE_SPACE] * self.keeps_spaces, *added])
        self._forget()

    def rest(self) -> None:
        """Forget all chunks at the end of a task and return the memory: an idle worker process stays beside its executor
        for a minute, through stages that need the memory."""
        self._forget()
        pa.default_memory_pool().release_unused()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.chunk_ids, self.word_ids = Sequences(), Sequences()

    def whole(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _spell(self, words: list[str]) -> list[str]:
        """The words in the alphabet of the vocabulary."""
        text = MARK.join(words).encode().decode("latin-1")
        for c in set(text) - {MARK}:
            if (other := self.alphabet[ord(c)]) != c:
                text = text.replace(c, other)
        return text.split(MARK)

    def _learn_words(self, words: list[str]) -> None:
        ids, sizes = [], []
        for found in map(self.tokenizer.model.tokenize, self._spell(words) if words else ()):
            sizes.append(len(found))
            ids += [t.id for t in found]
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.word_ids.add(np.array(ids, np.uint32), np.array(sizes, np.int64))

    def _learn(self, chunks: list[str]) -> list[str]:
        """Learn new chunks; returns them in the order of their numbers."""
        column = pa.array(chunks, pa.string())
        hard = pc.match_substring_regex(column, NOT_SIMPLE).to_numpy(zero_copy_only=False)
        whole = strings(column.filter(pa.array(hard)))
        for chunk in whole:
            ids = np.frombuffer(self.whole(chunk), "<u4")
            self.known[chunk] = self.chunk_ids.count
            self.chunk_ids.add(ids, np.array([len(ids)], np.int64))
        simple = strings(column.filter(pa.array(~hard)))
        if not simple:
            return whole
        text = self.between.join(simple)
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        words = self.words_of(text)
        self._learn_words(list(set(words).difference(self.words, (self.between,))))
        self.words[self.between] = -1
        numbers = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        del self.words[self.between]
        cuts = np.flatnonzero(numbers < 0)
        if len(cuts) != len(simple) - 1:
            raise ValueError("the words of a text do not fall into its chunks")
        counts = np.diff(np.concatenate(([-1], cuts, [len(numbers)]))) - 1
        numbers = numbers[numbers >= 0]
        sizes = self.word_ids.sizes(numbers)
        first = self.chunk_ids.count
        self.chunk_ids.add(self.word_ids.gather(numbers, sizes), per_group(sizes, counts))
        self.known.update(zip(simple, range(first, first + len(simple))))
        return whole + simple

    def _chunks(self, texts: pa.Array) -> pa.ListArray:
        if self.keeps_spaces:
            return pc.split_pattern(pc.replace_substring(texts, " ", MARK + " "), MARK)
        return pc.ascii_split_whitespace(texts)

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the chunks of all texts, and how many each text has."""
        if self.chunk_ids.count > self.remembered or self.chunk_ids.used > 8 * self.remembered:
            self._forget()
        lists = self._chunks(texts)
        coded = lists.flatten().dictionary_encode()
        distinct = strings(coded.dictionary)
        if new := set(distinct).difference(self.known):
            self._learn(list(new))
        of_distinct = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return of_distinct[coded.indices.to_numpy()], pc.list_value_length(lists).to_numpy().astype(np.int64)

    def _some(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, self.odd)
        numbers, counts = self.numbers(texts.filter(pc.invert(odd)))
        sizes = self.chunk_ids.sizes(numbers)
        ids = self.chunk_ids.gather(numbers, sizes).astype("<u4", copy=False)
        ends = np.cumsum(per_group(sizes, counts)).tolist()
        at = start = 0
        for row, is_odd in enumerate(odd.to_pylist()):
            if is_odd:
                yield self.whole(texts[row].as_py())
            else:
                yield ids[start:ends[at]].tobytes()
                start, at = ends[at], at + 1

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """Ids of each text, in order; a bounded amount of text is in work at a time."""
        for some in pieces_of(texts):
            yield from self._some(some)


def pieces_of(texts: list[str] | pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Consecutive slices of ``texts`` of about ``size`` bytes, or of one text if it is longer."""
    column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string())
    column = column.cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(column).to_numpy().astype(np.int64) + 1)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + (size or TOGETHER_CHARS), "right")))
        yield column.slice(at, end - at)
        at = end


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    if (path, special_as_text) not in _ENCODERS:
        _ENCODERS[path, special_as_text] = Encoder(path, special_as_text)
    return _ENCODERS[path, special_as_text]
