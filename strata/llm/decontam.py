"""Benchmark decontamination by template windows.

Words become template tokens: numbers (in digits or in words), numbers with a unit, units after a number and names
(capitalised words, also with capitals, apostrophes or hyphens inside) turn into typed placeholders, other words are
stripped of punctuation and lower-cased. A capitalised word that begins a sentence is read
both as a name and as a literal, and each window also without placeholders, for exact copies. Windows of eight template tokens of
the documents are hash-joined with those of the benchmark items. What the placeholders stood for is kept beside each
window; where document and item lie over one another at a fixed distance, every value of the item must stand for one and the
same value of the document; windows with a value that stands for something else, or for no one value, do not count
(:func:`agreeing`). What remains is a leak if it covers half of the item's windows, half of those that can be templates
or six windows (13 words): a copy if all its values are equal, else a re-parameterised question.

The words of the benchmark are few beside the corpus. While they are fewer than ``MAX_WORDS`` they are sent to the
tasks, and a document only emits windows all of whose words the benchmark has. Words that no item has side by side are
left out by a bit array of fixed size, which holds for a benchmark of any size; the result is the same.

Items of fewer than four words between spaces, such as those of writings without spaces, are looked for as whole
sequences of characters (:func:`short_leaks`), if they have at least ``LEAST_CHARS``.

Defined results: null texts have no words; items of fewer than eight words are one window of their length; items of
fewer than four words and ``LEAST_CHARS`` characters are never found (:func:`unmatched_items` counts them); a window with more placeholders than literals is
no template and is found by its literal values only; n_windows counts all windows of an item; where several values
are equally frequent for one of an item, the last in order is taken if it has more than half; very long texts are
searched whole; rows with a null doc_id or item_id take part with a null id; repeated rows give the same pairs once;
empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import ship_code, text_or_empty, words_of, written
from strata.llm.tokens import pieces_of, strings

WINDOW = 8
LEAST_WORDS = 4
LEAST_CHARS = 16
#: characters of short items that one task searches for at a time; more of them are more searches
SHORT_CHARS = 1 << 24
PASSAGE_WINDOWS = 6
MAX_WORDS = 2_000_000
#: binary digits of the size of the filter of neighbouring words
PAIR_BITS = 23
REMEMBERED = 400_000
#: fixed values: units of measurement that become placeholders
UNITS = frozenset("""mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
kilometer kilometers g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ml l liter liters litre
litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year
years mph kmh percent % dollar dollars euro euros cent cents degree degrees""".split())
#: fixed values: numbers in words
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion dozen""".split())
NUMBER, QUANTITY, UNIT, NAME = "<number>", "<quantity>", "<unit>", "<name>"
KINDS = (NUMBER, QUANTITY, UNIT, NAME)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = re.compile(r"^[^\w%]+|[^\w%]+$")
_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*")
_QUANTITY = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*([^\W\d_]+|%)")
_NAME = re.compile(r"[^\W\d_]+(?:['\u2019-][^\W\d_]+)*")
WINDOW_COLUMNS = {"window": "string", "position": "int", "slots": "array<string>", "places": "array<int>",
                  "certain": "array<boolean>", "few": "boolean"}


def is_name(bare: str) -> bool:
    """Whether a word is capitalised and not all in capitals: Tom, McDonald, O'Neil, Jean-Luc."""
    return len(bare) > 1 and bare[0].isupper() and not bare[1:].isupper() and _NAME.fullmatch(bare) is not None


def token_of(word: str) -> tuple[str, bool, bool]:
    """Template token of a word, whether it is a name (if the word before ends a sentence, it may be), whether it ends
    one. A unit is only one if the word before is a number."""
    ends = word[-1] in ".!?:" or word[-1] in "\"')" and any(c in word[-3:] for c in ".!?")
    bare = word if word.isalnum() else _EDGES.sub("", word)
    low = bare.lower()
    if low in NUMBER_WORDS or "-" in low and all(part in NUMBER_WORDS for part in low.split("-")):
        return NUMBER, False, ends
    if not bare.isalpha():
        if _NUMBER.fullmatch(bare):
            return NUMBER, False, ends
        if (m := _QUANTITY.fullmatch(low)) and m[1] in UNITS:
            return QUANTITY, False, ends
    if low in UNITS:
        return UNIT, False, ends
    return low, is_name(bare), ends


def literal_of(word: str) -> str:
    """A word without the signs around it, in lower case."""
    return _EDGES.sub("", word).lower()


def hash_of(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode())


def pair_bits(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of each pair of hashed words."""
    return ((first * np.uint64(0x9E3779B97F4A7C15) + second) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


_TYPED = UNITS | NUMBER_WORDS


class Templates:
    """Template windows of texts; ``known`` are the words that a window may have (None: any), ``beside`` the bits of
    the pairs of words that may stand side by side as literals (None: any)."""

    def __init__(self, known: list[str] | None, sizes: list[int], beside: np.ndarray | None = None):
        self.known, self.sizes, self.beside = known, sizes, beside
        self.seen: dict[str, int] = {}
        self._start(sorted(known or ()))

    def _start(self, words: list[str]) -> None:
        self.words = list(KINDS) + words
        self.numbers = {w: i for i, w in enumerate(self.words)}
        self.hashes = np.zeros(0, np.uint64)

    def _hashes(self) -> np.ndarray:
        """The hash of every word, by number."""
        if len(self.hashes) < len(self.words):
            new = [hash_of(w) for w in self.words[len(self.hashes):]]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes

    def _look(self, word: str) -> int:
        """Number of the word as a literal (-1: not known), three bits for its placeholder (0: none; one more than its
        place in KINDS), and two bits: may be a name, ends a sentence."""
        if word.isalpha() and (plain := word.lower()) not in _TYPED:  # most words, without the patterns
            kind, ends, name = 0, False, word[0] != plain[0] and is_name(word)
        else:
            token, name, ends = token_of(word)
            kind = KINDS.index(token) + 1 if token in KINDS else 0
            plain = literal_of(word) if kind else token
        number = self.numbers.get(plain, -1)
        if number < 0 and self.known is None:
            number = self.numbers[plain] = len(self.words)
            self.words.append(plain)
        return number * 32 + kind * 4 + 2 * name + ends

    def tokens(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The words of a text, the numbers of their literals, the numbers of their placeholders (-1: none), and which
        of these are only one of two readings: capitalised words that begin a sentence."""
        words = _WORD.findall(text)
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
            if self.known is None:
                self._start([])
        seen = self.seen
        for word in set(words).difference(seen):
            seen[word] = self._look(word)
        packed = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        follows = np.ones(len(words), bool)
        follows[1:] = packed[:-1] & 1
        return words, *self._readings(packed, follows)

    def _readings(self, packed: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Literals, placeholders and doubtful words of coded words; ``follows``: begins a text or a sentence."""
        name, kinds = packed & 2 > 0, (packed >> 2 & 7) - 1
        after_number = np.zeros(len(packed), bool)
        after_number[1:] = kinds[:-1] == KINDS.index(NUMBER)
        kinds[(kinds == KINDS.index(UNIT)) & ~(after_number & ~follows)] = -1
        return packed >> 5, np.where(name, KINDS.index(NAME), kinds), name & follows

    def rows_with_windows(self, texts: pa.Array) -> list[int]:
        """The texts of a batch that have any window with known words, found for all of them at once."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
            if self.known is None:
                self._start([])
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        distinct = strings(coded.dictionary)
        seen = self.seen
        new = set(distinct).difference(seen, ("",))
        if self.known is None:
            seen.update(zip(new, map(self._look, new)))
        else:
            number = self.numbers.get
            for word in new:  # most are lower-case letters, perhaps with one sign behind
                last = word[-1]
                bare = word[:-1] if last in ",;.!?:" else word
                if bare.islower() and bare.isalpha() and bare not in _TYPED:
                    seen[word] = number(bare, -1) * 32 + (last in ".!?:")
                else:
                    seen[word] = self._look(word)
        of_distinct = np.array([seen[w] if w else -1 << 40 for w in distinct], np.int64)
        packed = of_distinct[coded.indices.to_numpy()]
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
        there = packed > -1 << 40  # white space at an end of a text leaves an empty word
        packed, text = packed[there], text[there]
        first = np.ones(len(text), bool)
        first[1:] = text[1:] != text[:-1]
        follows = first.copy()
        follows[1:] |= packed[:-1] & 1 > 0
        plain, kinds, either = self._readings(packed, follows)
        rows = np.zeros(len(texts), bool)
        for size, starts, *_ in self._starts(plain, kinds, either):
            rows[text[starts[text[starts] == text[starts + size - 1]]]] = True
        return np.flatnonzero(rows).tolist()

    def _starts(self, plain: np.ndarray, kinds: np.ndarray, either: np.ndarray) -> Iterator[tuple]:
        """For each size of windows: where they start, and for all places whether the window is one of literals, whether
        it is a template, and whether it can be one."""
        total = lambda some: np.concatenate(([0], np.cumsum(some)))
        fixed = (kinds >= 0) & ~either
        unknown, bad = total(plain < 0), total((plain < 0) & (kinds < 0))
        least, sure = total(fixed | either & (plain < 0)), total(fixed)
        strange = np.zeros(len(plain), bool)  # two literals in every reading that no item has side by side
        if self.beside is not None and len(plain) > 1:
            always = (kinds < 0) & (plain >= 0)
            both = np.flatnonzero(always[:-1] & always[1:])
            hashes = self._hashes()
            strange[both] = ~self.beside[pair_bits(hashes[plain[both]], hashes[plain[both + 1]])]
        strange = total(strange)
        for size in self.sizes:
            if len(plain) < size:
                continue
            over = lambda some: some[size:] - some[:-size]
            fits = strange[size - 1:-1] - strange[:-size] == 0
            literal, few = (over(unknown) == 0) & fits, 2 * over(sure) <= size
            template = (over(bad) == 0) & (2 * over(least) <= size) & fits
            yield size, np.flatnonzero(literal | template), literal, template, few

    def windows(self, text: str) -> Iterator[tuple[str, int, list[str], list[int], list[bool], bool]]:
        """(window, position, values of the placeholders, their places in the text, whether they are placeholders in
        every reading, whether it can be a template) of every reading of the windows with known words. A capitalised word that begins a sentence is read as a literal and
        as a name; a template has no more placeholders than literals. Each window is also read without placeholders; its
        values are then those that are placeholders in every template."""
        words, plain, kinds, either = self.tokens(text)
        if not words:
            return
        fixed = ((kinds >= 0) & ~either).tolist()
        found = [(size, starts.tolist(), *rest) for size, starts, *rest in self._starts(plain, kinds, either)]
        plain, kinds, either = plain.tolist(), kinds.tolist(), either.tolist()
        for size, starts, literal, template, few in found:
            for at in starts:
                span = range(at, at + size)
                always = [i for i in span if fixed[i]]
                if literal[at]:
                    yield self._window(words, plain, kinds, either, span, (), always, bool(few[at]))
                if not template[at]:
                    continue
                forced = [i for i in span if either[i] and plain[i] < 0]
                free = [i for i in span if either[i] and plain[i] >= 0]
                for n in range(min(len(free), size // 2 - len(always) - len(forced)) + 1):
                    for some in combinations(free, n):
                        if typed := sorted([*always, *forced, *some]):
                            yield self._window(words, plain, kinds, either, span, typed, typed, True)
                        elif not literal[at]:
                            yield self._window(words, plain, kinds, either, span, (), (), True)

    def _window(self, words: list[str], plain: list[int], kinds: list[int], either: list[bool], span: range,
                typed: Sequence[int], places: Sequence[int], few: bool
                ) -> tuple[str, int, list[str], list[int], list[bool], bool]:
        key = " ".join([self.words[kinds[i] if i in typed else plain[i]] for i in span])
        values = [self.words[plain[i]] if plain[i] >= 0 else literal_of(words[i]) for i in places]
        return key, span[0], values, list(places), [not either[i] for i in places], few


def agreeing(windows: list[dict]) -> list[dict]:
    """Those of the windows of one item over one document, at one distance, whose values go together. A value of the
    item stands for the value that it has in more than half of its places; where no value has, no window with it is
    left. Places that need not be names count only if the value has no others, and the most frequent value is then
    taken: the other windows are just read differently."""
    places: dict[str, dict[str, dict[int, bool]]] = {}
    covered = Counter()
    for w in windows:
        for place, own, other, certain in w["slots"]:
            at = places.setdefault(own, {}).setdefault(other, {})
            at[place] = at.get(place, False) or certain
            covered[own, other] += 1
    stands_for = {}
    for own, others in places.items():
        sure = {other: sum(at.values()) for other, at in others.items()}
        best = max(others, key=lambda o: (sure[o], len(others[o]), covered[own, o], o))
        if not any(sure.values()) or 2 * sure[best] > sum(sure.values()):
            stands_for[own] = best
    return [w for w in windows if all(stands_for.get(own) == other for _, own, other, _ in w["slots"])]


def settled(lain: DataFrame) -> DataFrame:
    """``lain`` with the item's positions whose windows agree, those of them that can be templates, and whether all
    values are equal, in place of ``windows``; rows without any are gone."""
    keys = [c for c in lain.columns if c != "windows"]
    extra = {"positions": pa.list_(pa.int32()), "few": pa.list_(pa.int32()), "equal": pa.bool_()}

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows, out = [], []
            for row, cell in enumerate(batch.column("windows")):
                windows = cell.as_py()
                for w in windows:
                    w["slots"] = [(s["places"], s["item_slots"], s["slots"], s["certain"]) for s in w["pairs"]]
                if kept := agreeing(windows):
                    rows.append(row)
                    out.append((sorted({w["item_position"] for w in kept}),
                                sorted({w["item_position"] for w in kept if w["few"]}),
                                all(own == other for w in kept for _, own, other, _ in w["slots"])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(pa.array(rows)) for k in keys]
                    + [pa.array(x, t) for x, t in zip(zip(*out), extra.values())], keys + list(extra))

    schema = lain.select(*keys, F.lit(None).cast("array<int>").alias("positions"),
                         F.lit(None).cast("array<int>").alias("few"), F.lit(None).cast("boolean").alias("equal")).schema
    return lain.mapInArrow(batches, schema)


def neighbours(items: DataFrame) -> np.ndarray:
    """The bits of all words that stand side by side in an item, as literals: ``1 << PAIR_BITS`` truth values."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [np.zeros(0, np.int64)]
            for text in batch.column("_t").to_pylist():
                hashes = np.array([hash_of(literal_of(w)) for w in _WORD.findall(text)], np.uint64)
                found.append(pair_bits(hashes[:-1], hashes[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["bit"])

    ship_code(items.sparkSession)
    out = np.zeros(1 << PAIR_BITS, bool)
    out[[r["bit"] for r in items.select("_t").mapInArrow(batches, "bit long").distinct().collect()]] = True
    return out


def emit(texts: DataFrame, keys: list[str], known: list[str] | None, sizes: list[int],
         beside: np.ndarray | None = None) -> DataFrame:
    """The windows of ``texts`` (keys and ``_t``), with the keys of their row."""
    schema = texts.select(*keys, *[F.lit(None).cast(kind).alias(name) for name, kind in WINDOW_COLUMNS.items()]).schema
    shared = texts.sparkSession.sparkContext.broadcast((known, beside))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(shared.value[0], sizes, shared.value[1])
        for batch in source:
            rows, found, first = [], [], 0
            for texts in pieces_of(batch.column("_t")):
                for row in templates.rows_with_windows(texts):
                    for window in templates.windows(texts[row].as_py()):
                        rows.append(first + row)
                        found.append(window)
                        if len(rows) == 16384:
                            yield made(batch, rows, found)
                            rows, found = [], []
                first += len(texts)
            if rows:
                yield made(batch, rows, found)
            pa.default_memory_pool().release_unused()  # an idle worker process stays beside its executor

    def made(batch: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
        at = pa.array(rows)
        kinds = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [batch.column(k).take(at) for k in keys] + [pa.array(x, t) for x, t in zip(zip(*found), kinds)],
            keys + list(WINDOW_COLUMNS))

    ship_code(texts.sparkSession)
    return texts.select(*keys, "_t").mapInArrow(batches, schema)


def benchmark_words(items: DataFrame, limit: int = MAX_WORDS) -> list[str] | None:
    """The words of all items as literals; None if there are more than ``limit``."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            words = {literal_of(w) for text in batch.column("_t").to_pylist() for w in _WORD.findall(text)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.string())], ["word"])

    ship_code(items.sparkSession)
    found = items.select("_t").mapInArrow(batches, "word string").distinct().limit(limit + 1).collect()
    return None if len(found) > limit else [r["word"] for r in found]


def leaks(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, matched, kind) of every leak of an item of ``benchmark`` (item_id, text)
    in ``docs`` (doc_id, text)."""
    items = benchmark.select("item_id", text_or_empty().alias("_t")).distinct().withColumn("item_hash", F.xxhash64("_t"))
    items = written(items.withColumn("words", F.size(words_of(F.col("_t")))), "items")
    brief = short_leaks(docs, items.where(F.col("words").between(1, LEAST_WORDS - 1)))
    items = items.where(F.col("words") >= LEAST_WORDS)
    short = [r["words"] for r in items.where(F.col("words") < WINDOW).select("words").distinct().collect()]
    known = benchmark_words(items, max_words)
    item_keys = ["item_id", "item_hash", "words"]
    own = emit(items, item_keys, known, sorted({*short, WINDOW}))
    own = own.where(F.size(F.split("window", " ")) == F.least("words", F.lit(WINDOW)))
    own = written(own.withColumnsRenamed({"position": "item_position", "slots": "item_slots", "certain": "item_certain"}), "item-windows")
    totals = own.groupBy("item_id", "item_hash").agg(
        F.count_distinct("item_position").alias("n_windows"),
        F.count_distinct(F.when(F.col("few"), F.col("item_position"))).alias("n_few"))
    texts = docs.select("doc_id", text_or_empty().alias("_t")).withColumn("text_hash", F.xxhash64("_t"))
    theirs = emit(texts, ["doc_id", "text_hash"], known, sorted({*short, WINDOW}), neighbours(items)).drop("places", "few")
    found = theirs.join(own, "window")
    typed = F.col("window").rlike(f"(^| )({'|'.join(KINDS)})( |$)")
    either = lambda theirs, own: F.when(typed, F.col(theirs)).otherwise(F.col(own))
    certain = F.zip_with(either("certain", "item_certain"), "item_certain", lambda a, b: a & b)
    pairs = F.arrays_zip("places", "item_slots", either("slots", "item_slots").alias("slots"), certain.alias("certain"))
    lain = found.groupBy("doc_id", "text_hash", "item_id", "item_hash",
                         (F.col("position") - F.col("item_position")).alias("distance")).agg(
        F.collect_set(F.struct("item_position", "few", pairs.alias("pairs"))).alias("windows"))
    different = lambda name: F.size(F.array_distinct(F.flatten(F.collect_set(name))))
    per_item = settled(lain).groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(
        different("positions").alias("matched"), different("few").alias("matched_few"), F.bool_and("equal").alias("copy"))
    totals = totals.withColumnsRenamed({"item_id": "t_item", "item_hash": "t_hash"})
    judged = per_item.join(totals, F.col("item_id").eqNullSafe(F.col("t_item")) & (F.col("item_hash") == F.col("t_hash")))
    leaked = ((2 * F.col("matched") >= F.col("n_windows")) | (F.col("matched") >= PASSAGE_WINDOWS)
              | (F.col("n_few") > 0) & (2 * F.col("matched_few") >= F.col("n_few")))
    found = judged.where(leaked).select(
        "doc_id", "text_hash", "item_id", "n_windows", F.col("matched").cast("long").alias("matched"),
        F.when(F.col("copy"), "copy").otherwise("re-parameterised").alias("kind"))
    return found if brief is None else found.unionByName(brief)


def plain_sequence(text: Column) -> Column:
    """A text in lower case, with one space for every run of white space and none at its ends."""
    return F.concat_ws(" ", words_of(F.lower(text)))


def short_leaks(docs: DataFrame, items: DataFrame, chars: int = SHORT_CHARS) -> DataFrame | None:
    """The leaks of items (item_id, _t) of few words but ``LEAST_CHARS`` characters, found as whole sequences of
    characters by an automaton of all of them; None if there are none. Automata hold about ``chars`` characters: more
    items are split by hash and the documents searched once for each part."""
    items = items.select("item_id", plain_sequence(F.col("_t")).alias("key")).where(F.length("key") >= LEAST_CHARS).distinct()
    total = items.agg(F.sum(F.length("key"))).first()[0]
    if not total:
        return None
    parts, out = -(-total // chars), None
    texts = docs.select("doc_id", text_or_empty().alias("_t")).withColumn("text_hash", F.xxhash64("_t"))
    texts = texts.withColumn("_t", plain_sequence(F.col("_t")))
    keys = items.select("key").distinct()
    for part in range(parts):
        words = [r["key"] for r in keys.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()]
        some = holding(texts, words).join(items, "key").select(
            "doc_id", "text_hash", "item_id", F.lit(1).cast("long").alias("n_windows"),
            F.lit(1).cast("long").alias("matched"), F.lit("copy").alias("kind")).distinct()
        out = some if out is None else out.unionByName(some)
    return out


def holding(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, text_hash, key) for every one of ``keys`` that a text of ``texts`` (with ``_t``) holds."""
    schema = texts.select("doc_id", "text_hash", F.lit("").alias("key")).schema
    shared = texts.sparkSession.sparkContext.broadcast(keys)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        if not shared.value:
            return
        machine = ahocorasick.Automaton()
        for key in shared.value:
            machine.add_word(key, key)
        machine.make_automaton()
        for batch in source:
            rows, found = [], []
            for row, text in enumerate(batch.column("_t").to_pylist()):
                for key in {key for _, key in machine.iter(text)}:
                    rows.append(row)
                    found.append(key)
            if rows:
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(found, pa.string())],
                    ["doc_id", "text_hash", "key"])

    ship_code(texts.sparkSession)
    return texts.mapInArrow(batches, schema)


def unmatched_items(benchmark: DataFrame) -> int:
    """How many items of ``benchmark`` have words but too few of them to be looked for."""
    texts = benchmark.select("item_id", text_or_empty().alias("_t")).distinct()
    return texts.where(F.size(words_of(F.col("_t"))).between(1, LEAST_WORDS - 1)
                       & (F.length(plain_sequence(F.col("_t"))) < LEAST_CHARS)).count()


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no leak, with exactly the columns of ``docs``."""
    gone = written(leaks(docs, benchmark).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text_or_empty()).alias("text_hash"))
    clean = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("_doc"))
                      & (F.col("text_hash") == F.col("_hash")), "left_anti")
    return clean.select("row.*")
