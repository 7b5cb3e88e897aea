"""URL filter: host and path rules, and exact list membership through a Bloom filter cascade [native].

The cascade encodes a list of keys against the complete universe of keys of the corpus. Level 0 is a Bloom filter of
the listed keys; level 1 one of the unlisted keys that level 0 takes for listed; level 2 one of the listed keys that
level 1 wrongly takes for exceptions; and so on until a level has no false positive. A key of the universe is listed if
and only if the first level that rejects it is odd: exact, and the lookup is an expression over a few bit arrays
instead of a join.

Every level is built by Spark: the bits of its keys, merged into 64-bit words with ``bit_or`` (partial aggregation).
The words reach the lookup as a scalar subquery. Their size is known before they are made: ``BITS_PER_KEY`` bits for
each key of the level. A level beyond ``max_level_bits`` (4 MB) is not gathered; the distinct keys are then looked up
by an equi-join on the word, with the same result.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; its key is the empty
string, which is a member like any other if it is listed; of two fitting rules of one length the one listed first
wins; very long urls are hashed whole; repeated rows are judged alike; empty tables give no rows, an
empty list allows everything; further columns pass through.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.common import ascii_lower, written

HASHES = (6, 4)
BITS_PER_KEY = (10, 6)
MAX_LEVEL_BITS = 1 << 25


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits, else null. ``rules`` is a short
    configured list; of two rules of one length the one listed first wins."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in reversed(longest):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    """The bits of a key in a level of ``bits`` bits; each level hashes anew."""
    low = F.lit((1 << 58) - 1)  # leaves room for the sum below
    first = F.xxhash64(F.lit(2 * level), key).bitwiseAND(low)
    step = F.xxhash64(F.lit(2 * level + 1), key).bitwiseAND(low)
    return [F.pmod(first + F.lit(i).cast("long") * step, F.lit(bits).cast("long"))
            for i in range(HASHES[min(level, 1)])]


class Level:
    """One Bloom filter of the cascade: ``bits`` bits, kept as a written table of 64-bit words."""

    def __init__(self, keys: DataFrame, count: int, number: int, max_bits: int):
        spark = keys.sparkSession
        self.number = number
        self.bits = 64 * max(1, ceil(count * BITS_PER_KEY[min(number, 1)] / 64))
        at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, self.bits))).alias("at"))
        rows = at.select(
            F.shiftright("at", 6).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
            .alias("held"))
        empty = spark.range(self.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("held"))
        self.words = written(rows.unionByName(empty).groupBy("word").agg(F.bit_or("held").alias("held")), "bloom")
        self.array = None
        if self.bits <= max_bits:
            ordered = F.sort_array(F.collect_list(F.struct("word", "held")))
            self.array = written(self.words.agg(F.transform(ordered, lambda w: w["held"]).alias("words")), "bloom")

    def contains(self, key: Column) -> Column:
        """Whether all bits of ``key`` are set, as an expression over the array of words."""
        return reduce(lambda x, y: x & y, [
            F.getbit(F.get(self.array.scalar(), F.shiftright(at, 6).cast("int")),
                     at.bitwiseAND(F.lit(63)).cast("int")) == 1
            for at in _positions(key, self.number, self.bits)])

    def holding(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (distinct ``key``) that the level takes for its own."""
        if self.array is not None:
            return keys.where(self.contains(F.col("key")))
        probes = keys.select("key", F.explode(F.array(*_positions(F.col("key"), self.number, self.bits))).alias("at"))
        hit = (probes.withColumn("word", F.shiftright("at", 6)).join(self.words, "word")
               .groupBy("key").agg(F.min(F.getbit("held", F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("hit")))
        return keys.join(hit.where("hit = 1").select("key"), "key")


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (both with a column ``key``)."""

    def __init__(self, spark: SparkSession, universe: DataFrame, listed: DataFrame,
                 max_level_bits: int = MAX_LEVEL_BITS):
        both = universe.select("key", F.lit(False).alias("listed")).unionByName(
            listed.select("key", F.lit(True).alias("listed")))
        self.keys = written(both.groupBy("key").agg(F.bool_or("listed").alias("listed")), "url-keys")
        self.levels: list[Level] = []
        inside, outside = self.keys.where("listed").select("key"), self.keys.where("not listed").select("key")
        count = inside.count()
        while count:
            level = Level(inside, count, len(self.levels), max_level_bits)
            self.levels.append(level)
            mistaken = written(level.holding(outside), "url-keys")
            inside, outside, count = mistaken, inside, mistaken.count()

    def is_listed(self, key: Column) -> Column:
        """Membership of a key of the universe, as an expression."""
        out = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels) - 1, -1, -1):
            out = F.when(~self.levels[number].contains(key), F.lit(number % 2 == 1)).otherwise(out)
        return out

    def mark(self, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` with a boolean ``listed`` for its column ``key``."""
        if all(level.array is not None for level in self.levels):
            return rows.withColumn("listed", self.is_listed(F.col(key)))
        left, settled = self.keys.select("key"), []
        for number, level in enumerate(self.levels):
            passing = written(level.holding(left), "url-keys")
            settled.append(left.join(passing, "key", "left_anti").select("key", F.lit(number % 2 == 1).alias("listed")))
            left = passing
        settled.append(left.select("key", F.lit(len(self.levels) % 2 == 1).alias("listed")))
        known = reduce(DataFrame.unionByName, settled).withColumnRenamed("key", "_key")
        return rows.join(known, F.col(key) == F.col("_key")).drop("_key")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame,
               max_level_bits: int = MAX_LEVEL_BITS) -> DataFrame:
    """Every row of ``pages`` as ``row`` with ``host``, ``path``, ``rule`` and ``verdict``. Where no rule fits, a page
    is blocked if and only if its key (host and path together) is in ``listed`` (column ``key``)."""
    parts = pages.select(F.struct("*").alias("row"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("key", F.concat("host", "path"))
    marked = Cascade(pages.sparkSession, parts.select("key"), listed, max_level_bits).mark(parts, "key")
    fitted = marked.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    return fitted.select(
        "row", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
