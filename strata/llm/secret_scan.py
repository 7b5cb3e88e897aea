"""Secret scans [native]: fixed patterns, and a battery of randomness tests over token-like strings.

Base spans are the matches of the patterns of :data:`PATTERNS`. Beyond them, every run of 20 or more characters of the
Base64 alphabets is a candidate; its encoding is the smallest alphabet that holds all its characters (:data:`ENCODINGS`;
a UUID counts without its dashes). A candidate is reported as ``random`` if two decisions agree:

* It is not found uneven. Under the hypothesis that its symbols are uniform and independent, three tests give a p-value
  each: chi-squared uniformity over classes of the alphabet (more classes for longer tokens), Wald-Wolfowitz runs above
  and below the middle of the alphabet, and lag-one serial correlation. The smallest p-value times three is ``p``.
* It is found not to be plain text. Identifiers, paths and words move between vowels, consonants, capitals, digits and
  signs as :data:`PLAIN_STEPS` says; the log-likelihood ratio of that chain to uniform symbols has a known mean and
  spread under plain text, and ``p_plain`` is the lower tail of it. Digits alone have no plain model: the first decision
  settles them.

Both decisions are made by the Benjamini-Hochberg procedure over the whole corpus, within each encoding and length band
(the tests have more power on longer tokens): at most ``FALSE_DISCOVERIES`` of the tokens called uneven are random, and
as many of those called not plain are plain.

One scan of the texts finds matches and the lengths of the gaps between them; positions are running sums over the
matches of a document. The procedure needs only counts of p-values on a logarithmic grid, so a band that holds a third
of all candidates reaches the shuffle as some hundred counts.

Defined results: a null text is empty; very long texts are scanned whole; spans that begin together stand in the order of
their kinds; p-values on one step of the grid are rejected together; rows with a null doc_id are scanned like any other; repeated rows get the same
result each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from math import log, pi, sqrt

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from strata.llm.common import text_or_empty, written

KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20
#: fixed values. A hex run of 32 or more is a maximal run either way, so its length stands in the pattern, where it
#: keeps ordinary letters from matching one by one; the other kinds are matched first and then held to their length
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{32,}",
    "random": r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN,
}
MIN_VALUE, MIN_ACCESS = 8, 16
FALSE_DISCOVERIES = 0.01
GRID = 100
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: fixed values: encodings by name, the smallest first: which characters, and the alphabet in order of its symbols
ENCODINGS = {
    "digits": ("^[0-9]+$", _DIGITS),
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "letters": ("^([a-z]+|[A-Z]+)$", _LOWER),
    "base32": ("^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    "base36": ("^([0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER),
    "both_cases": ("^[A-Za-z]+$", _UPPER + _LOWER),
    "base64": ("^[A-Za-z0-9+/_-]+$", _UPPER + _LOWER + _DIGITS + "+/"),
}
#: encodings with one case of letters; it is folded
ONE_CASE = ("hex", "letters", "base32", "base36")
UUID = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
#: fixed values: how plain text moves between vowels (v), consonants (c), capitals (U), digits (D) and signs (S)
PLAIN_STEPS = {
    "v": {"v": 0.12, "c": 0.70, "U": 0.05, "D": 0.03, "S": 0.10},
    "c": {"v": 0.50, "c": 0.35, "U": 0.04, "D": 0.03, "S": 0.08},
    "U": {"v": 0.40, "c": 0.35, "U": 0.15, "D": 0.05, "S": 0.05},
    "D": {"v": 0.05, "c": 0.10, "U": 0.10, "D": 0.60, "S": 0.15},
    "S": {"v": 0.15, "c": 0.40, "U": 0.25, "D": 0.15, "S": 0.05},
}


def class_of(symbol: str) -> str:
    if symbol in _DIGITS:
        return "D"
    if symbol in _UPPER:
        return "U"
    return ("v" if symbol in "aeiou" else "c") if symbol in _LOWER else "S"


def plain_model(alphabet: str) -> tuple[dict[str, float], float, float]:
    """For tokens of an alphabet: the log-likelihood ratio of each step between classes, plain text to uniform symbols;
    its mean in plain text; and the standard deviation of the sum of n steps over the root of n. The steps of a chain
    are not independent, so their covariances at all distances count."""
    share = {}
    for symbol in alphabet:
        share[class_of(symbol)] = share.get(class_of(symbol), 0) + 1 / len(alphabet)
    steps = {a: {b: PLAIN_STEPS[a][b] / sum(PLAIN_STEPS[a][x] for x in share) for b in share} for a in share}
    ratios = {a + b: log(steps[a][b] / share[b]) for a in share for b in share}
    stay = dict.fromkeys(share, 1 / len(share))
    for _ in range(200):  # how often plain text is in each class
        stay = {b: sum(stay[a] * steps[a][b] for a in share) for b in share}
    weight = {a + b: stay[a] * steps[a][b] for a in share for b in share}
    mean = sum(weight[k] * ratios[k] for k in ratios)
    variance = sum(weight[k] * (ratios[k] - mean) ** 2 for k in ratios)
    ahead = {a: sum(steps[a][b] * (ratios[a + b] - mean) for b in share) for a in share}
    for _ in range(200):
        variance += 2 * sum(weight[a + b] * (ratios[a + b] - mean) * ahead[b] for a in share for b in share)
        ahead = {a: sum(steps[a][b] * ahead[b] for b in share) for a in share}
    return ratios, mean, sqrt(variance)


def matches(text: Column, kind: str) -> Column:
    """The matches of a pattern in a text: (kind, number, characters since the end of the match before, match)."""
    pattern = PATTERNS[kind]
    found = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    rows = F.transform(found, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("number"), F.length(x["gap"]).alias("gap"), x["match"].alias("match")))
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["match"].isNotNull()))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): one small row per document, the only pass over the texts."""
    texts = docs.select("doc_id", text_or_empty().alias("_t"))
    none = F.array().cast("array<struct<kind:string,number:int,gap:int,match:string>>")
    return texts.select("doc_id", F.xxhash64("_t").alias("text_hash"),
                        F.concat(*[F.coalesce(matches(F.col("_t"), kind), none) for kind in KINDS]).alias("found"))


def placed(scan: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, match) of every match that counts. Repeated rows are taken once."""
    rows = scan.select("doc_id", "text_hash", F.explode("found").alias("m")).select(
        "doc_id", "text_hash", "m.*").distinct()
    upto = W.partitionBy("doc_id", "text_hash", "kind").orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    value = F.regexp_extract("match", PATTERNS["assign"], 2)
    counts = (F.when(F.col("kind") == "assign", F.length(value) >= MIN_VALUE)
              .when(F.col("kind") == "access", F.length("match") >= MIN_ACCESS).otherwise(True))
    return ends.where(counts).select("doc_id", "text_hash", "kind", (F.col("end") - F.length("match")).alias("start"),
                                     "end", "match")


def encoding(body: Column) -> Column:
    """The smallest of :data:`ENCODINGS` that holds all characters of a token."""
    out = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        out = F.when(body.rlike(pattern), name).otherwise(out)
    return out


def by_encoding(values: dict) -> Column:
    """The value of a token's ``encoding``."""
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(F.col("encoding") == name, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def two_sided(z: Column) -> Column:
    """Probability of a standard normal value at least as far from zero; polynomial of Abramowitz and Stegun 7.1.26."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def lower_tail(z: Column) -> Column:
    """Probability of a standard normal value below z, with a small relative error far out too."""
    far = F.exp(-z * z / 2) / (F.abs(z) * F.lit(sqrt(2 * pi))) * (1 - 1 / (z * z) + 3 / (z * z * z * z))
    return F.when(z < -4, far).otherwise(upper(-z))


def upper(z: Column) -> Column:
    return F.when(z >= 0, two_sided(z) / 2).otherwise(1 - two_sided(z) / 2)


def with_p_values(tokens: DataFrame) -> DataFrame:
    """Candidates with their ``encoding``, length ``band``, ``p`` and ``p_plain``."""
    body = F.rtrim(F.col("match"), F.lit("="))
    body = F.when(body.rlike(UUID), F.replace(body, F.lit("-"), F.lit(""))).otherwise(body)
    named = tokens.withColumn("_token", body).withColumn("encoding", encoding(F.col("_token")))
    plain = F.when(F.col("encoding").isin(*ONE_CASE), F.lower("_token")).otherwise(F.translate("_token", "-_", "+/"))
    out = named.withColumns({
        "_body": plain, "_alphabet": by_encoding({n: a for n, (_, a) in ENCODINGS.items()}),
        "_size": by_encoding({n: float(len(a)) for n, (_, a) in ENCODINGS.items()})})
    out = out.withColumn("_v", F.transform(
        F.split("_body", ""), lambda c: (F.call_function("instr", F.col("_alphabet"), c) - 1).cast("double")))
    out = out.withColumns({
        "_n": F.size("_v").cast("double"),
        "_classes": F.when(F.size("_v") >= 80, 16).when(F.size("_v") >= 40, 8).otherwise(4)})
    out = out.withColumns({
        "_counts": F.transform(F.sequence(F.lit(0), F.col("_classes") - 1), lambda b: F.size(F.filter(
            "_v", lambda x: F.floor(x * F.col("_classes") / F.col("_size")) == b)).cast("double")),
        "_high": F.transform("_v", lambda x: x * 2 >= F.col("_size")),
        "_mean": F.aggregate("_v", F.lit(0.0), lambda a, x: a + x) / F.col("_n")})
    total = lambda column, f: F.aggregate(F.transform(column, f), F.lit(0.0), lambda a, x: a + x)
    # classes of an alphabet that they do not divide evenly differ by one symbol
    symbols = lambda b: (F.ceil((b + 1) * F.col("_size") / F.col("_classes"))
                         - F.ceil(b * F.col("_size") / F.col("_classes")))
    expected = lambda b: F.col("_n") * symbols(b) / F.col("_size")
    out = out.withColumns({
        "_chi": total("_counts", lambda c, b: (c - expected(b)) * (c - expected(b)) / expected(b)),
        "_ones": total("_high", lambda h: h.cast("double")),
        "_runs": 1.0 + total("_high", lambda h, i: F.when(
            i > 0, h != F.get("_high", i - 1)).otherwise(False).cast("double")),
        "_var": total("_v", lambda x: (x - F.col("_mean")) * (x - F.col("_mean"))),
        "_lag": total("_v", lambda x, i: F.when(
            i > 0, (x - F.col("_mean")) * (F.get("_v", i - 1) - F.col("_mean"))).otherwise(0.0))})
    free = (F.col("_classes") - 1).cast("double")
    spread = 2.0 / (9.0 * free)
    chi_p = upper((F.pow(F.col("_chi") / free, 1.0 / 3) - (1 - spread)) / F.sqrt(spread))
    n = F.col("_n")
    pairs = 2.0 * F.col("_ones") * (n - F.col("_ones"))
    variance = pairs * (pairs - n) / (n * n * (n - 1))
    runs_p = F.when(variance > 0, two_sided((F.col("_runs") - 1 - pairs / n) / F.sqrt(variance))).otherwise(0.0)
    serial_p = F.when(F.col("_var") > 0, two_sided((F.col("_lag") / F.col("_var") + 1 / n) * F.sqrt(n))).otherwise(0.0)
    out = out.withColumns({"_runs_p": runs_p, "_serial_p": serial_p, "_chi_p": chi_p, "p_plain": plain_p_value()})
    chi_p, runs_p, serial_p = F.col("_chi_p"), F.col("_runs_p"), F.col("_serial_p")
    return out.select(*tokens.columns, "encoding", F.floor(F.log2("_n")).cast("int").alias("band"),
                      F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p)).alias("p"), "p_plain")


def plain_p_value() -> Column:
    """How likely plain text is to move between classes as little like plain text as ``_body`` does; zero for digits."""
    models = {name: plain_model(alphabet) for name, (_, alphabet) in ENCODINGS.items() if name != "digits"}
    every = "".join(ENCODINGS["base64"][1])
    classes = F.split(F.translate("_body", every, "".join(map(class_of, every))), "")
    table = by_encoding({name: F.create_map(*[F.lit(x) for pair in ratios.items() for x in pair])
                         for name, (ratios, _, _) in models.items()})
    ratio = F.aggregate(F.transform(classes, lambda c, i: F.when(
        i > 0, F.element_at(table, F.concat(F.get(classes, i - 1), c))).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
    steps = F.greatest(F.size(classes) - 1, F.lit(1)).cast("double")
    mean = by_encoding({name: mean for name, (_, mean, _) in models.items()})
    spread = by_encoding({name: max(spread, 1e-9) for name, (_, _, spread) in models.items()})
    return F.when(F.col("encoding") == "digits", 0.0).otherwise(lower_tail((ratio - steps * mean) / (spread * F.sqrt(steps))))


def step(p: Column) -> Column:
    """The p-value on the logarithmic grid; higher is smaller."""
    return F.floor(-F.log10(F.greatest(p, F.lit(1e-60))) * GRID).cast("int")


def rejections(tested: DataFrame, p: str, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """(encoding, band, first_step): the hypothesis of column ``p`` is rejected at that step and above, by
    Benjamini-Hochberg. One row for each of at most seven encodings and some thirty bands."""
    counts = tested.groupBy("encoding", "band", step(F.col(p)).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    group = W.partitionBy("encoding", "band")
    at_least = group.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.withColumns({"rank": F.sum("n").over(at_least), "total": F.sum("n").over(group)})
    largest = F.pow(F.lit(10.0), -F.col("step") / GRID)
    return ranked.where(largest <= rate * F.col("rank") / F.col("total")).groupBy("encoding", "band").agg(
        F.min("step").alias("first_step"))


def find_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per row of ``docs``: doc_id and ``spans``, an array of (start, rank, end, kind) by start and kind."""
    scan = written(scanned(docs), "secret-scan")
    spans = written(placed(scan), "secret-spans")
    tested = written(with_p_values(spans.where("kind = 'random'")), "secret-tests")
    limits = rejections(tested, "p", rate).withColumnRenamed("first_step", "uneven")
    plain = rejections(tested, "p_plain", rate).withColumnRenamed("first_step", "strange")
    random = (tested.join(F.broadcast(limits), ["encoding", "band"], "left")
              .join(F.broadcast(plain), ["encoding", "band"])
              .where(F.col("uneven").isNull() | (step(F.col("p")) < F.col("uneven")))
              .where(step(F.col("p_plain")) >= F.col("strange")))
    base = spans.where("kind != 'random'")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    kept = base.unionByName(random.select(*base.columns)).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans"))
    kept = kept.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    joined = scan.join(kept, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>")
    return joined.select("doc_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
