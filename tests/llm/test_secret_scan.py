"""Secret scans: base spans against re, the tests of randomness, and edge cases."""

import base64
import math
import random
import re
import string
import uuid
from collections import Counter

import edge
from pyspark.sql import functions as F

from conftest import SF001, plan_text
from strata.llm import secret_scan
from strata.llm.common import table

ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(a, z, k) for a, _, z, k in sorted(spans)]


def found(docs):
    rows = secret_scan.find_secrets(docs).collect()
    return sorted(((r["doc_id"], [(s["start"], s["end"], s["kind"]) for s in r["spans"]]) for r in rows), key=str)


def without_random(rows):
    return [(d, [s for s in spans if s[2] != "random"]) for d, spans in rows]


NASTY = [
    "secret=token:abcdefgh password: abc token=abcdefgh1 PassWord = 'xY.z=/+-_9'", "api_key: 'k' apikey=\"12345678\"",
    "AKIA AKIAAKIAAKIAAKIA xAKIA1234567890AB AKIAshort AKIA123456789012", "é\U0001f600 secret:" + "0f" * 16 + "g",
    "f" * 31 + "g" + "0" * 32 + "\n" + "a1" * 40, "tokenAPI_KEY==abcdefghij", "passwd :=\x20  \"aaaaaaaa\"",
]


def test_base_spans_equal_re(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents", "doc_id", "text").collect()]
    rows += [(10**6 + i, t) for i, t in enumerate(NASTY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert without_random(found(docs)) == sorted(((d, base(t)) for d, t in rows), key=str)


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    secrets = [base64.b64encode(rng.randbytes(n)).decode() for n in (18, 24, 30, 48) for _ in range(40)]
    secrets += [rng.randbytes(n).hex() for n in (12, 15) for _ in range(40)]
    plain = ["thisIsALongCamelCaseIdentifierNumber1", "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGH", "x" * 30,
             "some_long_snake_case_name_2_with_A_letter", "1234567890" * 4, "ABCABCABCABCABCABCABC222", "aB3" * 12,
             "Donaudampfschifffahrtsgesellschaftskapitaen2B", "0000000000000000000a1b0000000", "internationalisation"]
    rows = [(i, f"the key {s} here") for i, s in enumerate(secrets)]
    rows += [(1000 + i, f"a word {s} here") for i, s in enumerate(plain * 8)]
    got = dict(found(spark.createDataFrame(rows, "doc_id long, text string")))
    hit = sum((8, 8 + len(s), "random") in got[i] for i, s in enumerate(secrets))
    wrong = sum(any(k == "random" for _, _, k in got[1000 + i]) for i in range(len(plain) * 8))
    assert hit >= 0.97 * len(secrets)
    assert wrong <= 8 * 2


def random_tokens(rng):
    """Fifty random strings of each of nine kinds, as they come."""
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    make = {"lower": lambda: pick(low + num, 32), "upper": lambda: pick(up + num, 32), "digits": lambda: pick(num, 32),
            "uuid": lambda: str(uuid.UUID(int=rng.getrandbits(128))), "letters": lambda: pick(low, 40),
            "both cases": lambda: pick(low + up, 32), "hex": lambda: rng.randbytes(13).hex(),
            "base64": lambda: base64.b64encode(rng.randbytes(18)).decode(),
            "base32": lambda: base64.b32encode(rng.randbytes(20)).decode()}
    return [(kind, f()) for kind, f in make.items() for _ in range(50)]


WORDS = """get user account by id from the database wiki portal section page about something read file write index config
value service handler manager report customer order payment method total summary daily monthly update delete create list
item name path image static assets public api client server request response error message format parser builder token
stream window session number internationalisation responsibility""".split()


def plain_tokens(rng, n):
    """Paths, identifiers, slugs and dates of twenty characters and more."""
    word = lambda: rng.choice(WORDS)
    out = []
    while len(out) < n:
        out += [f"{word()}/{word().title()}/{word().title()}{rng.randrange(10)}/{word().title()}-{word().title()}",
                word() + "".join(word().title() for _ in range(5)) + rng.choice(["", str(rng.randrange(100))]),
                "_".join(word() for _ in range(4)) + rng.choice(["", "_v2"]), "-".join(word() for _ in range(5)),
                f"2024/05/{rng.randrange(10, 29)}/" + "-".join(word() for _ in range(4)), "".join(word() for _ in range(4))]
    return [t for t in out if len(t) >= 20 and "token" not in t][:n]


def test_every_kind_of_random_token_and_no_plain_one(spark):
    rng = random.Random(21)
    secrets, plain = random_tokens(rng), plain_tokens(rng, 500)
    rows = [(i, f"the key {t} here") for i, (_, t) in enumerate(secrets)]
    rows += [(1000 + i, f"a word {t} here") for i, t in enumerate(plain)]
    got = dict(found(spark.createDataFrame(rows, "doc_id long, text string")))
    missed = Counter(kind for i, (kind, _) in enumerate(secrets) if not got[i])
    assert all(n <= 2 for n in missed.values()), missed  # at least 0.96 of every kind
    assert sum(bool(got[1000 + i]) for i in range(len(plain))) <= 10


def independent(token):
    """(p, p_plain) of a token, step by step."""
    body = token.rstrip("=")
    body = body.replace("-", "") if re.match(secret_scan.UUID, body) else body
    name, (_, alphabet) = next((n, e) for n, e in secret_scan.ENCODINGS.items() if re.fullmatch(e[0], body))
    body = body.lower() if name in secret_scan.ONE_CASE else body.replace("-", "+").replace("_", "/")
    v, n, size = [alphabet.index(c) for c in body], len(body), len(alphabet)
    classes = 16 if n >= 80 else 8 if n >= 40 else 4
    in_class = Counter(x * classes // size for x in range(size))
    seen = Counter(x * classes // size for x in v)
    chi = sum((seen[b] - n * in_class[b] / size) ** 2 / (n * in_class[b] / size) for b in range(classes))
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    free, spread = classes - 1, 2 / (9 * (classes - 1))
    ps = [tail(((chi / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))]
    high = [2 * x >= size for x in v]
    ones, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    pairs = 2 * ones * (n - ones)
    variance = pairs * (pairs - n) / (n * n * (n - 1))
    ps.append(2 * tail(abs((runs - 1 - pairs / n) / math.sqrt(variance))) if variance > 0 else 0)
    mean = sum(v) / n
    var = sum((x - mean) ** 2 for x in v)
    lag = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:]))
    ps.append(2 * tail(abs((lag / var + 1 / n) * math.sqrt(n))) if var > 0 else 0)
    if name == "digits":
        return min(1, 3 * min(ps)), 0.0
    ratios, mean, spread = secret_scan.plain_model(alphabet)
    path = [secret_scan.class_of(c) for c in body]
    total = sum(ratios[a + b] for a, b in zip(path, path[1:]))
    return min(1, 3 * min(ps)), tail(-(total - (n - 1) * mean) / (spread * math.sqrt(n - 1)))


def test_p_values_and_decisions_equal_an_independent_version(spark):
    rng = random.Random(3)
    tokens = [t for _, t in random_tokens(rng)] + plain_tokens(rng, 120) + ["x" * 30, "ab" * 15, "1234567890" * 4]
    rows = secret_scan.with_p_values(spark.createDataFrame([(t,) for t in tokens], "match string"))
    held = {r["match"]: r for r in rows.collect()}
    for t in tokens:
        p, plain = independent(t)
        assert math.isclose(held[t]["p"], p, rel_tol=0.02, abs_tol=1e-6), t
        assert math.isclose(held[t]["p_plain"], plain, rel_tol=0.02, abs_tol=1e-6), t
    # the step-up procedure on the exact p-values, against that on the grid
    limits = {(r["encoding"], r["band"]): r["first_step"] for r in secret_scan.rejections(rows, "p_plain").collect()}
    groups = {}
    for t in tokens:
        groups.setdefault((held[t]["encoding"], held[t]["band"]), []).append(held[t]["p_plain"])
    for group, ps in groups.items():
        ps.sort()
        rejected = max((i + 1 for i, p in enumerate(ps) if p <= 0.01 * (i + 1) / len(ps)), default=0)
        on_grid = 0 if group not in limits else sum(
            math.floor(-math.log10(max(p, 1e-60)) * secret_scan.GRID) >= limits[group] for p in ps)
        assert abs(on_grid - rejected) <= 1, group  # a step of the grid is two per cent wide


def test_the_plain_model_knows_its_own_spread():
    rng = random.Random(9)
    ratios, mean, spread = secret_scan.plain_model(secret_scan.ENCODINGS["base64"][1])
    sums = []
    for _ in range(3000):
        at, total = "c", 0.0
        for k in range(60):
            step = secret_scan.PLAIN_STEPS[at]
            to = rng.choices(list(step), list(step.values()))[0]
            total += ratios[at + to] if k >= 20 else 0
            at = to
        sums.append(total)
    centre = sum(sums) / len(sums)
    assert abs(centre - 40 * mean) < 0.5
    assert abs(math.sqrt(sum((x - centre) ** 2 for x in sums) / len(sums)) / (spread * math.sqrt(40)) - 1) < 0.06


def test_p_values_of_random_tokens_are_valid(spark):
    """Under the hypothesis, p is at most x with a probability of about x (the chi-squared step is approximate)."""
    rng = random.Random(2)
    rows = [(rng.randbytes(n).hex(),) for n in (16, 20, 32, 64) for _ in range(500)]
    tokens = spark.createDataFrame(rows, "match string")
    tested = secret_scan.with_p_values(tokens)
    share = tested.agg(*[F.avg((F.col("p") <= x).cast("double")) for x in (0.01, 0.05, 0.2)]).first()
    assert share[0] < 0.02 and share[1] < 0.08 and share[2] < 0.25
    z = spark.range(1).select(secret_scan.two_sided(F.lit(1.959964)), secret_scan.upper(F.lit(-1.0))).first()
    assert math.isclose(z[0], 0.05, abs_tol=1e-5) and math.isclose(z[1], 0.841345, abs_tol=1e-5)


def test_edge_cases(spark):
    docs = edge.documents(spark)
    assert without_random(found(docs)) == sorted(((r[0], base(r[1])) for r in edge.rows()), key=str)
    assert secret_scan.find_secrets(edge.none(spark)).count() == 0
    twice = spark.createDataFrame([(1, NASTY[0])] * 3, "doc_id long, text string")
    assert len({str(r) for r in found(twice)}) == 1 and len(found(twice)) == 3


def test_scan_is_native(spark):
    plan = plan_text(secret_scan.find_secrets(table(spark, SF001, "documents", "doc_id", "text")))
    plan += plan_text(secret_scan.scanned(table(spark, SF001, "documents", "doc_id", "text")))
    assert "Python" not in plan and "Arrow" not in plan
