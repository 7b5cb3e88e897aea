"""Scalar Column builders for flags, bands, lookups, scores, blank predicates and rounding.

Semantics that matter (see the README for the full list):

* ``yes_no_to_boolean``: exactly ``Yes`` -> true, exactly ``No`` -> false, anything else (incl. NULL) -> NULL.
* ``band`` / ``threshold_band``: the default label also catches NULL (and NaN for thresholds).
* ``lookup``: no default -> unknown keys map to NULL.
* ``rule_score``: a predicate that evaluates to NULL scores 0.
* ``is_missing``: NULL, or blank after trimming spaces of the value cast to string.
* ``outside_domain``: NULL counts as outside (three-valued logic would otherwise drop it).
* ``is_negative``: NULL and NaN are *not* negative.
* ``round_half_up``: one rounding, HALF_UP, of the double's shortest decimal form;
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes (the profiler's notion of blank), derived from the Unicode database.
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())

_OPS = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no_to_boolean(c: str | Column, yes: str = "Yes", no: str = "No") -> Column:
    c = col_of(c)
    return F.when(c == yes, F.lit(True)).when(c == no, F.lit(False))


def band(c: str | Column, bands, default: str | None) -> Column:
    """Inclusive integer ranges ``[(low, high, label), ...]`` checked in order; ``default`` otherwise."""
    c = col_of(c)
    expr = None
    for low, high, label in bands:
        cond = (c == low) if low == high else c.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is None:
        return expr
    return expr.otherwise(F.lit(default))


def threshold_band(c: str | Column, limits, default: str | None, op: str = "<") -> Column:
    """Ordered thresholds ``[(limit, label), ...]``: first ``c <op> limit`` wins; ``default`` otherwise."""
    c = col_of(c)
    cmp = _OPS[op]
    expr = None
    for limit, label in limits:
        cond = cmp(c, F.lit(limit))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is None:
        return expr
    return expr.otherwise(F.lit(default))


def lookup(c: str | Column, mapping: dict, default=None) -> Column:
    """Small static mapping as a CASE chain (stays in codegen). Unknown keys -> ``default`` (NULL if None).

    For mappings with many entries use a join against a mapping table instead.
    """
    c = col_of(c)
    expr = None
    for key, value in mapping.items():
        cond = c == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def count_equal(columns, value: str = "Yes") -> Column:
    """Row-wise number of ``columns`` exactly equal to ``value`` (never NULL)."""
    terms = [F.when(col_of(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, terms)


def safe_ratio(numerator: str | Column, denominator: str | Column, floor: int = 1) -> Column:
    """``numerator / greatest(denominator, floor)``; ``greatest`` skips NULL, so a NULL denominator divides by floor."""
    return col_of(numerator) / F.greatest(col_of(denominator), F.lit(floor))


def predicate(c: str | Column, op: str, value) -> Column:
    return _OPS[op](col_of(c), F.lit(value))


def rule_score(rules) -> Column:
    """Additive score from ``[(predicate Column, points), ...]`` or ``[(column, op, value, points), ...]``."""
    terms = []
    for rule in rules:
        if len(rule) == 4:
            column, op, value, points = rule
            cond = predicate(column, op, value)
        else:
            cond, points = rule
        terms.append(F.when(cond, F.lit(points)).otherwise(F.lit(0)))
    return reduce(lambda a, b: a + b, terms)


def strip_whitespace(c: str | Column) -> Column:
    """Remove every Unicode whitespace character from both ends (like Python's ``str.strip()``).

    ``btrim`` only walks inward from the two ends, so a long text costs as much as its leading and trailing
    whitespace, not its length.
    """
    return F.btrim(col_of(c).cast("string"), F.lit(WHITESPACE))


def is_blank(c: str | Column, strip_all_whitespace: bool = False) -> Column:
    """Blank after trimming. ``trim`` strips only spaces; with ``strip_all_whitespace`` every Unicode
    whitespace at either end is stripped (the profiler's notion of blank)."""
    s = col_of(c).cast("string")
    if not strip_all_whitespace:
        return F.trim(s) == F.lit("")
    # a text whose first character is no whitespace is not blank: most texts are settled without a copy of them
    first = strip_whitespace(F.substring(s, 1, 1))
    return F.when(first != F.lit(""), F.lit(False)).otherwise(strip_whitespace(s) == F.lit(""))


def is_missing(c: str | Column, trim: bool = True, strip_all_whitespace: bool = False) -> Column:
    """NULL or blank. Without ``trim`` only the empty string counts as blank."""
    c = col_of(c)
    if not trim:
        return c.isNull() | (c.cast("string") == F.lit(""))
    return c.isNull() | is_blank(c, strip_all_whitespace)


def outside_domain(c: str | Column, allowed) -> Column:
    c = col_of(c)
    return ~c.isin(list(allowed)) | c.isNull()


def is_negative(c: str | Column) -> Column:
    return col_of(c) < F.lit(0)


#: how a decimal number is written; exponents of up to 18 digits
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?0*[0-9]{1,18})?$"
_PARTS = r"^[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
_PAST = 5 * 10**18


def decimal_key(text: Column) -> Column:
    """A string that sorts as the decimal number written in ``text`` does, exactly and for any number of digits;
    NULL where it is none. Equal numbers have equal keys however they are written.

    Zero is ``1``. A positive number is ``2``, then where its first digit stands (a fixed number of digits), then its
    digits; a negative one is ``0`` and the same with every digit taken from nine, and an end that sorts after digits.
    """
    t = F.trim(text)
    part = lambda n: F.regexp_extract(t, _PARTS, n)
    digits = F.concat(part(1), part(2))
    cut = F.regexp_replace(digits, "^0+", "")
    first = (F.length(part(1)) - F.length(digits) + F.length(cut)
             + F.coalesce(part(3).try_cast("bigint"), F.lit(0)) + F.lit(_PAST))
    size = F.concat(F.lpad(first.cast("string"), 19, "0"), F.regexp_replace(cut, "0+$", ""))
    key = (F.when(cut == "", F.lit("1")).when(t.startswith("-"), F.concat(F.lit("0"), F.translate(
        size, "0123456789", "9876543210"), F.lit("~"))).otherwise(F.concat(F.lit("2"), size)))
    return F.when(t.rlike(DECIMAL_TEXT), key)


EXACT = "decimal(28,10)"


def sum_parts(c: str | Column) -> dict[str, Column]:
    """Partial aggregates from which the sum and the average of a column follow, in one or in several levels:
    ``exact`` (decimal sum of the values that fit), ``approx`` (double sum of the others), ``odd`` (how many others),
    ``n`` (values)."""
    value = col_of(c)
    exact = value.try_cast(EXACT)
    odd = value.isNotNull() & exact.isNull()
    return {"exact": F.sum(exact), "approx": F.sum(F.when(odd, value.cast("double"))), "odd": F.count_if(odd),
            "n": F.count(value)}


def total_of(exact: Column, approx: Column, odd: Column) -> Column:
    """The exact sum, plus the values that do not fit the decimal (never a sum that leaves them out)."""
    return F.when(odd == 0, exact.cast("double")).otherwise(F.coalesce(exact.cast("double"), F.lit(0.0)) + approx)


def exact_sum(c: str | Column) -> Column:
    """Sum of all values as they are, exact to ten places and independent of the order of the rows."""
    p = sum_parts(c)
    return total_of(p["exact"], p["approx"], p["odd"])


def exact_avg(c: str | Column) -> Column:
    """Exact sum over the number of values; NULL without any."""
    p = sum_parts(c)
    return total_of(p["exact"], p["approx"], p["odd"]) / F.nullif(p["n"], F.lit(0))


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """A double rounded HALF_UP to ``scale`` places, once, from its shortest decimal form; NaN becomes NULL."""
    value = col_of(c).cast("double")
    return F.when(~F.isnan(value), F.round(value, scale))
