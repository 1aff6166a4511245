"""Safe casts from text.

Two families, because checks and loads disagree on what parses:

* `strict_date` and `rule_number` decide whether a row *passes a rule*;
* `lenient_date`, `load_double` and `load_int` decide what is *stored*.

All of them are Column expressions that return null for a bad value, so they stay
inside generated code and never raise under ANSI mode. Each is one pattern test and
one cast: nested alternatives would be copied into every use and bloat that code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters regarded as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ASCII_SPACE = " \t\n\x0b\x0c\r"

# Accepted spellings. `\z` rather than `$`, which would let a
# trailing line break through.
_DIGITS = r"[0-9]+"
_GROUPED = r"[0-9]+(?:_[0-9]+)*"


def _number(digits: str, *others: str) -> str:
    plain = rf"[+-]?(?:{digits}\.?(?:{digits})?|\.{digits})(?:[eE][+-]?{digits})?"
    return rf"^\s*(?:{'|'.join([plain, *others])})\s*\z"


_INFINITE = r"(?i:[+-]?inf(?:inity)?)"
RULE_NUMBER = _number(_DIGITS, _INFINITE)
LOAD_NUMBER = _number(_GROUPED, _INFINITE, "(?i:nan)")
LOAD_FINITE = _number(_GROUPED)
ISO_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
LOOSE_DATE = (
    r"^\s*([0-9]{1,4})([-/ \\])([0-9]{1,2})\2([0-9]{1,2})"
    r"(?:[ T](?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:\.[0-9]+)?)?"
    r"(?: ?(?:Z|UTC|[+-][0-9]{1,2}(?::?[0-9]{2})?|[A-Za-z_]+/[A-Za-z_]+))?)?\s*\z"
)
# First and last day a 64-bit nanosecond timestamp can hold in full.
RULE_DATE_MIN, RULE_DATE_MAX = "1677-09-22", "2262-04-11"


def clean_text(c: Column) -> Column:
    """Null becomes the empty string; white space is stripped at both ends."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITESPACE))


def strict_date(c: Column) -> Column:
    """`yyyy-m-d` only, without surrounding space, within the rule date range."""
    d = c.try_cast("date")
    first, last = (F.lit(x).cast("date") for x in (RULE_DATE_MIN, RULE_DATE_MAX))
    return F.when(c.rlike(ISO_DATE) & d.between(first, last), d)


def lenient_date(c: Column) -> Column:
    """Date part of what a warehouse load accepts: dash, slash, backslash or space as
    separator, padding, an optional time of day. Short years get leading zeros."""
    iso = F.regexp_replace(c, LOOSE_DATE, "000$1-$3-$4")
    return F.when(c.rlike(ISO_DATE), c.try_cast("date")).when(
        c.rlike(LOOSE_DATE), iso.try_cast("date")
    )


def rule_number(c: Column) -> Column:
    """Number as a rule reads it; a finite spelling that overflows counts as missing."""
    d = c.try_cast("double")
    in_range = (F.abs(d) != F.lit(float("inf"))) | c.rlike("[iI]")
    return F.when(c.rlike(RULE_NUMBER) & in_range, d)


def load_double(c: Column) -> Column:
    """Number as stored: also accepts `1_000`, infinities and not-a-number."""
    return F.when(c.rlike(LOAD_NUMBER), F.replace(c, F.lit("_"), F.lit("")).try_cast("double"))


def load_int(c: Column) -> Column:
    """32-bit integer as stored; fractions round half away from zero."""
    digits = F.btrim(F.replace(c, F.lit("_"), F.lit("")), F.lit(ASCII_SPACE))
    return F.when(
        c.rlike(LOAD_FINITE), F.round(digits.try_cast("decimal(38,18)"), 0).try_cast("int")
    )
