"""Text normalisation as column expressions.

Python's ``str.strip``/``str.split`` treat every Unicode whitespace character as
space, Spark's ``trim`` only the blank. The class below follows Python.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficwatch.config import TRUE_TOKENS

# The characters that Python counts as white space.
_WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
          "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")
_RUN_RE = r"(?U)[\s\x1c-\x1f]+"
# What a decimal number looks like; Java's own cast also takes "10d" or "0x1p3".
_NUMBER_RE = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(_col(c), F.lit(_WHITE))


def blank_to_null(c: Column | str) -> Column:
    """Strip, then turn the empty string into null."""
    return F.nullif(strip(c), F.lit(""))


def parse_bool(c: Column | str) -> Column:
    """Loose boolean: one of the true tokens (any case) is true, any other text
    false, blank null."""
    v = blank_to_null(c)
    return F.when(v.isNotNull(), F.lower(v).isin(*TRUE_TOKENS))


def parse_number(c: Column | str) -> Column:
    """A stripped decimal number as a double; null for any other text."""
    t = _col(c)
    return F.when(t.rlike(_NUMBER_RE), t.try_cast("double"))


def normalize_plate(c: Column | str) -> Column:
    """Upper case, whitespace runs collapsed to one blank, ends stripped."""
    return strip(F.regexp_replace(F.upper(_col(c)), _RUN_RE, " "))


def lookup_key(c: Column | str) -> Column:
    """Strict key normalisation of the command-line lookups: strip and upper only."""
    return F.upper(strip(c))
