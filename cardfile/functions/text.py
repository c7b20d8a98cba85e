"""String rules for names and free text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip and re see it, one by one and as a pattern.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x1c-\x1f]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    An expression used inside a lambda is computed anew for each element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def text(c: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Both ends, any Unicode white space; F.trim only knows U+0020."""
    return F.btrim(col(c), F.lit(SPACES))


def strip_lower(c: Column | str) -> Column:
    return F.lower(strip(c))


def not_blank(c: Column | str) -> Column:
    return strip(text(c)) != ""


def blank_default(c: Column | str, default: str = "") -> Column:
    """``value or default``."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def trim_words(c: Column | str, limit: int = 40) -> Column:
    """At most ``limit`` characters, cut back to the last U+0020 when something was cut off."""
    whole = strip(c)
    cut = strip(F.regexp_replace(F.substring(whole, 1, limit), r" [^ ]*\z", ""))
    return F.when(F.length(whole) <= limit, whole).otherwise(cut)


def dedup_key(c: Column | str) -> Column:
    """Comparison form of a cell: strip, one space per gap, no zero-width characters, lower case.

    Zero-width characters go after the strip, so spaces hidden behind them stay in the key.
    """
    one_space = F.regexp_replace(strip(text(c)), rf"(?U){WS}+", " ")
    return F.lower(F.regexp_replace(one_space, r"[\x{200B}-\x{200D}\x{FEFF}]", ""))


def digest(key: Column) -> Column:
    """A 32-byte stand-in for long keys, so whole documents are not shuffled as grouping keys."""
    return F.unhex(F.sha2(key, 256))


def join_address(lines: Column | str) -> Column:
    return F.array_join(F.slice(col(lines), 1, 2), " ")


def run_timestamp(at: Column | None = None) -> Column:
    """Run time as text; pass a fixed time to make a run repeatable."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd HH:mm:ss")
