"""Phone rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip, text


def digits(c: Column | str) -> Column:
    """Decimal digits of any script, nothing else."""
    return F.regexp_replace(text(c), r"(?U)\D", "")


def clean_phone(c: Column | str) -> Column:
    """``+`` and digits: ten digits get the country code 1, a leading 00 goes."""
    d = digits(c)
    return (
        F.when(d == "", "")
        .when(F.length(d) == 10, F.concat(F.lit("+1"), d))
        .when(
            (F.length(d) > 11) & d.startswith("00"),
            F.concat(F.lit("+"), F.substr(d, F.lit(3))),
        )
        .otherwise(F.concat(F.lit("+"), d))
    )


def phone_ok(cleaned: Column | str) -> Column:
    return F.length(digits(cleaned)) >= 11


def add_plus(c: Column | str) -> Column:
    """A ``+`` before numbers that start with a digit; null stays null."""
    s = strip(col(c))
    return F.when(s.rlike(r"(?U)^\d"), F.concat(F.lit("+"), s)).otherwise(s)
