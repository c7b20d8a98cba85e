"""Row tests on status and completeness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, text


def status_is(c: Column | str, wanted: str) -> Column:
    """Same word in any case; no trimming, null never matches."""
    return F.coalesce(F.lower(col(c)) == wanted.lower(), F.lit(False))


def pending(c: Column | str, done: str = "Completed") -> Column:
    return ~col(c).eqNullSafe(F.lit(done))


def is_complete(business: Column | str, phone: Column | str) -> Column:
    """Both fields present; a field of blanks counts as present."""
    return (text(business) != "") & (text(phone) != "")


def has_value(c: Column | str) -> Column:
    return col(c).isNotNull()
