"""Business-name rules. The two tests for bad names differ on purpose."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import not_blank, strip, text, trim_words

# Words that mark a scraped name as not a business name.
INVALID_WORDS = ["experience", "business", "undefined", "compass"]
INVALID_PATTERN = r"\byears?\b"
BAD_PHRASES = ["compass", "undefined", "experience"]


def _has_any(lowered: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [lowered.contains(w) for w in words])


def is_invalid_business(name: Column | str) -> Column:
    """Blank, mentions years of experience, or holds one of the invalid words."""
    low = strip(F.lower(text(name)))
    years = low.contains("year") & low.rlike("(?U)" + INVALID_PATTERN)
    return (low == "") | _has_any(low, INVALID_WORDS) | years


def has_bad_phrase(name: Column | str, phrases: list[str] = BAD_PHRASES) -> Column:
    return _has_any(F.lower(text(name)), [p.lower() for p in phrases])


def business_or_agent(business: Column | str, agent: Column | str) -> Column:
    """The agent's name in place of an invalid business name, if there is an agent."""
    return F.when(
        not_blank(agent) & is_invalid_business(business), strip(text(agent))
    ).otherwise(business if isinstance(business, Column) else F.col(business))


def needs_new_name(business: Column | str) -> Column:
    return ~not_blank(business) | has_bad_phrase(business)


def business_or_realtors(
    business: Column | str, agent: Column | str | None, limit: int = 40
) -> Column:
    """``"<agent> Realtors"`` (or blank) for unusable names, otherwise the shortened name."""
    person = strip(text(agent)) if agent is not None else F.lit("")
    stand_in = F.when(person != "", F.concat(person, F.lit(" Realtors"))).otherwise("")
    return F.when(needs_new_name(business), stand_in).otherwise(
        trim_words(text(business), limit)
    )
