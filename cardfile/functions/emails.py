"""Cells that hold several email addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip_lower, text

# Fixed value: what counts as an address in running text.
EMAIL_LOCAL = r"[A-Za-z0-9._%+\-]"
EMAIL_DOMAIN = r"[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"


def split_emails_list(cell: Column | str) -> Column:
    """Split on commas and semicolons; every non-blank part counts."""
    parts = F.transform(F.split(text(cell), "[;,]"), strip_lower)
    return F.filter(parts, lambda e: e != "")


def split_emails_at(cell: Column | str) -> Column:
    """Split on commas, semicolons and spaces; only parts with an ``@`` count."""
    parts = F.filter(F.split(text(cell), "[;, ]+"), lambda e: e.contains("@"))
    return F.transform(parts, strip_lower)


def extract_emails(body: Column | str) -> Column:
    """Addresses in running text.

    A try starts where a run of address characters starts or the last address ended, since a run
    that fails there fails from all its other places; and texts without ``@`` are not tried.
    """
    pattern = rf"(?:\G|(?<!{EMAIL_LOCAL})){EMAIL_LOCAL}++@{EMAIL_DOMAIN}"
    found = F.regexp_extract_all(col(body), F.lit(pattern), F.lit(0))
    return F.when(col(body).contains("@"), found).otherwise(F.array().cast("array<string>"))
