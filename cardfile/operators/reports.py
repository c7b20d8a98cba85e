"""Counts about a run. All are grouped sums, combined on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import needs_new_name
from ..functions.phones import clean_phone, digits, phone_ok
from ..functions.predicates import is_complete
from ..functions.text import not_blank
from .columns import quoted
from .ordering import running_total


def phone_report(df: DataFrame, phone: str) -> DataFrame:
    """Valid unique rows, invalid phones and repeats that phone deduplication makes of a table."""
    cleaned = clean_phone(quoted(phone))
    per_number = (
        df.groupBy(F.when(phone_ok(cleaned), digits(cleaned)).alias("_number"))
        .agg(F.count("*").alias("_rows"))
    )
    numbered = F.col("_number").isNotNull()
    return per_number.agg(
        F.count_if(numbered).alias("valid_unique"),
        F.coalesce(F.sum(F.when(~numbered, F.col("_rows"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(numbered, F.col("_rows") - 1)), F.lit(0)).alias("duplicates"),
    )


def name_report(df: DataFrame, business: str, agent: str) -> DataFrame:
    bad = needs_new_name(quoted(business))
    return df.agg(
        F.count("*").alias("processed"),
        F.count_if(bad & not_blank(quoted(agent))).alias("replaced"),
        F.count_if(bad & ~not_blank(quoted(agent))).alias("emptied"),
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows read, kept and removed by a filtering job."""
    sides = before.agg(F.count("*").alias("n"), F.lit(0).alias("k")).unionByName(
        after.agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("k"))
    )
    return sides.agg(F.sum("n").alias("rows"), F.sum("k").alias("kept")).withColumn(
        "removed", F.col("rows") - F.col("kept")
    )


def batch_split_counts(df: DataFrame, batch: str, business: str, phone: str) -> DataFrame:
    """Complete and incomplete rows per batch."""
    full = is_complete(quoted(business), quoted(phone))
    return df.groupBy(batch).agg(
        F.count_if(full).alias("clean"), F.count_if(~full).alias("missing")
    )


def site_page_counts(links: DataFrame, site: str = "site", page: str = "page") -> DataFrame:
    """New links per site and page, per site, and in all; ``level`` is 0, 1 or 3."""
    return links.rollup(site, page).agg(
        F.count("*").alias("links"), F.grouping_id().alias("level")
    )


def site_outcomes(sites: DataFrame, scraped: Column) -> DataFrame:
    """Successful and failed sites."""
    ok = F.coalesce(scraped, F.lit(False))
    return sites.agg(F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"))


def throughput(batches: DataFrame, batch: str = "batch", rows: str = "rows", seconds: str = "seconds") -> DataFrame:
    """Speed of each batch, totals so far, overall speed, rows left and minutes to go."""

    def per_minute(n: Column, secs: Column) -> Column:
        return F.when(secs > 0, n / (secs / 60)).otherwise(F.lit(0.0))

    done = running_total(
        batches,
        batch,
        {"total_rows": rows, "total_seconds": seconds},
        {"_all_rows": rows},
    )
    overall = per_minute(F.col("total_rows"), F.col("total_seconds"))
    left = F.col("_all_rows") - F.col("total_rows")
    return done.select(
        batch,
        rows,
        seconds,
        per_minute(F.col(rows), F.col(seconds)).alias("rows_per_min"),
        "total_rows",
        overall.alias("overall_per_min"),
        left.alias("remaining"),
        F.when(overall > 0, left / overall).alias("eta_minutes"),
    )
