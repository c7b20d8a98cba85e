"""Lookups against lists.

Lists become written tables of distinct keys first (``key_table``), so a match never multiplies
rows. No join carries a broadcast hint: Spark broadcasts a list when its files are smaller than
``spark.sql.autoBroadcastJoinThreshold``, and beyond that shuffles both sides and splits hot keys of
the row side at run time (every join here keeps rows of the left side only, the kind that adaptive
execution can split).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.emails import split_emails_at, split_emails_list
from ..functions.text import not_blank, strip, strip_lower
from ..functions.urls import normalize_url
from ..session import key_table
from .columns import col_at, quoted, replace_col


def lookup(spark: SparkSession, values: Sequence[str], name: str = "value") -> DataFrame:
    """An inline list as a table with one column."""
    return spark.createDataFrame([(v,) for v in dict.fromkeys(values)], f"{name} string")


def resume(
    rows: DataFrame, done: DataFrame, key: str, done_key: str | None = None, distinct: bool = False
) -> DataFrame:
    """Rows whose key is not in the finished table; repeated input rows stay unless ``distinct``."""
    stripped = done.select(strip(quoted(done_key or key)).alias(key))
    finished = key_table(stripped.filter(not_blank(quoted(key))), key)
    left = rows.dropDuplicates([key]) if distinct else rows
    return left.join(finished, key, "left_anti").select(*[quoted(c) for c in rows.columns])


def new_only(links: DataFrame, known: DataFrame, url: str, known_url: str | None = None) -> DataFrame:
    """Links whose normalised address is not known yet; both sides are normalised."""
    seen = key_table(known.select(normalize_url(quoted(known_url or url)).alias("_url")), "_url")
    return (
        links.withColumn("_url", normalize_url(quoted(url)))
        .join(seen, "_url", "left_anti")
        .drop("_url")
    )


def union_keys(known: DataFrame, new: DataFrame) -> DataFrame:
    return known.unionByName(new).distinct()


def flag_in(df: DataFrame, column: str, values: Sequence[str], flag: str = "Matched") -> DataFrame:
    """Exact membership in an inline list; null is no member."""
    return df.withColumn(flag, F.coalesce(quoted(column).isin(list(values)), F.lit(False)))


def flag_exact(df: DataFrame, column: str, known: DataFrame, flag: str = "Matched") -> DataFrame:
    """Exact membership in the first column of another table; null is no member."""
    return _flag(df, quoted(column), known.select(col_at(known, 0).alias("_known")), flag, False)


def flag_normalized(
    df: DataFrame, known: DataFrame, flag: str = "Status", nulls_match: bool = True
) -> DataFrame:
    """Do the first columns agree, apart from case and outer white space?

    Null counts as equal to null, unless ``nulls_match`` is off.
    """
    names = known.select(strip_lower(col_at(known, 0)).alias("_known"))
    return _flag(df, strip_lower(col_at(df, 0)), names, flag, nulls_match)


def _flag(df: DataFrame, key: Column, known: DataFrame, flag: str, nulls_match: bool) -> DataFrame:
    rows = df.withColumn("_key", key)
    names = key_table(known, "_known").withColumn("_hit", F.lit(True))
    same = (
        rows["_key"].eqNullSafe(names["_known"]) if nulls_match else rows["_key"] == names["_known"]
    )
    return (
        rows.join(names, same, "left")
        .withColumn(flag, F.coalesce("_hit", F.lit(False)))
        .drop("_key", "_known", "_hit")
    )


def match_first(
    df: DataFrame, emails: DataFrame, column: str, listed: str, ordinal: str
) -> DataFrame:
    """Rows with a listed address; the cell becomes the first listed one of the row.

    ``ordinal`` must be unique: the winning position is found on (ordinal, position) alone and goes
    back to its row by ordinal.
    """
    cells = split_emails_list(quoted(column))
    wanted = key_table(
        emails.select(strip_lower(quoted(listed)).alias("_email")).dropna(), "_email"
    )
    winners = (
        df.select(quoted(ordinal).alias(ordinal), F.posexplode(cells).alias("_pos", "_email"))
        .join(wanted, "_email", "left_semi")
        .groupBy(ordinal)
        .agg(F.min("_pos").alias("_pos"))
    )
    return replace_col(df.join(winners, ordinal), column, F.get(cells, F.col("_pos"))).select(
        *[quoted(c) for c in df.columns]
    )


def email_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of every address over all cells; counted on the map side first."""
    return (
        df.select(F.explode(split_emails_at(quoted(column))).alias("email"))
        .groupBy("email")
        .agg(F.count("*").alias("n"))
    )


def drop_rows_with(df: DataFrame, bad: DataFrame, ordinal: str) -> DataFrame:
    """Rows whose ordinal is not among the bad ones."""
    return df.join(bad.select(ordinal).distinct(), ordinal, "left_anti").select(
        *[quoted(c) for c in df.columns]
    )


def all_unique(df: DataFrame, column: str, ordinal: str) -> DataFrame:
    """Rows all of whose addresses occur once in the whole table; rows without any stay.

    An address that occurs once names its only row, so counting by address (combined on the map
    side) gives each row's number of unrepeated addresses. A row stays when that is all of them.
    Repeated addresses, however frequent, are never joined back to their rows.
    """
    cells = split_emails_at(quoted(column))
    once = (
        df.select(quoted(ordinal).alias(ordinal), F.explode(cells).alias("email"))
        .groupBy("email")
        .agg(F.count("*").alias("n"), F.min(ordinal).alias(ordinal))
        .filter("n = 1")
        .groupBy(ordinal)
        .agg(F.count("*").alias("_once"))
    )
    return (
        df.join(once, ordinal, "left")
        .filter(F.size(cells) == F.coalesce("_once", F.lit(0)))
        .select(*[quoted(c) for c in df.columns])
    )
