"""Keep-first deduplication that holds when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.phones import clean_phone, digits, phone_ok
from ..functions.text import dedup_key, digest
from .columns import quoted, replace_col


def keep_first(df: DataFrame, key: Column, *order: str | Column) -> DataFrame:
    """The first row of every key.

    ``rank = 1`` over a window is planned with a group limit before the shuffle: each map task
    sends at most one row per key, so a hot key never gathers in one task.
    """
    rank = F.row_number().over(W.partitionBy("_key").orderBy(*order))
    return (
        df.withColumn("_key", key)
        .withColumn("_rank", rank)
        .filter("_rank = 1")
        .drop("_key", "_rank")
    )


def split_first(df: DataFrame, key: Column, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """(first rows, later rows) by key; ``ordinal`` must be unique.

    The later rows have no group limit, so they are not ranked. The smallest ordinal of each key is
    found by a grouped minimum, combined on the map side, and the table is split by joining on the
    ordinal, which cannot be skewed.
    """
    firsts = df.groupBy(key.alias("_key")).agg(F.min(ordinal).alias(ordinal)).select(ordinal)
    same_order = [quoted(c) for c in df.columns]
    return (
        df.join(firsts, ordinal, "left_semi").select(*same_order),
        df.join(firsts, ordinal, "left_anti").select(*same_order),
    )


def dedup_phone(df: DataFrame, phone: str, *order: str) -> DataFrame:
    """Rows with a usable phone, the first per number, with the phone rewritten.

    Unusable phones go before the window, so blanks are never a key.
    """
    usable = replace_col(df, phone, clean_phone(quoted(phone))).filter(phone_ok(quoted(phone)))
    return keep_first(usable, digits(quoted(phone)), *order)


def dedup_text(
    df: DataFrame, column: str, ordinal: str, long_text: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(unique, duplicates) on the cleaned text of a column; long texts are compared by digest."""
    key = dedup_key(quoted(column))
    return split_first(df, digest(key) if long_text else key, ordinal)
