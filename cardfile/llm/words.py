"""Words, lines and small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def windows(tokens: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` tokens; none if there are fewer."""
    return let(
        tokens,
        lambda w: F.when(
            F.size(w) >= k,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
