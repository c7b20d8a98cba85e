"""Finding columns by name or place. All of this happens before any job runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# Fixed value: columns that may hold the address of a profile, in order of preference.
URL_COLUMNS = ["agent_profiles", "url", "URL", "website", "link", "profile"]


def quoted(name: str) -> Column:
    """Column of that exact name; names from real headers hold dots, brackets and spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_first(df: DataFrame, keyword: str) -> str:
    """The first column whose name contains ``keyword`` in any case."""
    for name in df.columns:
        if keyword.lower() in name.lower():
            return name
    raise ValueError(f"no column name contains {keyword!r}: {df.columns}")


def find_last_any(df: DataFrame, keywords: Iterable[str]) -> str | None:
    """The last column whose name contains any keyword, or None.

    "name" is also part of "Business Name", so with the agent column first the search for an agent
    ends at the business column. Results depend on it, so it stays.
    """
    keywords = [k.lower() for k in keywords]
    hits = [name for name in df.columns if any(k in name.lower() for k in keywords)]
    return hits[-1] if hits else None


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def coalesce_columns(df: DataFrame, candidates: Iterable[str] = URL_COLUMNS) -> Column:
    """First non-empty candidate of each row, stripped.

    Emptiness is tested before the strip: a cell of blanks wins and comes out empty. Set
    ``spark.sql.caseSensitive`` when the header has both ``url`` and ``URL``.
    """
    present = [F.nullif(quoted(c), F.lit("")) for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of the columns is present: {list(candidates)}")
    return F.coalesce(strip(F.coalesce(*present)), F.lit(""))


def col_at(df: DataFrame, position: int) -> Column:
    return quoted(df.columns[position])


def replace_col(df: DataFrame, name: str, value: Column) -> DataFrame:
    """New values for one column; all other columns and the order stay."""
    return df.select(
        *[value.alias(c) if c == name else quoted(c).alias(c) for c in df.columns]
    )


def update_cells(df: DataFrame, name: str, rows: Column, value: Column) -> DataFrame:
    """New values for one column on the selected rows only."""
    hit = F.coalesce(rows, F.lit(False))
    return replace_col(df, name, F.when(hit, value).otherwise(quoted(name)))
