"""One input, several outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_complete
from .columns import quoted


def route(df: DataFrame, tests: dict[str, Column], rest: str | None = None) -> dict[str, DataFrame]:
    """A table per test, and one for the rows that pass none. A null test is a failed test."""
    sure = {name: F.coalesce(test, F.lit(False)) for name, test in tests.items()}
    out = {name: df.filter(test) for name, test in sure.items()}
    if rest:
        none = F.lit(True)
        for test in sure.values():
            none = none & ~test
        out[rest] = df.filter(none)
    return out


def with_route(df: DataFrame, tests: dict[str, Column], rest: str = "rest") -> DataFrame:
    """Name of the first passed test, in a ``route`` column."""
    name = None
    for label, test in tests.items():
        name = F.when(test, label) if name is None else name.when(test, label)
    return df.withColumn("route", name.otherwise(rest))


def write_routed(df: DataFrame, tests: dict[str, Column], path: str, rest: str = "rest", mode: str = "overwrite") -> None:
    """All routes in one pass over the input: one folder per route."""
    with_route(df, tests, rest).write.mode(mode).partitionBy("route").parquet(path)


def split_complete(df: DataFrame, business: str = "business_name", phone: str = "phone") -> dict[str, DataFrame]:
    return route(df, {"clean": is_complete(quoted(business), quoted(phone))}, rest="missing")


def quarantine(df: DataFrame, ok: Column, value: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with value and reason)."""
    sides = route(df, {"ok": ok}, rest="bad")
    return sides["ok"], sides["bad"].withColumn("value", value).withColumn("reason", F.lit(reason))
