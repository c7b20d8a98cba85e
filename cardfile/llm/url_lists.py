"""URL filters with dated lists: each capture is judged by the entries that were active when it was fetched.

List entries are dated. The next entry for the same pattern ends the one before, so entries become intervals of
validity, cut at the starts of months; a month without entries carries on what was valid before, if anything was
captured in it under that pattern. A capture has a few
keys (its address, its host and the host's parent domains) and meets the one interval of each key and month that
holds its time. Of the entries that are found the most specific one decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfile.session import materialize

from .words import let


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def normal_url(url: Column) -> Column:
    """The address without scheme, fragment and trailing slash, its host in small letters, as address entries are written."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    bare = F.regexp_replace(bare, "/+$", "")
    return let(bare, lambda b: F.concat(F.lower(F.regexp_extract(b, "^[^/?]*", 0)), F.regexp_replace(b, "^[^/?]*", "")))


def normal_pattern(pattern: Column) -> Column:
    """A pattern of a list in the form that captures are looked up by: hosts in small letters, addresses normal."""
    name = F.substring(pattern, F.instr(pattern, ":") + 1, F.length(pattern))
    return (
        F.when(pattern.startswith("url:"), F.concat(F.lit("url:"), normal_url(name)))
        .when(pattern.startswith("host:"), F.lower(pattern))
        .otherwise(pattern)
    )


def keys_of(url: Column) -> Column:
    """Patterns that can match the address, most specific first: itself, its host, the parents of the host."""

    def parents(host):
        return let(
            F.split(host, r"\."),
            lambda labels: F.when(
                F.length(host) > 0,
                F.transform(
                    F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
                ),
            ).otherwise(F.array().cast("array<string>")),
        )

    return F.concat(F.array(F.concat(F.lit("url:"), normal_url(url))), let(host_of(url), parents))


def validity(entries: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """``pattern``, ``month``, ``valid_from``, ``valid_to``, ``action``, ``since`` (date of the entry), written.

    ``entries``: ``pattern`` (``host:`` or ``url:`` and the name), ``action``, ``listed_on`` (timestamp). Entries with a
    null pattern or date are ignored; of entries for one pattern and time the last action in alphabetical order counts.
    Months are those with entries and those of ``asked`` (``pattern``, ``month``), however far away these are; what
    was valid before goes on in them. Only what falls into one month of one pattern is ordered together, and months of a
    pattern, one row each.
    """
    clean = entries.where("pattern is not null and listed_on is not null").withColumn("pattern", normal_pattern(F.col("pattern")))
    clean = materialize(clean.groupBy("pattern", "listed_on").agg(F.max("action").alias("action")), "entries")
    month = F.date_trunc("month", F.col("listed_on")).alias("month")
    moment = F.struct(F.col("listed_on").alias("since"), "action")
    months = clean.select("pattern", month, moment.alias("last"))
    if asked is not None:
        wanted = asked.select("pattern", "month").distinct().join(clean.select("pattern").distinct(), "pattern", "left_semi")
        months = months.union(wanted.select("pattern", "month", F.lit(None).cast("struct<since:timestamp,action:string>")))
    months = months.groupBy("pattern", "month").agg(F.max("last").alias("last"))
    before = Window.partitionBy("pattern").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.withColumn("kept", F.last("last", ignorenulls=True).over(before)).where("kept is not null")
    points = carried.select("pattern", "month", F.col("month").alias("valid_from"), "kept.action", "kept.since").union(
        clean.select("pattern", month, "listed_on", "action", "listed_on")
    )
    inside = Window.partitionBy("pattern", "month").orderBy("valid_from", "since")
    to = F.coalesce(F.lead("valid_from").over(inside), F.add_months("month", 1).cast("timestamp"))
    points = points.withColumn("valid_to", to).where("valid_from < valid_to")
    return materialize(points, "validity")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """``captures`` with ``list_action``, ``list_pattern``, ``listed_on`` of the most specific entry valid at the time.

    They are null where no entry was valid, and for a null address or time. An entry is valid from its own moment on.
    Repeated rows are judged alike; an empty table on either side does no harm; columns of these three names are
    replaced, other columns are kept.
    """
    names = ("list_action", "list_pattern", "listed_on")
    plain = captures.drop(*names)
    asked = plain.select(F.col(f"`{url}`").alias("_u"), F.col(f"`{fetched}`").alias("_t"))
    asked = materialize(asked.where("_u is not null and _t is not null").distinct(), "asked")
    keyed = asked.select("_u", "_t", F.date_trunc("month", "_t").alias("month"), F.posexplode(keys_of(F.col("_u"))).alias("place", "pattern"))
    intervals = validity(entries, keyed)
    met = keyed.join(intervals, ["pattern", "month"]).where("_t >= valid_from and _t < valid_to")
    best = met.groupBy("_u", "_t").agg(F.min(F.struct("place", "action", "pattern", "since")).alias("b"))
    found = materialize(
        best.select(
            F.col("_u").alias("_url"), F.col("_t").alias("_time"), F.col("b.action").alias(names[0]),
            F.col("b.pattern").alias(names[1]), F.col("b.since").alias(names[2]),
        ), "verdicts",
    )
    same = (F.col(f"`{url}`") == F.col("_url")) & (F.col(f"`{fetched}`") == F.col("_time"))
    return plain.join(found, same, "left").drop("_url", "_time")


def allowed(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Captures that no active entry blocks, columns as they were."""
    judged = judge(captures, entries, url, fetched)
    return judged.where(F.coalesce(F.col("list_action") != "block", F.lit(True))).select(*[F.col(f"`{c}`") for c in captures.columns])
