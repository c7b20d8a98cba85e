"""Crawl tables: where to stop, what is reachable, and how fast requests came."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..session import bucketed, forget, materialize, option


def crawl_cutoff(
    attempts: DataFrame, site: str, page: str, found: str, attempt: str | None = None, *,
    max_pages: int, max_failures: int = 2,
) -> DataFrame:
    """Attempts a crawl would have made: up to ``max_pages`` per site, ending with the
    ``max_failures``-th failure in a row.

    A page without links is a failure, except page 1; null in ``found`` is an error and always one.
    Later pages and all but the first attempts of a page are cut before the window over the site
    (a page is left after a success, and that many failures end the crawl), so a site brings at
    most ``max_pages * max_failures`` rows, however large it is.
    """
    order = [page, attempt] if attempt else [page]
    near = attempts.filter(F.col(page).between(1, max_pages))
    tries = W.partitionBy(site, page).orderBy(*([attempt] if attempt else [page]))
    near = near.withColumn("_try", F.row_number().over(tries)).filter(
        F.col("_try") <= max_failures
    )
    failed = F.col(found).isNull() | ((F.col(found) == 0) & (F.col(page) > 1))
    by_site = W.partitionBy(site).orderBy(*order)
    last_few = by_site.rowsBetween(-(max_failures - 1), 0)
    end = (F.sum("_failed").over(last_few) == max_failures).cast("int")
    earlier = by_site.rowsBetween(W.unboundedPreceding, -1)
    return (
        near.withColumn("_failed", failed.cast("int"))
        .withColumn("_end", end)
        .withColumn("_ended", F.coalesce(F.max("_end").over(earlier), F.lit(0)))
        .filter("_ended = 0")
        .drop("_try", "_failed", "_end", "_ended")
    )


#: Links of one page that stay together; a page with more has its links in several buckets.
SPLIT = 100_000
#: Rounds whose addresses are tables of their own before they become one.
MERGE = 8


def _next_hop(links: DataFrame, hubs: DataFrame, frontier: DataFrame, visited: list[DataFrame]) -> DataFrame:
    """Addresses that pages of the frontier link to and that were not visited.

    ``links`` is in buckets by page and part, ``visited`` by address, all in as many as the session has shuffle
    partitions: only the frontier and what it reaches are shuffled.
    """
    asked = frontier.join(hubs, "url", "left").select(
        F.col("url").alias("src"), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    )
    reached = links.join(asked, ["src", "part"], "left_semi").select(F.col("dst").alias("url")).distinct()
    for seen in visited:
        reached = reached.join(seen, "url", "left_anti")
    return reached


def crawl_frontier(seeds: DataFrame, links: DataFrame, max_hops: int | None = None) -> DataFrame:
    """Addresses reachable from the seeds, in at most ``max_hops`` links if given, with the fewest hops.

    ``seeds`` has ``url``, ``links`` has ``src`` and ``dst``; repeated and null ones count once and not at all. Different links
    are written once, into sorted buckets, and so is each round; a hop then shuffles its frontier and what that reaches, and
    neither shuffles nor sorts links and visited addresses. Each hop is planned from at most MERGE + 1 tables, however many went before. A
    page with very many links has them in several buckets, and a page linked to very often is one key after the map
    side. The loop ends with the first round that finds nothing new.
    """
    # A bucket is one sorted file; with this option Spark reads it as such.
    with option(links.sparkSession, "spark.sql.legacy.bucketedTableScan.outputOrdering", "true"):
        return _crawled(seeds, links, max_hops)


def _crawled(seeds: DataFrame, links: DataFrame, max_hops: int | None) -> DataFrame:
    spark = links.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = materialize(links.select("src", "dst").dropna().distinct(), "different")
    hubs = links.groupBy(F.col("src").alias("url")).agg(F.ceil(F.count("*") / float(SPLIT)).cast("int").alias("parts"))
    hubs = materialize(hubs.filter("parts > 1"), "hubs")
    parted = links.join(hubs.withColumnRenamed("url", "src"), "src", "left")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    links = bucketed(parted.select("src", part.alias("part"), "dst"), "links", buckets, "src", "part")
    first = seeds.select("url").dropna().distinct().withColumn("hop", F.lit(0))
    visited = [bucketed(first, "frontier", buckets, "url")]
    done = []
    for hop in count(1) if max_hops is None else range(1, max_hops + 1):
        reached = _next_hop(links, hubs, visited[-1].filter(F.col("hop") == hop - 1), [v.select("url") for v in visited])
        frontier = bucketed(reached.withColumn("hop", F.lit(hop)), "frontier", buckets, "url")
        if frontier.isEmpty():
            done.append(frontier)
            break
        visited.append(frontier)
        if len(visited) > MERGE:
            merged = bucketed(_union(visited), "visited", buckets, "url")
            done, visited = done + visited, [merged]
    for table in (links, *done):
        forget(table)
    return _union([forget(v) for v in visited])


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a timestamp column; wall-clock time is read without a time zone."""
    if isinstance(df.schema[ts].dataType, TimestampType):
        return F.unix_micros(ts)
    seconds = F.unix_date(F.to_date(ts)) * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = F.extract(F.lit("SECOND"), F.col(ts)) * 1_000_000
    return seconds.cast("bigint") * 1_000_000 + fraction.cast("bigint")


_SLOTS = 60  # a window is this many slots long
_STRETCH = 3600  # slots that are summed up in one group


def quota_audit(
    events: DataFrame, key: str, ts: str, limit: int = 60, window_s: int = 60
) -> DataFrame:
    """Requests against a quota per trailing window, one row per key and request time.

    ``in_window`` counts requests less than ``window_s`` old, those at the same time left out;
    ``remaining`` is the quota left once the requests of this time are added; ``wait_us`` is how long
    a full quota would have made them wait (until the oldest is out, and a second more).

    Events without a time are one row per key with their number and nulls. Requests of one time are
    counted together first, and time is cut into slots of a 60th of the window. What lies in the slots between comes from sums per slot. Rows meet in one group only
    within a slot, where also the requests of the slot one window earlier leave: at most two rows
    per microsecond of a slot (two million for a window of a minute), however busy the key is.
    """
    span = window_s * 1_000_000
    at = F.col("at")
    # Whole numbers throughout: a request leaves in the slot that is exactly 60 after its own.
    number = f"(at * {_SLOTS} - pmod(at * {_SLOTS}, {span})) div {span}"
    counted = (
        events.select(F.col(key).alias(key), micros(events, ts).alias("at"))
        .filter("at is not null")
        .groupBy(key, "at")
        .agg(F.count("*").alias("requests"))
        .withColumn("slot", F.expr(number))
    )
    none = F.lit(None).cast("bigint")
    comes = F.struct(F.col("slot"), at, F.col("requests"), none.alias("gone"))
    leaves = F.struct(
        (F.col("slot") + _SLOTS).alias("slot"), (at + span).alias("at"), none.alias("requests"),
        F.col("requests").alias("gone"),
    )
    rows = counted.select(key, F.inline(F.array(comes, leaves)))
    slot = W.partitionBy(key, "slot")
    until = slot.orderBy("at").rangeBetween(W.unboundedPreceding, 0)
    before = slot.orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    after = slot.orderBy(at.desc()).rangeBetween(W.unboundedPreceding, -1)
    asked = F.col("requests").isNotNull()
    slots = _slots_before(counted, key).withColumnsRenamed({key: "_key", "slot": "_slot"})
    same = rows[key].eqNullSafe(slots["_key"]) & (rows["slot"] == slots["_slot"])
    swept = (
        rows.join(slots, same)
        .withColumn("_earlier", F.coalesce(F.sum("requests").over(before), F.lit(0)))
        .withColumn("_first", F.min(F.when(asked, at)).over(before))
        .withColumn("_left", F.coalesce(F.sum("gone").over(until), F.lit(0)))
        .withColumn("_next", F.min(F.when(~asked, at)).over(after))
        .filter(asked)
    )
    in_window = F.col("_earlier") + F.col("_between") + F.col("_last_slot") - F.col("_left")
    oldest_leaves = F.coalesce("_next", F.col("_between_first") + span, F.col("_first") + span)
    audited = swept.withColumn("in_window", in_window).select(
        key,
        at.alias("at_us"),
        "requests",
        "in_window",
        F.greatest(F.lit(0), F.lit(limit) - F.col("in_window") - F.col("requests")).alias("remaining"),
        F.when(F.col("in_window") >= limit, oldest_leaves - at + 1_000_000)
        .otherwise(F.lit(0)).alias("wait_us"),
    )
    timeless = events.filter(F.col(ts).isNull()).groupBy(F.col(key).alias(key)).agg(F.count("*").alias("requests"))
    return audited.unionByName(timeless, allowMissingColumns=True)


def _slots_before(counted: DataFrame, key: str) -> DataFrame:
    """Per slot with requests: number and first time of those in the slots between it and the slot
    one window earlier, and number in that slot.

    Slots are summed up in stretches; the last slots of a stretch also go to the next as context.
    """
    per_slot = counted.groupBy(key, "slot").agg(
        F.sum("requests").alias("n"), F.min("at").alias("first")
    )
    home = F.floor(F.col("slot") / _STRETCH).cast("bigint")
    reach = F.floor((F.col("slot") + _SLOTS) / _STRETCH).cast("bigint")
    spread = per_slot.withColumn("home", home).withColumn(
        "stretch", F.explode(F.array_distinct(F.array(home, reach)))
    )
    order = W.partitionBy(key, "stretch").orderBy("slot")
    between, last = order.rangeBetween(-(_SLOTS - 1), -1), order.rangeBetween(-_SLOTS, -_SLOTS)
    return (
        spread.withColumn("_between", F.coalesce(F.sum("n").over(between), F.lit(0)))
        .withColumn("_between_first", F.min("first").over(between))
        .withColumn("_last_slot", F.coalesce(F.sum("n").over(last), F.lit(0)))
        .filter("home = stretch")
        .select(key, "slot", "_between", "_between_first", "_last_slot")
    )
