"""The jobs a user runs, put together from the operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import business_or_agent, business_or_realtors
from ..functions.phones import add_plus
from ..functions.predicates import status_is
from ..functions.selectors import Selector
from ..functions.shred import with_nodes
from ..functions.text import not_blank, run_timestamp
from ..functions.urls import (
    ensure_scheme, followable, is_agent_link, is_valid_url, normalize_url, resolve,
)
from ..operators.columns import (
    URL_COLUMNS, coalesce_columns, find_first, find_last_any, quoted, replace_col, require,
)
from ..operators.dedup import dedup_phone, dedup_text
from ..operators.links import dedup_links, link_label, page_links, profile_fields
from ..operators.matching import all_unique, flag_exact, flag_normalized, match_first, new_only, resume
from ..operators.ordering import matched_first
from ..operators.reports import site_page_counts
from ..operators.routing import quarantine
from ..session import key_table, materialize
from ..streaming.incremental import failure_rows, run_available
from ..streaming.seen import FirstRows

BUSINESS_WORDS = ["business", "company"]
AGENT_WORDS = ["agent", "name", "contact"]


def fix_business_names(df: DataFrame) -> DataFrame:
    """Unusable business names replaced by the agent's, long ones shortened."""
    business = find_last_any(df, BUSINESS_WORDS)
    if business is None:
        raise ValueError("no business or company column")
    agent = find_last_any(df, AGENT_WORDS)
    return replace_col(
        df, business, business_or_realtors(quoted(business), quoted(agent) if agent else None)
    )


def clean_leads(
    leads: DataFrame, ordinal: str, business: str = "Business Name", agent: str = "Agent Name",
    text_column: str | None = None,
) -> dict[str, DataFrame]:
    """Clean a lead sheet: ``clean`` names, and ``unique`` / ``duplicates`` on a text column.

    Both branches start from the sheet after the phone step, which is written once. The text
    column is the first one other than the ordinal, unless named.
    """
    require(leads, business, agent)
    named = replace_col(leads, business, business_or_agent(quoted(business), quoted(agent)))
    phones = materialize(dedup_phone(named, find_first(named, "phone"), ordinal), "leads")
    column = text_column or next(c for c in phones.columns if c != ordinal)
    unique, duplicates = dedup_text(phones, column, ordinal)
    return {"clean": fix_business_names(phones), "unique": unique, "duplicates": duplicates}


def unique_email_rows(df: DataFrame, ordinal: str) -> DataFrame:
    return all_unique(df, find_first(df, "email"), ordinal)


def match_deliverable(
    df: DataFrame, statuses: DataFrame, ordinal: str, status: str = "deliverable"
) -> DataFrame:
    """Rows with a deliverable address, reduced to that address."""
    require(statuses, "Validation Status")
    good = statuses.filter(status_is(quoted("Validation Status"), status))
    return match_first(df, good, find_first(df, "email"), find_first(good, "email"), ordinal)


def flag_known_businesses(
    df: DataFrame, known: DataFrame, ordinal: str, exact: bool = True
) -> DataFrame:
    """Flag known names and put them on top: exact names, or the normalised first columns."""
    if exact:
        return matched_first(flag_exact(df, find_first(df, "business"), known), "Matched", ordinal)
    return matched_first(flag_normalized(df, known), "Status", ordinal)


def plus_phones(df: DataFrame) -> DataFrame:
    phone = find_first(df, "phone")
    return replace_col(df, phone, add_plus(quoted(phone)))


def input_urls(df: DataFrame, candidates: list[str] = URL_COLUMNS) -> DataFrame:
    """The address of every row that has one, with a scheme."""
    url = coalesce_columns(df, candidates)
    return df.withColumn("url", url).filter(not_blank("url")).withColumn("url", ensure_scheme("url"))


def extract_profiles(
    queue: DataFrame, pages: DataFrame, done: DataFrame, selectors: dict[str, Selector],
    page_id: str = "page_id",
) -> DataFrame:
    """Profile rows for queued addresses that are not done; without a page, a blank row.

    An address queued twice gives two rows but is parsed once; of several captures of an address
    the one with the smallest ``page_id`` counts. Addresses are made distinct before they meet
    other tables, and pages are picked by their unique number, so an address that fills the queue
    or the captures gathers nowhere.
    """
    urls = input_urls(queue).select("url")
    targets = key_table(resume(urls, done, "url", distinct=True), "url")
    captures = pages.groupBy("url").agg(F.min(page_id).alias(page_id))
    picked = key_table(captures.join(targets, "url", "left_semi"), page_id)
    shredded = with_nodes(pages.join(picked, page_id, "left_semi"))
    rows = failure_rows(targets, profile_fields(shredded, selectors, "url"))
    return urls.join(materialize(rows, "profiles"), "url")


def usable_sites(sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sites with a usable address, now with a scheme; sites with an unusable one and why).

    A table without the column ``website_url`` has no usable rows.
    """
    if "website_url" not in sites.columns:
        sites = sites.withColumn("website_url", F.lit(""))
    named = sites.filter(not_blank("website_url")).withColumn(
        "website_url", ensure_scheme("website_url")
    )
    return quarantine(
        named, is_valid_url("website_url"), F.col("website_url"), "invalid website URL"
    )


def _listed(sites: DataFrame, done: DataFrame, ordinal: str) -> DataFrame:
    """Usable sites that are not done, each with its first place in the list, written."""
    first_seen = usable_sites(sites)[0].groupBy("website_url").agg(F.min(ordinal).alias("site_ord"))
    return materialize(resume(first_seen, done, "website_url"), "sites")


def _agent_links(captured: DataFrame) -> DataFrame:
    """Agent links of captured pages of listed sites (``site_ord``), with their whole addresses."""
    links = page_links(with_nodes(captured), "website_url", "site_ord", "page").filter(
        F.col("rule_rank").isNotNull() & is_agent_link("href", "label") & followable("href")
    )
    return links.withColumn("agent_url", resolve("website_url", "href"))


_LINK_ORDER = ["site_ord", "page", "rule_rank", "position"]


def discover_agents(
    sites: DataFrame, pages: DataFrame, done: DataFrame, known: DataFrame, ordinal: str,
    run_at: Column | None = None, max_pages: int | None = None,
) -> dict[str, DataFrame]:
    """New agent links of all captured pages of the listed sites, and counts per site and page.

    ``sites`` has ``website_url`` and a unique ``ordinal``; ``pages`` has ``website_url``, ``page`` and
    ``html``; ``done`` has ``website_url`` and ``known`` has ``agent_url``. A link counts where it comes
    first by site, page, rule and place. Pages beyond ``max_pages`` are left out if it is given.
    """
    near = pages if max_pages is None else pages.filter(F.col("page") <= max_pages)
    absolute = _agent_links(near.join(_listed(sites, done, ordinal), "website_url"))
    # Both results read the links; pages are shredded once.
    firsts = materialize(dedup_links(new_only(absolute, known, "agent_url"), "agent_url", *_LINK_ORDER), "links")
    out = firsts.select(
        link_label("label").alias("agent_name"),
        "agent_url",
        "website_url",
        F.col("page").alias("page_number"),
        normalize_url("agent_url").alias("normalized_url"),
        run_timestamp(run_at).alias("timestamp"),
    )
    return {"links": out, "counts": site_page_counts(out, "website_url", "page_number")}


_FOUND_LINKS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("agent_name", "agent_url", "website_url")]
    + [T.StructField("page_number", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("normalized_url", "timestamp")]
    + [T.StructField("site_ord", T.LongType())]
    + [T.StructField(n, T.IntegerType()) for n in ("rule_rank", "position")]
)


def _found_links(out: str) -> FirstRows:
    return FirstRows(f"{out}/links", _FOUND_LINKS, "normalized_url", "site_ord", "page_number", "rule_rank", "position")


def discover_incrementally(
    sites: DataFrame, pages: DataFrame, done: DataFrame, known: DataFrame, ordinal: str, out: str, checkpoint: str,
    run_at: Column | None = None,
) -> None:
    """``discover_agents`` over a stream of pages: a run reads the pages that came since the last one and adds its links.

    Links found so far lie in buckets by address. A link that comes first by site, page, rule and place takes the
    place of one that an earlier run has found, so runs over parts of the pages give the links of one run over all
    of them. ``sites`` (with a whole number as ``ordinal``), ``done`` and ``known`` are as in ``discover_agents`` and stay the same
    between runs. Last a batch writes a row to the ledger (``batch_id``, ``links``: different ones on its pages); ``discovered`` reads batches of the ledger only.
    """
    listed = _listed(sites, done, ordinal)
    seen = key_table(known.select(normalize_url("agent_url").alias("normalized_url")), "normalized_url")
    found = _found_links(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        links = _agent_links(batch.join(listed, "website_url")).withColumn("normalized_url", normalize_url("agent_url"))
        firsts = materialize(
            dedup_links(links.join(seen, "normalized_url", "left_anti"), "agent_url", *_LINK_ORDER)
            .withColumn("agent_name", link_label("label"))
            .withColumn("timestamp", run_timestamp(run_at))
            .withColumnRenamed("page", "page_number")
            .select(*_FOUND_LINKS.names),
            "links",
        )
        found.merge(firsts, batch_id)
        count = firsts.agg(F.count("*").alias("links")).coalesce(1)
        count.write.mode("overwrite").parquet(f"{out}/ledger/batch_id={batch_id}")

    run_available(pages, checkpoint, each=write)


def discovered(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Links of all runs of ``discover_incrementally`` so far, and counts per site and page, as in ``discover_agents``."""
    try:
        last = spark.read.parquet(f"{out}/ledger").agg(F.max("batch_id")).first()[0]
    except AnalysisException as gone:
        if "PATH_NOT_FOUND" not in str(gone):
            raise
        last = -1
    links = _found_links(out).read(spark, last + 1).drop("site_ord", "rule_rank", "position")
    return {"links": links, "counts": site_page_counts(links, "website_url", "page_number")}


def failed_sites(
    sites: DataFrame, pages: DataFrame, done: DataFrame, ordinal: str, run_at: Column | None = None
) -> DataFrame:
    """Listed sites without a captured page, as blank link rows, so that they count as done."""
    blank = F.lit("")
    seen = pages.select("website_url").filter("website_url is not null").distinct()
    return _listed(sites, done, ordinal).join(seen, "website_url", "left_anti").select(
        blank.alias("agent_name"),
        blank.alias("agent_url"),
        "website_url",
        F.lit(0).cast(pages.schema["page"].dataType).alias("page_number"),
        blank.alias("normalized_url"),
        run_timestamp(run_at).alias("timestamp"),
    )
