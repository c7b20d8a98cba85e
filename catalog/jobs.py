"""Whole jobs."""

from pyspark.sql import functions as F

from cardfile.operators import links
from cardfile.plans import jobs
from cardfile.session import fresh_path

from .contacts import DEDUP_PHONES_SQL
from .emails import MATCH_SQL, UNIQUE_EMAIL_SQL
from .inputs import LEADS_SQL, invalid_sql, key_sql, leads, realtors_sql, strip_sql
from .pages import LISTED_LINKS, PROFILE_SQL, listing_pages, profile_pages
from .registry import query, table
from .streams import in_batches
from .urls import norm_sql

_NAMED = f"""(SELECT * REPLACE (CASE WHEN {strip_sql('"Agent Name"')} <> '' AND {invalid_sql('"Business Name"')}
    THEN {strip_sql('"Agent Name"')} ELSE "Business Name" END AS "Business Name") FROM {LEADS_SQL})"""
_PHONED = f"({DEDUP_PHONES_SQL.replace(LEADS_SQL, _NAMED)})"
# "Agent Name" comes before "Business Name", so the agent column of the name step is the latter.
_FIXED = realtors_sql('"Business Name"', '"Business Name"')
_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY {key_sql('"Business Name"')} ORDER BY ord) AS rn FROM {_PHONED})"""


def _clean_leads(spark, sf):
    return jobs.clean_leads(leads(spark, sf), "ord", text_column="Business Name")


@query("clean_leads", f'SELECT * REPLACE ({_FIXED} AS "Business Name") FROM {_PHONED}')
def clean_leads(spark, sf):
    return _clean_leads(spark, sf)["clean"]


@query("unique_leads", f"SELECT * EXCLUDE (rn) FROM {_RANKED} WHERE rn = 1")
def unique_leads(spark, sf):
    return _clean_leads(spark, sf)["unique"]


@query("duplicate_leads", f"SELECT * EXCLUDE (rn) FROM {_RANKED} WHERE rn > 1")
def duplicate_leads(spark, sf):
    return _clean_leads(spark, sf)["duplicates"]


_COMPANY = f"""(SELECT ord, "Business Name" AS "Company", "Agent Name" AS "Contact" FROM {LEADS_SQL})"""


@query(
    "fix_business_names",
    f"""SELECT ord, {realtors_sql('"Company"', '"Contact"')} AS "Company", "Contact" FROM {_COMPANY}""",
)
def fix_business_names(spark, sf):
    return jobs.fix_business_names(
        leads(spark, sf).select(
            "ord", F.col("Business Name").alias("Company"), F.col("Agent Name").alias("Contact")
        )
    )


@query("unique_email_rows", UNIQUE_EMAIL_SQL)
def unique_email_rows(spark, sf):
    return jobs.unique_email_rows(leads(spark, sf), "ord")


_DELIVERABLE = "(SELECT concat('AGENT', o_custkey, '@example.com') AS a FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))"


@query("match_deliverable", MATCH_SQL.format(listed=_DELIVERABLE))
def match_deliverable(spark, sf):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    statuses = table(spark, sf, "orders").select(
        F.concat(F.lit("AGENT"), "o_custkey", F.lit("@example.com")).alias("Email address"),
        F.when(urgent, "Deliverable").otherwise("Undeliverable").alias("Validation Status"),
    )
    return jobs.match_deliverable(leads(spark, sf), statuses, "ord")


@query(
    "flag_known_businesses",
    f"""SELECT *, "Business Name" IN (SELECT concat('  ', c_mktsegment, '   Homes  ') FROM customer WHERE c_acctbal < 0)
        AS "Matched" FROM {LEADS_SQL}""",
)
def flag_known_businesses(spark, sf):
    known = table(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.concat(F.lit("  "), "c_mktsegment", F.lit("   Homes  ")).alias("name")
    )
    return jobs.flag_known_businesses(leads(spark, sf), known, "ord")


@query(
    "flag_known_names",
    f"""SELECT "Agent Name", ord, lower(trim("Agent Name")) IN (SELECT lower(c_name) FROM customer WHERE c_acctbal < 0)
        AS "Status" FROM {LEADS_SQL}""",
)
def flag_known_names(spark, sf):
    known = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.upper("c_name").alias("name"))
    return jobs.flag_known_businesses(
        leads(spark, sf).select("Agent Name", "ord"), known, "ord", exact=False
    )


@query(
    "plus_phones",
    f"""SELECT * REPLACE (CASE WHEN regexp_matches({strip_sql('"Phone"')}, '^[0-9]')
        THEN '+' || {strip_sql('"Phone"')} ELSE {strip_sql('"Phone"')} END AS "Phone") FROM {LEADS_SQL}""",
)
def plus_phones(spark, sf):
    return jobs.plus_phones(leads(spark, sf))


@query(
    "extract_profiles",
    f"""WITH q AS (SELECT 'https://agents.example.com/' || o_custkey AS url FROM orders WHERE o_orderpriority <> '5-LOW'),
        d AS (SELECT 'https://agents.example.com/' || o_custkey AS url FROM orders WHERE o_orderstatus = 'P'),
        p AS (SELECT * FROM {PROFILE_SQL} JOIN customer USING (c_custkey) WHERE c_acctbal > 0)
        SELECT q.url, coalesce(business_name, '') AS business_name, coalesce(name, '') AS name,
        coalesce(phone, '') AS phone, coalesce(address, '') AS address, coalesce(website, '') AS website,
        coalesce(email, '') AS email, CASE WHEN p.url IS NULL THEN 'Failed' ELSE 'Completed' END AS status
        FROM q LEFT JOIN p ON p.url = q.url WHERE q.url NOT IN (SELECT url FROM d)""",
)
def extract_profiles(spark, sf):
    orders = table(spark, sf, "orders")
    queue = orders.filter("o_orderpriority <> '5-LOW'").select(
        F.lit("").alias("agent_profiles"),
        F.concat(F.lit(" agents.example.com/"), "o_custkey").alias("website"),
    )
    done = orders.filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("https://agents.example.com/"), "o_custkey").alias("url")
    )
    captured = profile_pages(spark, sf).join(
        table(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey"), "c_custkey", "left_semi"
    )
    return jobs.extract_profiles(queue, captured, done, links.OVERVIEW_PROFILE, "c_custkey")


_SITES = """(SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN concat('https://gone', s_suppkey, '.example.com')
    WHEN s_suppkey % 7 = 0 THEN concat('site', s_suppkey, '.example.com')
    WHEN s_suppkey % 7 = 1 THEN concat('https://site', s_suppkey, '.example.com/brochure.pdf')
    WHEN s_suppkey % 7 = 2 THEN '  '
    ELSE concat('https://site', s_suppkey, '.example.com') END AS website_url FROM supplier)"""
_URL = "(CASE WHEN href LIKE '/%' THEN l.website_url || href ELSE href END)"
_START = f"""WITH s AS (SELECT s_suppkey, website_url FROM (
            SELECT s_suppkey, CASE WHEN website_url LIKE 'site%' THEN 'https://' || website_url ELSE website_url END AS website_url
            FROM {_SITES} WHERE trim(website_url) <> '' AND website_url NOT LIKE '%.pdf')
        WHERE website_url NOT IN (SELECT concat('https://site', s_suppkey, '.example.com') FROM supplier WHERE s_acctbal < 0)),
    l AS (SELECT l.*, s_suppkey, {_URL} AS url, {norm_sql(_URL)} AS norm FROM {LISTED_LINKS} l
        JOIN s ON l.website_url = s.website_url WHERE place IN (1, 2, 3, 6)),
    c AS (SELECT * FROM l WHERE norm NOT IN (
        SELECT concat('https://site', CAST(floor(c_custkey / 15) AS BIGINT), '.example.com/agent/', c_custkey % 40)
            FROM customer WHERE c_mktsegment = 'BUILDING')),
    r0 AS (SELECT DISTINCT s_suppkey FROM l)"""
_FOUND = f"""{_START}, f AS (SELECT * FROM (SELECT c.*, row_number() OVER (
    PARTITION BY norm ORDER BY s_suppkey, page, rule, place) AS rn FROM c) WHERE rn = 1)"""
_AGENTS = f"""{_FOUND} SELECT label AS agent_name, url AS agent_url, website_url, page AS page_number,
    norm AS normalized_url, '2024-01-31 10:20:30' AS timestamp FROM f"""


def _site(key):
    return F.concat(F.lit("https://site"), key, F.lit(".example.com"))


def _sites(spark, sf):
    n = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_nationkey") == 3, F.concat(F.lit("https://gone"), n, F.lit(".example.com")))
        .when(n % 7 == 0, F.concat(F.lit("site"), n, F.lit(".example.com")))
        .when(n % 7 == 1, F.concat(_site(n), F.lit("/brochure.pdf")))
        .when(n % 7 == 2, "  ")
        .otherwise(_site(n))
        .alias("website_url"),
    )


def _done(spark, sf):
    return table(spark, sf, "supplier").filter("s_acctbal < 0").select(
        _site(F.col("s_suppkey")).alias("website_url")
    )


def _run_at():
    return F.lit("2024-01-31 10:20:30").cast("timestamp")


def _known(spark, sf):
    return table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.concat(
            F.lit("https://SITE"), F.floor(F.col("c_custkey") / 15), F.lit(".example.com/agent/"),
            F.col("c_custkey") % 40, F.lit("#known"),
        ).alias("agent_url")
    )


def _discover(spark, sf):
    return jobs.discover_agents(
        _sites(spark, sf),
        listing_pages(spark, sf),
        _done(spark, sf),
        _known(spark, sf),
        "s_suppkey",
        _run_at(),
    )


def _discover_batches(spark, sf):
    """Pages in three batches, later ones with pages that come first; two runs, the second without new pages."""
    out = fresh_path(spark, "discovered")
    stream = in_batches(spark, listing_pages(spark, sf), F.pmod(-F.col("page"), F.lit(3)))
    for _ in range(2):
        jobs.discover_incrementally(
            _sites(spark, sf), stream, _done(spark, sf), _known(spark, sf), "s_suppkey", out, f"{out}-checkpoint", _run_at()
        )
    return jobs.discovered(spark, out)


@query("discover_agents", _AGENTS)
def discover_agents(spark, sf):
    return _discover(spark, sf)["links"]


@query("discover_agents_batches", _AGENTS)
def discover_agents_batches(spark, sf):
    return _discover_batches(spark, sf)["links"]


_COUNTS = f"""{_FOUND} SELECT website_url, page AS page_number, count(*) AS links,
        CAST(grouping(website_url, page) AS BIGINT) AS level FROM f GROUP BY ROLLUP (website_url, page)"""


@query("discovery_counts_batches", _COUNTS)
def discovery_counts_batches(spark, sf):
    return _discover_batches(spark, sf)["counts"]


@query("discovery_counts", _COUNTS)
def discovery_counts(spark, sf):
    return _discover(spark, sf)["counts"]


@query(
    "failed_sites",
    f"""{_START} SELECT '' AS agent_name, '' AS agent_url, website_url, CAST(0 AS BIGINT) AS page_number,
        '' AS normalized_url, '2024-01-31 10:20:30' AS timestamp FROM s WHERE s_suppkey NOT IN (SELECT s_suppkey FROM r0)""",
)
def failed_sites(spark, sf):
    return jobs.failed_sites(
        _sites(spark, sf), listing_pages(spark, sf), _done(spark, sf), "s_suppkey", _run_at()
    )


@query(
    "rejected_sites",
    f"""SELECT s_suppkey, website_url, website_url AS value, 'invalid website URL' AS reason
        FROM {_SITES} WHERE website_url LIKE '%.pdf'""",
)
def rejected_sites(spark, sf):
    return jobs.usable_sites(_sites(spark, sf))[1]
