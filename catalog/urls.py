"""URL rules on the addresses of the pages."""

from pyspark.sql import functions as F

from cardfile.functions import urls as rules
from cardfile.operators import matching
from cardfile.functions.text import run_timestamp

from .inputs import derived
from .registry import query, table

_HOST = "split_part(url, '/', 3)"
_TAIL = f"substring(url, length(split_part(url, '/', 1)) + length({_HOST}) + 3)"
_RAW = {
    "page_id": "page_id",
    "url": "url",
    "raw": f"""CASE page_id % 6
        WHEN 0 THEN concat('HTTP://', upper({_HOST}), {_TAIL})
        WHEN 1 THEN concat(' ', {_HOST}, {_TAIL}, ' ')
        WHEN 2 THEN concat(split_part(url, '#', 1), CASE WHEN url LIKE '%?%' THEN '' ELSE '?' END)
        WHEN 3 THEN concat(split_part(url, '?', 1), '.PDF')
        WHEN 4 THEN concat('mailto:info@', {_HOST})
        ELSE url END""",
}
_RAW_SQL = "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in _RAW.items()) + " FROM pages)"
# Fixed value: the shape of a usable address as one pattern, and what rules one out.
_VALID = (
    r"^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost"
    r"|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
_NO = r"\.pdf$|\.docx?$|\.xlsx?$|\.jpe?g$|\.png$|\.gif$|\.zip$|\.rar$|mailto:|tel:|javascript:|#"
_SCHEMED = r"CASE WHEN regexp_matches(trim(raw), '^https?://') THEN trim(raw) ELSE 'https://' || trim(raw) END"


@query(
    "valid_urls",
    f"""SELECT page_id, u AS url, regexp_matches(u, '{_VALID}', 'i') AS shaped,
        regexp_matches(u, '{_VALID}', 'i') AND NOT regexp_matches(u, '{_NO}', 'i') AS valid,
        regexp_matches(raw, '{_VALID}', 'i') AS raw_shaped
        FROM (SELECT *, {_SCHEMED} AS u FROM {_RAW_SQL})""",
)
def valid_urls(spark, sf):
    df = derived(table(spark, sf, "pages"), _RAW)
    schemed = rules.ensure_scheme("raw")
    return df.select(
        "page_id",
        schemed.alias("url"),
        rules.is_valid_url(schemed, exclusions=False).alias("shaped"),
        rules.is_valid_url(schemed).alias("valid"),
        rules.is_valid_url("raw", exclusions=False).alias("raw_shaped"),
    )


def norm_sql(u: str) -> str:
    bare = rf"regexp_replace(regexp_replace(ltrim({u}), '#.*', ''), '^([^?]*)\?$', '\1')"
    head = rf"regexp_extract({bare}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?]*)?')"
    return f"(lower({head}) || substring({bare}, length({head}) + 1))"


@query("normalized_urls", f"SELECT page_id, {norm_sql('raw')} AS url FROM {_RAW_SQL}")
def normalized_urls(spark, sf):
    df = derived(table(spark, sf, "pages"), _RAW)
    return df.select("page_id", rules.normalize_url("raw").alias("url"))


def page_sql(n: str) -> str:
    return rf"""CASE WHEN regexp_matches(url, '[?&]page=[^&#]')
        THEN regexp_replace(url, '([?&])page=[^&#]*', '\1page=' || {n})
        WHEN url LIKE '%page%' THEN NULL
        ELSE url || CASE WHEN url LIKE '%/' THEN '' ELSE '/' END || 'page/' || {n} || '/' END"""


@query("next_page_urls", f"SELECT page_id, {page_sql(repr('2'))} AS next_url FROM pages")
def next_page_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", rules.page_url("url", 2).alias("next_url"))


@query(
    "candidate_page_urls",
    f"""SELECT page_id, CAST(n AS INTEGER) AS page, {page_sql('n')} AS url
        FROM (SELECT page_id, url, unnest(range(2, 21)) AS n FROM pages)""",
)
def candidate_page_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.inline(rules.page_urls("url", 20)))


_HREFS = {
    "page_id": "page_id",
    "url": "url",
    "href": """CASE page_id % 5 WHEN 0 THEN '//cdn.example.org/x' WHEN 1 THEN '#top'
        WHEN 2 THEN 'javascript:go()' WHEN 3 THEN 'relative/x' ELSE '/agents/a b?x=1' END""",
}


@query(
    "resolved_hrefs",
    f"""SELECT page_id, CASE WHEN href LIKE '//%' THEN split_part(url, '/', 1) || href
        WHEN href LIKE '/%' THEN split_part(url, '/', 1) || '//' || {_HOST} || href ELSE href END AS resolved,
        NOT (href LIKE '#%' OR href LIKE 'javascript:%') AS followable
        FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _HREFS.items())} FROM pages)""",
)
def resolved_hrefs(spark, sf):
    df = derived(table(spark, sf, "pages"), _HREFS)
    return df.select(
        "page_id",
        rules.resolve("url", "href").alias("resolved"),
        rules.followable("href").alias("followable"),
    )


_CONTACT = {
    "c_custkey": "c_custkey",
    "mail": "CASE WHEN c_custkey % 2 = 0 THEN concat('mailto:x', c_custkey, '@example.com') ELSE concat('mailto:', c_name, 'mailto:') END",
    "tel": "concat('tel:+1 305 ', c_custkey, ' ')",
}


@query(
    "link_prefixes",
    f"""SELECT c_custkey, substring(mail, 8) AS mail, trim(replace(tel, 'tel:', '')) AS tel,
        '2024-01-31 10:20:30' AS run_at
        FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _CONTACT.items())} FROM customer)""",
)
def link_prefixes(spark, sf):
    df = derived(table(spark, sf, "customer"), _CONTACT)
    at = F.lit("2024-01-31 10:20:30").cast("timestamp")
    return df.select(
        "c_custkey",
        rules.strip_mailto("mail").alias("mail"),
        rules.drop_tel("tel").alias("tel"),
        run_timestamp(at).alias("run_at"),
    )


@query(
    "resume_pages",
    """SELECT page_id, url FROM pages WHERE url NOT IN (
        SELECT url FROM pages WHERE contains(html, 'lang="fr"'))""",
)
def resume_pages(spark, sf):
    pages = table(spark, sf, "pages")
    done = pages.filter(F.col("html").contains('lang="fr"')).select(
        F.concat(F.lit("\t"), "url", F.lit(" ")).alias("url")
    )
    return matching.resume(pages.select("page_id", "url"), done, "url")


@query(
    "new_urls",
    f"""SELECT page_id, raw AS url FROM {_RAW_SQL} WHERE {norm_sql('raw')} NOT IN (
        SELECT {norm_sql('url')} FROM pages WHERE contains(html, 'lang="en"'))""",
)
def new_urls(spark, sf):
    pages = table(spark, sf, "pages")
    raw = derived(pages, _RAW).select("page_id", F.col("raw").alias("url"))
    known = pages.filter(F.col("html").contains('lang="en"')).select("url")
    return matching.new_only(raw, known, "url")


@query(
    "known_and_new_urls",
    f"SELECT {norm_sql('url')} AS url FROM pages UNION SELECT {norm_sql('raw')} FROM {_RAW_SQL}",
)
def known_and_new_urls(spark, sf):
    pages = table(spark, sf, "pages")
    known = pages.select(rules.normalize_url("url").alias("url"))
    return matching.union_keys(
        known, derived(pages, _RAW).select(rules.normalize_url("raw").alias("url"))
    )
