"""Links, texts and fields out of HTML."""

from pyspark.sql import functions as F

from cardfile.functions import selectors as sel
from cardfile.functions.shred import explode_nodes, with_nodes
from cardfile.functions.urls import followable, is_agent_link, page_link_hrefs, resolve
from cardfile.operators import links, reports
from cardfile.sources.tables import scan_pages

from .inputs import made_pages
from .registry import query, table


def decode_sql(x: str) -> str:
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"regexp_replace({x}, '{entity}?', '{char}', 'g')"
    return x


_BLOCKS = "p|div|h[1-6]|ul|ol|li|nav|article|footer|header|table|tr|td|th"


def shown_sql(x: str) -> str:
    """Markup to shown text: blocks and br start lines, other tags go."""
    x = rf"regexp_replace({x}, '<!--.*?-->', '', 'gs')"
    x = rf"regexp_replace({x}, '[ \t\r\n\f]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '</?(?:{_BLOCKS}|br)(?: [^>]*)?>', chr(10), 'g')"
    x = decode_sql(f"regexp_replace({x}, '<[^>]+>', '', 'g')")
    x = rf"regexp_replace({x}, ' *\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace(regexp_replace({x}, ' +', ' ', 'g'), '^\s+|\s+$', '', 'g')"


def _pages(spark, sf):
    return scan_pages(spark, f"{sf}/pages.parquet")


_A = r'<a\b[^>]*?href="([^"]*)"'


@query(
    "page_hrefs",
    f"""SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href
        FROM (SELECT page_id, regexp_extract_all(html, '{_A}', 1) AS h FROM pages)""",
)
def page_hrefs(spark, sf):
    return _pages(spark, sf).select(
        "page_id", F.posexplode(page_link_hrefs("html")).alias("pos", "href")
    )


@query(
    "page_links",
    f"""SELECT page_id, href, {shown_sql('label')} AS label, NULL::INTEGER AS rule_rank, count(*) AS n FROM (
        SELECT page_id, unnest(regexp_extract_all(html, '{_A}', 1)) AS href,
        unnest(regexp_extract_all(html, '{_A}[^>]*>(.*?)</a>', 2, 's')) AS label FROM pages)
        GROUP BY ALL""",
)
def page_links(spark, sf):
    found = links.page_links(with_nodes(_pages(spark, sf)), "page_id")
    return found.groupBy("page_id", "href", "label", "rule_rank").agg(F.count("*").alias("n"))


@query(
    "page_headings",
    f"""SELECT page_id, {shown_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS h1,
        {decode_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS title,
        regexp_extract(html, '<nav>.*?href="([^"]*)"', 1, 's') AS first_nav_link,
        regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, '' AS missing
        FROM pages""",
)
def page_headings(spark, sf):
    return with_nodes(_pages(spark, sf)).select(
        "page_id",
        sel.node_text("nodes", sel.one("article").child("h1")).alias("h1"),
        sel.node_text("nodes", sel.one("title"), raw=True).alias("title"),
        sel.node_attr("nodes", sel.one("nav").inside("a"), "href").alias("first_nav_link"),
        sel.node_attr("nodes", sel.one("html"), "lang").alias("lang"),
        sel.node_text("nodes", sel.one("h1", sel.has("class", "none"))).alias("missing"),
    )


@query(
    "nodes_by_tag",
    """SELECT tag, count(*) AS n, count(DISTINCT page_id) AS pages FROM (
        SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages)
        GROUP BY tag""",
)
def nodes_by_tag(spark, sf):
    nodes = explode_nodes(with_nodes(_pages(spark, sf)), "page_id").filter("tag <> '#text'")
    per_page = nodes.groupBy("tag", "page_id").agg(F.count("*").alias("k"))
    return per_page.groupBy("tag").agg(F.sum("k").alias("n"), F.count("*").alias("pages"))


_ARTICLE = "regexp_extract(html, '<article>(.*)</article>', 1, 's')"


@query(
    "page_areas",
    f"""SELECT page_id, {shown_sql(_ARTICLE)} AS area_text,
        regexp_replace({_ARTICLE}, '^\\s+|\\s+$', '', 'g') AS area_html,
        CAST(len(regexp_extract_all({_ARTICLE}, '<[a-z]')) AS INTEGER) AS element_count FROM pages""",
)
def page_areas(spark, sf):
    return with_nodes(_pages(spark, sf)).select(
        "page_id", F.inline(F.array(sel.area("nodes", "html", sel.one("article"))))
    )


_PARAS = (
    f"[y for y in [{shown_sql('x')} for x in regexp_extract_all("
    f"replace({_ARTICLE}, '<p>', '</p><p>') || '</p>', '<p>(.*?)</p>', 1, 's')] if y <> '']"
)
_LINKS = (
    f"[{shown_sql('z[1]')} || ' -> ' || z[2] for z in list_zip("
    f"regexp_extract_all(html, '{_A}[^>]*>(.*?)</a>', 2, 's'), regexp_extract_all(html, '{_A}', 1))]"
)


@query(
    "page_parts",
    f"""SELECT page_id, {shown_sql("regexp_extract(html, '<body>(.*)$', 1, 's')")} AS main_text,
        array_to_string({_LINKS}, chr(31)) AS all_links, '' AS all_images,
        'h1: ' || {shown_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS headings,
        array_to_string({_PARAS}, chr(31)) AS paragraphs FROM pages""",
)
def page_parts(spark, sf):
    parts = sel.page_parts("nodes")
    return with_nodes(_pages(spark, sf)).select(
        "page_id",
        parts.pop("main_text").alias("main_text"),
        *[F.array_join(c, "\x1f").alias(n) for n, c in parts.items()],
    )


LISTING = {
    "website_url": "concat('https://site', CAST(floor(c_custkey / 15) AS BIGINT), '.example.com')",
    "page": "c_custkey % 15 + 1",
    "html": """concat('<html><body><a href="/agent/', CAST(floor(c_custkey / 4) AS BIGINT) % 40, '">  ', c_name, ' </a>',
        '<div class="agent-card"><p>x<br>y<a href="/p/', CAST(floor(c_custkey / 5) AS BIGINT), '#top">Meet ', c_name, '</a></div>',
        '<a class=profile href="HTTPS://Other.example.org/X', c_custkey % 45, '">Bio</a>',
        '<a href="/login/agent">agent login</a><a href="#agent">agent</a>',
        '<a href="/misc/', c_custkey % 7, '?a=1&amp;b=2"><b>Realtor</b></a><a href="/privacy">Privacy</a>',
        '<script>var x = "<a href=agent>";</script></body>')""",
}
_SITE = LISTING["website_url"]
# (rule, place, label, href) of the links above
_LINKED = [
    ("1", "1", "c_name", "concat('/agent/', CAST(floor(c_custkey / 4) AS BIGINT) % 40)"),
    ("6", "2", "concat('Meet ', c_name)", "concat('/p/', CAST(floor(c_custkey / 5) AS BIGINT), '#top')"),
    ("5", "3", "'Bio'", "concat('HTTPS://Other.example.org/X', c_custkey % 45)"),
    ("1", "4", "'agent login'", "'/login/agent'"),
    ("1", "5", "'agent'", "'#agent'"),
    ("9", "6", "'Realtor'", "concat('/misc/', c_custkey % 7, '?a=1&b=2')"),
    ("NULL", "7", "'Privacy'", "'/privacy'"),
]
LISTED_LINKS = "(" + " UNION ALL ".join(
    f"SELECT {_SITE} AS website_url, {LISTING['page']} AS page, {rule} AS rule, {place} AS place,"
    f" {label} AS label, {href} AS href FROM customer"
    for rule, place, label, href in _LINKED
) + ")"


def listing_pages(spark, sf):
    return made_pages(table(spark, sf, "customer"), "c_custkey", LISTING)


@query(
    "agent_links",
    f"""SELECT website_url, page, CAST(rule AS INTEGER) AS rule_rank, label,
        CASE WHEN href LIKE '/%' THEN website_url || href ELSE href END AS url,
        place IN (1, 2, 3, 5, 6) AS agent, place <> 5 AS followable FROM {LISTED_LINKS}""",
)
def agent_links(spark, sf):
    found = links.page_links(with_nodes(listing_pages(spark, sf)), "website_url", "page")
    return found.select(
        "website_url", "page", "rule_rank", "label",
        resolve("website_url", "href").alias("url"),
        is_agent_link("href", "label").alias("agent"),
        followable("href").alias("followable"),
    )


_NEXT = {
    "c_custkey": "c_custkey",
    "html": """CASE c_custkey % 6
        WHEN 0 THEN concat('<a href="/l?page=', c_custkey, '">more</a><p><a href="/next">Go <b>Next</b></a>')
        WHEN 1 THEN concat('<ul><li class="pagination-next"><a href="/n', c_custkey, '">&gt;</a><li>x</ul><a href="/x?pagenum=3">3</a>')
        WHEN 2 THEN concat('<a href="/y">2</a><a href=/x?pagenum=', c_custkey, '>3</a>')
        WHEN 3 THEN '<button class="b next">&gt;</button><a href="/page/2">2</a>'
        WHEN 4 THEN concat('<a href="/q', c_custkey, '"><i class="fa chevron-right"></i></a>')
        ELSE '<p>the end' END""",
}


@query(
    "next_links",
    """SELECT c_custkey,
        CAST(CASE c_custkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 8 WHEN 2 THEN 10 WHEN 3 THEN 7 WHEN 4 THEN 18 END AS INTEGER) AS rule_rank,
        CASE c_custkey % 6 WHEN 3 THEN 'button' WHEN 5 THEN NULL ELSE 'a' END AS tag,
        CASE c_custkey % 6 WHEN 0 THEN '/next' WHEN 1 THEN '/n' || c_custkey WHEN 2 THEN '/x?pagenum=' || c_custkey
            WHEN 3 THEN '' WHEN 4 THEN '/q' || c_custkey END AS href
        FROM customer""",
)
def next_links(spark, sf):
    return links.next_link(with_nodes(made_pages(table(spark, sf, "customer"), "c_custkey", _NEXT)), "c_custkey")


_PAGED = {
    "c_custkey": "c_custkey",
    "page": "cast(c_custkey % 9 + 1 as int)",
    "url": """concat('https://s', c_nationkey, '.example.com/', CASE c_custkey % 4 WHEN 0 THEN concat('list?page=', c_custkey % 9 + 1, '&x=1')
        WHEN 1 THEN 'page/a/' WHEN 2 THEN 'dir/list' ELSE 'dir/' END)""",
    "html": """concat('<p>', CASE c_custkey % 6
        WHEN 0 THEN '<a href="#top">Next</a>' WHEN 1 THEN '<a href="more.html?n=2">go <b>next</b></a>'
        WHEN 2 THEN '<button>Next</button>' WHEN 3 THEN '<a title="Next" href="javascript:go()">&gt;</a>'
        WHEN 4 THEN '<a aria-label="Next" href="../up">&gt;</a>' ELSE '' END,
        '<a href="/n/1">first</a> <a href="/n/x">', c_custkey % 9 + CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 2 END, '</a>')""",
}


@query(
    "next_addresses",
    f"""WITH p AS (SELECT c_custkey, c_custkey % 9 + 1 AS page, c_custkey % 4 AS u, c_custkey % 6 AS h, c_custkey % 7 = 0 AS same,
            'https://s' || c_nationkey || '.example.com/' AS site FROM customer)
        SELECT c_custkey,
            CASE WHEN h = 0 THEN site || CASE u WHEN 0 THEN 'list?page=' || page || '&x=1' WHEN 1 THEN 'page/a/' WHEN 2 THEN 'dir/list' ELSE 'dir/' END || '#top'
                WHEN h = 1 THEN site || CASE u WHEN 0 THEN '' WHEN 1 THEN 'page/a/' ELSE 'dir/' END || 'more.html?n=2'
                WHEN h = 4 THEN site || CASE u WHEN 1 THEN 'page/' ELSE '' END || 'up'
                WHEN u = 0 THEN site || 'list?page=' || (page + 1) || '&x=1'
                WHEN u = 2 THEN site || 'dir/list/page/' || (page + 1) || '/'
                WHEN u = 3 THEN site || 'dir/page/' || (page + 1) || '/'
                WHEN NOT same THEN site || 'n/x' END AS next_address,
            CASE WHEN h IN (0, 1, 4) THEN 'link' WHEN u <> 1 THEN 'address' WHEN NOT same THEN 'number' END AS found_by FROM p""",
)
def next_addresses(spark, sf):
    pages = made_pages(table(spark, sf, "customer"), "c_custkey", _PAGED)
    return links.next_address(with_nodes(pages), "url", "page", "c_custkey")


PROFILE = {
    "c_custkey": "c_custkey",
    "url": "concat('https://agents.example.com/', c_custkey)",
    "html": """concat('<!doctype html><section id="overview-section"><div><div><div>photo</div><div><div><h1> ',
        c_name, '<br>of ', c_mktsegment, ' </h1></div><div><p>', c_mktsegment, ' &amp; Sons</p><p>no</p></div></div></div></div></section>',
        CASE WHEN c_custkey % 4 = 0 THEN concat('<p><a href="tel:305 ', c_custkey, '">call</a>')
             WHEN c_custkey % 4 = 1 THEN ''
             ELSE concat('<div class="a kIPpNw"><span><a href="tel:0">+1 ', c_custkey, '</a></span></div>') END,
        CASE WHEN c_custkey % 5 = 0 THEN ''
             ELSE concat('<div class="hTcjfz"><p class="idlIli">', c_custkey, ' Main St<p class="x idlIli">Town ', c_nationkey, '<p class="idlIli">USA</div>') END,
        '<div class="fbBxUf"><a href="http://www', c_custkey, '.example.org">site</a><a href="/no">no</a></div>')""",
}
PROFILE_SQL = """(SELECT c_custkey, concat('https://agents.example.com/', c_custkey) AS url,
    c_mktsegment || ' & Sons' AS business_name, c_name || chr(10) || 'of ' || c_mktsegment AS name,
    CASE c_custkey % 4 WHEN 0 THEN '305 ' || c_custkey WHEN 1 THEN '' ELSE '+1 ' || c_custkey END AS phone,
    CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_custkey || ' Main St Town ' || c_nationkey END AS address,
    concat('http://www', c_custkey, '.example.org') AS website, '' AS email FROM customer)"""


def profile_pages(spark, sf):
    return made_pages(table(spark, sf, "customer"), "c_custkey", PROFILE)


@query("overview_profiles", f"SELECT * FROM {PROFILE_SQL}")
def overview_profiles(spark, sf):
    return links.profile_fields(
        with_nodes(profile_pages(spark, sf)), links.OVERVIEW_PROFILE, "c_custkey", "url"
    )


_CONTACT = {
    "s_suppkey": "s_suppkey",
    "html": """concat('<body id=inner-page-wrapper><div><div>top</div><div><div><div>l</div><div><div><h1>', s_name,
        '</h1></div></div></div></div></div><div class="ip-agent-det-con-info"><ul><li><a href="mailto:s', s_suppkey,
        '@example.com ">mail<li><a id="agents-phone" href="#">555.010.', s_suppkey,
        '</a><li><a href="https://no.example.com">n</a><a href="http://s', s_suppkey, '.example.com/">web</a></ul></div>')""",
}


@query(
    "contact_profiles",
    """SELECT s_suppkey, s_name AS business_name, s_name AS name, '555.010.' || s_suppkey AS phone,
        '' AS address, concat('http://s', s_suppkey, '.example.com/') AS website,
        concat('s', s_suppkey, '@example.com ') AS email FROM supplier""",
)
def contact_profiles(spark, sf):
    pages = made_pages(table(spark, sf, "supplier"), "s_suppkey", _CONTACT)
    return links.profile_fields(with_nodes(pages), links.CONTACT_PROFILE, "s_suppkey")


@query(
    "raw_and_repeated_texts",
    """SELECT c_custkey, ' ' || c_name || 'of ' || c_mktsegment || ' ' AS raw_name,
        CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_custkey || ' Main St|Town ' || c_nationkey || '|USA' END AS lines,
        c_mktsegment || ' & Sons|no' AS overview FROM customer""",
)
def raw_and_repeated_texts(spark, sf):
    return with_nodes(profile_pages(spark, sf)).select(
        "c_custkey",
        sel.node_text("nodes", sel.one("h1"), raw=True).alias("raw_name"),
        F.array_join(sel.all_text("nodes", links.OVERVIEW_PROFILE["Address"]), "|").alias("lines"),
        F.array_join(
            sel.all_text("nodes", sel.one("section").inside("p")), "|"
        ).alias("overview"),
    )


@query(
    "site_page_counts",
    f"""SELECT site, page_id, count(*) AS links, CAST(grouping(site, page_id) AS BIGINT) AS level FROM (
        SELECT split_part(url, '/', 3) AS site, page_id, unnest(regexp_extract_all(html, '{_A}', 1)) AS href FROM pages)
        GROUP BY ROLLUP (site, page_id)""",
)
def site_page_counts(spark, sf):
    found = _pages(spark, sf).select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("site"), "page_id",
        F.explode(page_link_hrefs("html")).alias("href"),
    )
    return reports.site_page_counts(found, "site", "page_id")


@query(
    "site_outcomes",
    "SELECT count(*) FILTER (h LIKE '%</html>%') AS successful, count(*) FILTER (NOT h LIKE '%</html>%') AS failed"
    " FROM (SELECT html AS h FROM pages)",
)
def site_outcomes(spark, sf):
    return reports.site_outcomes(_pages(spark, sf), F.col("html").contains("</html>"))
