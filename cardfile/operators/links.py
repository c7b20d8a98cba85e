"""Links, next pages and profile fields from shredded pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.selectors import (
    Selector, has, has_own_text, has_text, holds, inner_text, is_attr, nth, one, starts,
    all_text, node_attr, node_text, text_content, with_loose,
)
from ..functions.text import blank_default, join_address, let
from ..functions.urls import drop_tel, follow, normalize_url, page_url, strip_mailto
from .columns import quoted
from .dedup import keep_first

# Where agent links are looked for, in this order.
AGENT_LINK_RULES = [
    one("a", has("href", "agent")),
    one("a", has("href", "realtor")),
    one("a", has("href", "profile")),
    one("a", has("class", "agent")),
    one("a", has("class", "profile")),
    one("div", has("class", "agent")).inside("a"),
    one("div", has("class", "profile")).inside("a"),
    one("a", holds("*", has_own_text("Agent"))),
    one("a", holds("*", has_own_text("Realtor"))),
]

# Where the link to the next page is looked for, in this order.
NEXT_PAGE_RULES = [
    one("a", has_text("next")),
    one("a", has_text("Next")),
    one("button", has_text("next")),
    one("button", has_text("Next")),
    one("a", is_attr("aria-label", "Next")),
    one("a", has("class", "next")),
    one("button", has("class", "next")),
    one("li", has("class", "next")).inside("a"),
    one("li", has("class", "pagination-next")).inside("a"),
    one("a", has("href", "page")),
    one("a", has("href", "p=")),
    one("a", has("href", "pagenum")),
    one("a", has("data-page", "next")),
    one("a", has("title", "Next")),
    one("button", has("title", "Next")),
    one("a", has("id", "next")),
    one("button", has("id", "next")),
    one("a", holds("i", has("class", "chevron-right"))),
    one("a", holds("span", has("class", "next"))),
]

# Where two kinds of profile page keep their fields.
_OVERVIEW = (
    one("*", is_attr("id", "overview-section"))
    .child("div").child("div", nth(1)).child("div", nth(2))
)
OVERVIEW_PROFILE = {
    "Name": _OVERVIEW.child("div", nth(1)).child("h1"),
    "Business_Name": _OVERVIEW.child("div", nth(2)).child("p", nth(1)),
    "Phone": one("div", has("class", "kIPpNw")).inside("a", has("href", "tel:")),
    "Address": one("div", has("class", "hTcjfz")).inside("p", has("class", "idlIli")),
    "Website": one("div", has("class", "fbBxUf")).inside("a"),
}
_CONTACT = one("div", is_attr("class", "ip-agent-det-con-info"))
CONTACT_PROFILE = {
    "Email": _CONTACT.inside("a", starts("href", "mailto:")),
    "Phone": _CONTACT.inside("a", is_attr("id", "agents-phone")),
    "Website": _CONTACT.inside("a", starts("href", "http://")),
    "Name": one("*", is_attr("id", "inner-page-wrapper"))
    .child("div").child("div", nth(2)).child("div", nth(1)).child("div", nth(2))
    .child("div", nth(1)).child("h1"),
}
ANY_TEL = one("a", has("href", "tel:"))


def page_links(shredded: DataFrame, *keep: str, rules: list[Selector] | None = None) -> DataFrame:
    """Every anchor with an href: position, href, text, and the first rule that selects it."""
    links = one("a", lambda n, _: F.coalesce(F.element_at(n["attrs"], "href"), F.lit("")) != "")

    def marks(ns: Column, rank: int, sel: Selector) -> Column:
        return F.transform(sel.select(ns), lambda n: F.struct(n["id"].alias("id"), F.lit(rank).alias("rank")))

    def in_order(ns: Column) -> Column:
        """Links and what rules select, by place and rank: a link stands before the first rule that selects it."""
        found = [marks(ns, i, sel) for i, sel in enumerate(AGENT_LINK_RULES if rules is None else rules, 1)]
        return F.array_sort(F.concat(marks(ns, 0, links), *found))

    def record(ns: Column, m: Column, after: Column) -> Column:
        return let(
            F.get(ns, m["id"] - 1),
            lambda n: F.struct(
                n["id"].alias("position"),
                F.element_at(n["attrs"], "href").alias("href"),
                inner_text(ns, n).alias("label"),
                F.when(after["id"] == m["id"], after["rank"]).alias("rule_rank"),
            ),
        )

    def records(ns: Column, ms: Column) -> Column:
        each = F.transform(ms, lambda m, i: F.when(m["rank"] == 0, F.struct(m.alias("m"), F.get(ms, i + 1).alias("after"))))
        return F.transform(F.filter(each, lambda x: x.isNotNull()), lambda x: record(ns, x["m"], x["after"]))

    return shredded.select(*keep, F.inline(with_loose("nodes", lambda ns: let(in_order(ns), lambda ms: records(ns, ms)))))


def next_link(shredded: DataFrame, *keep: str, rules: list[Selector] | None = None) -> DataFrame:
    """First hit of the first rule with hits; buttons have no href, so theirs is blank."""

    def ranked(ns: Column, rank: int, sel: Selector) -> Column:
        hit = F.transform(
            F.slice(sel.select(ns), 1, 1),
            lambda n: F.struct(
                F.lit(rank).alias("rule_rank"),
                n["tag"].alias("tag"),
                F.coalesce(F.element_at(n["attrs"], "href"), F.lit("")).alias("href"),
            ),
        )
        return F.get(hit, 0)

    best = with_loose("nodes", lambda ns: F.coalesce(*[ranked(ns, i, r) for i, r in enumerate(rules or NEXT_PAGE_RULES, 1)]))
    return shredded.select(*keep, best.alias("_best")).select(*keep, "_best.*")


def next_address(
    shredded: DataFrame, url: str, page: str, *keep: str, rules: list[Selector] | None = None
) -> DataFrame:
    """``keep``, ``next_address`` and ``found_by``: where a crawl goes from page number ``page`` at ``url``.

    The first hit of the first rule with hits is followed, if it leads elsewhere (``link``; buttons lead nowhere). Else the page
    number in the address is raised (``address``), and where there is no rule for that the first link whose words
    hold the next number is followed (``number``). What leads to the page itself, or nowhere, is the end: both are null.
    """
    here, n = quoted(url), (quoted(page) + 1).cast("string")
    columns = list(dict.fromkeys([*keep, url, page]))
    listed = next_link(shredded, *columns, "nodes", rules=rules)
    numbered = F.get(
        F.transform(
            F.slice(one("a", lambda a, nodes: text_content(nodes, a).contains(n)).select("nodes"), 1, 1),
            lambda a: F.coalesce(F.element_at(a["attrs"], "href"), F.lit("")),
        ),
        0,
    )

    def elsewhere(to: Column) -> Column:
        return F.when(to != here, to)

    tried = listed.select(
        *columns,
        elsewhere(F.when(F.col("tag") == "a", follow(here, F.col("href")))).alias("_link"),
        page_url(here, quoted(page) + 1).alias("_address"),
        elsewhere(follow(here, numbered)).alias("_number"),
    )
    # A page number that is raised is tried before the numbers on the page, also where it leads to the page itself.
    raised = F.col("_link").isNull() & F.col("_address").isNotNull()
    return tried.select(
        *[quoted(c) for c in keep],
        F.coalesce("_link", F.when(raised, elsewhere(F.col("_address"))).otherwise(F.col("_number"))).alias("next_address"),
        F.when(F.col("_link").isNotNull(), "link")
        .when(raised, F.when(F.col("_address") != here, "address"))
        .when(F.col("_number").isNotNull(), "number").alias("found_by"),
    )


def dedup_links(links: DataFrame, url: str, *order: str) -> DataFrame:
    """The first link per normalised address, in the order the crawl would meet them."""
    return keep_first(links, normalize_url(url), *order)


def profile_fields(
    shredded: DataFrame, selectors: dict[str, Selector], *keep: str, raw_text: bool = False
) -> DataFrame:
    """One row per page with the fields of a profile; absent fields are blank.

    Without a phone selector hit, the first ``tel:`` link counts. Without a selector for the
    business name, the name stands in.
    """

    def words(field: str) -> Column:
        if field not in selectors:
            return F.lit("")
        return node_text("nodes", selectors[field], raw=raw_text)

    def href(field: str) -> Column:
        return node_attr("nodes", selectors[field], "href") if field in selectors else F.lit("")

    name = words("Name")
    fallback = drop_tel(node_attr("nodes", ANY_TEL, "href"))
    address = (
        join_address(all_text("nodes", selectors["Address"])) if "Address" in selectors else F.lit("")
    )
    return shredded.select(
        *keep,
        (words("Business_Name") if "Business_Name" in selectors else name).alias("business_name"),
        name.alias("name"),
        F.coalesce(F.nullif(words("Phone"), F.lit("")), fallback).alias("phone"),
        address.alias("address"),
        href("Website").alias("website"),
        strip_mailto(href("Email")).alias("email"),
    )


def link_label(label: Column | str) -> Column:
    return blank_default(label, "Unknown")


def numbered_pages(pages: DataFrame, site: str, *order: str, limit: int) -> DataFrame:
    """Page numbers 1 to ``limit`` within a site; the limit keeps a hot site out of one task."""
    rank = F.row_number().over(W.partitionBy(site).orderBy(*order))
    return pages.withColumn("page", rank).filter(F.col("page") <= limit)
