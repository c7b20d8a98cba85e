"""HTML extraction with removal of site templates.

A page becomes a tree of elements. Every element that holds text gets a hash of its whole subtree. Spark counts on how
many different pages of a host a subtree occurs; what recurs is the site's, not the page's, and is deleted.
Elements that say what they are (navigation, adverts, comments and so on, by tag, role, class or id) are left out on
every page, also on hosts with a single one. A class or id counts as a whole (sidebar, not has-sidebar), and not where an
article or a main is inside, nor for most of the text of a page without these. Everything else on the page is read, inside an article or not.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfile.session import materialize

#: A subtree is a template if it occurs on so many different pages of a host, and on such a share of them.
LEAST_PAGES, SHARE = 4, 0.2

_TOKEN = re.compile(
    r"<!--(?:.*?--\s*+>|.*+\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?P<name>[^\s=\"'/>]++)(?:\s*+=\s*+(?:\"(?P<a>[^\"]*+)\"|'(?P<b>[^']*+)'|(?P<c>[^\s>]++)))?+")
_SPACE, _WORD = re.compile(r"\s+"), re.compile(r"[a-z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes template svg math".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_LEFT_OUT = frozenset(
    "head script style noscript template nav footer aside form button select option input textarea label iframe object "
    "embed applet svg math canvas audio video map dialog menu search noembed noframes title".split()
)
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar "
    "tablist".split()
)
#: Words of a class or id that say what an element is.
_SAYS_REACTION = frozenset("comment comments disqus replies reply respond ad ads advert adverts advertisement".split())
_SAYS = _SAYS_REACTION | frozenset(
    "adsense advertising banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo related "
    "share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription toolbar topbar".split()
)
#: Words that may stand beside these in a name without changing what it says. A name with any other word says nothing.
_BESIDE = frozenset(
    "area bar block body bottom box button buttons container content desktop dropdown entry footer global header icons inner "
    "item items left link links list main mobile outer panel post posts article articles primary right secondary "
    "section site slot small top unit widget widgets wrap wrapper".split()
)
#: Which open elements a start tag ends, up to the nearest of the limits.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = _BLOCKS - {"body", "html", "td", "th", "tr", "li", "dd", "dt", "option", "caption", "legend", "summary"}


class _Element:
    __slots__ = ("tag", "out", "named", "scope", "parent", "parts", "digest")

    def __init__(self, tag: str, parent, out: bool, named: bool, scope: str):
        self.tag, self.parent, self.out, self.named, self.scope = tag, parent, out, named, scope
        self.parts, self.digest = [], None


def _attrs(source: str) -> dict[str, str]:
    found = {}
    for m in _ATTR.finditer(source):
        found.setdefault(m["name"].lower(), unescape(m["a"] or m["b"] or m["c"] or ""))
    return found


def _says(names: str, known: frozenset) -> bool:
    """Whether a class or id, as a whole, is one of the known words or made of them and words that change nothing."""
    for name in names.lower().split():
        words = set(_WORD.findall(name))
        if words & known and words <= known | _BESIDE:
            return True
    return False


def _is_left_out(tag: str, source: str, scope: str) -> tuple[bool, bool]:
    """Whether an element is not part of the main text by what it is, and whether its class or id says so."""
    if tag in _LEFT_OUT or tag == "header" and not scope:
        return True, False
    if tag in ("html", "body") or len(source) < 4:
        return False, False
    a = _attrs(source)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True, False
    if a.get("role", "").lower() in _ROLES:
        return True, False
    known = _SAYS_REACTION if tag in ("article", "main") else _SAYS
    return False, _says(f"{a.get('class', '')} {a.get('id', '')}", known)


def _leave_out_named(order: list[_Element]) -> None:
    """Sets ``out`` where a name says so, but not where there is an article or a main with text inside.

    If there is none on the whole page, what holds most of its text stays, too.
    """
    if any(e.named for e in order):
        size, holds = {}, set()
        for e in reversed(order):
            size[e] = sum(len(p.strip()) if isinstance(p, str) else 0 if p.out else size[p] for p in e.parts)
            inside = [p for p in e.parts if not isinstance(p, str) and not p.out and size[p]]
            if any(p in holds or p.tag in ("article", "main") and not p.named for p in inside):
                holds.add(e)
        marked = order[0] in holds
        for e in order:
            if e.named and e not in holds and (marked or e.tag in ("article", "main") or 2 * size[e] <= size[order[0]]):
                e.out = True
    for e in order[1:]:
        e.out = e.out or e.parent.out


def tree(html: str) -> tuple[_Element, list[_Element]]:
    """The root and all elements in page order. ``parts`` of an element are texts and elements."""
    root = _Element("", None, False, False, "")
    stack, open_, order, at = [root], {}, [root], 0

    def close(to: int) -> None:
        while len(stack) > to:
            open_[stack.pop().tag] -= 1

    while m := _TOKEN.search(html, at):
        if m.start() > at:
            stack[-1].parts.append(unescape(html[at : m.start()]))
        at, tag = m.end(), m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["close"]:
            if open_.get(tag):
                place = len(stack) - 1
                while stack[place].tag != tag:
                    place -= 1
                close(place)
            continue
        if tag in _ENDS_P and open_.get("p"):
            # An open paragraph ends before a block, with what is open inside it.
            place = len(stack) - 1
            while stack[place].tag != "p" and stack[place].tag not in ("td", "th", "button", "object"):
                place -= 1
            if stack[place].tag == "p":
                close(place)
        elif tag in _CLOSES and any(open_.get(t) for t in _CLOSES[tag][0]):
            ended, limits = _CLOSES[tag]
            lowest = None
            for place in range(len(stack) - 1, 0, -1):
                if stack[place].tag in limits:
                    break
                if stack[place].tag in ended:
                    lowest = place
            if lowest is not None:
                close(lowest)
        over = stack[-1]
        scope = over.scope or (tag if tag in ("article", "main") else "")
        element = _Element(tag, over, *_is_left_out(tag, m["attrs"], over.scope), scope)
        order.append(element)
        over.parts.append(element)
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            if tag not in _LEFT_OUT:
                element.parts.append(html[at : end.start() if end else len(html)])
            if not end:
                at = len(html)
                break
            after = html.find(">", end.end())
            at = len(html) if after < 0 else after + 1
            continue
        if m["attrs"].endswith("/") and tag not in _BLOCKS:
            continue
        stack.append(element)
        open_[tag] = open_.get(tag, 0) + 1
    if at < len(html):
        stack[-1].parts.append(unescape(html[at:]))
    _leave_out_named(order)
    return root, order


def _hash(order: list[_Element]) -> None:
    """``digest`` (64 bits) for each element that holds text, children before parents."""
    for e in reversed(order):
        if e.out:
            continue
        parts = [x for p in e.parts if (x := _SPACE.sub(" ", p).strip() if isinstance(p, str) else p.digest)]
        if parts:
            body = "\x1f".join([e.tag, *[str(p) for p in parts]])
            e.digest = int.from_bytes(hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def subtree_hashes(html: str) -> tuple[int | None, list[int]]:
    """Hash of the page's main text as a whole, and the different hashes of its elements that hold main text."""
    root, order = tree(html)
    _hash(order)
    return root.digest, list({e.digest for e in order[1:] if e.digest is not None})


def main_text(html: str, templates=frozenset()) -> str:
    """The blocks of the page outside what is left out and outside subtrees whose hash is a template."""
    root, order = tree(html)
    if templates:
        _hash(order)
    blocks, line = [], []

    def end_block() -> None:
        if text := _SPACE.sub(" ", "".join(line)).strip():
            blocks.append(text)
        line.clear()

    stack = [iter([root])]
    names = [""]
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if names.pop() in _BLOCKS:
                end_block()
        elif isinstance(part, str):
            line.append(part)
        elif part.tag == "br":
            line.append(" ")
        else:
            if part.tag in _BLOCKS:
                end_block()
            if part.out or part.digest in templates:
                continue
            stack.append(iter(part.parts))
            names.append(part.tag)
    end_block()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host in small letters, without user and port; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(found)


def site_templates(
    pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE, url: str = "url", html: str = "html"
) -> DataFrame:
    """``host``, ``page`` (hash of the html) and ``templates`` (hashes of the page's subtrees), written.

    Pages without a host and pages without a template have no row. Captures of one address are one page, and so are
    pages whose main text is the same: as many pages count as there are different ones of either.
    """

    def hashes(batches):
        for frame in batches:
            for at in range(0, len(frame), 64):
                part = frame.iloc[at : at + 64].drop(columns="html")
                found = [subtree_hashes(source) for source in frame["html"].iloc[at : at + 64]]
                rows = part.iloc[np.repeat(np.arange(len(part)), [len(x) for _, x in found])]
                content = [c for c, x in found for _ in x]
                yield rows.assign(content=np.array(content, dtype=np.int64), subtree=np.array([y for _, x in found for y in x], dtype=np.int64))

    html = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    site, address = host_of(F.col(f"`{url}`")).alias("host"), F.xxhash64(F.col(f"`{url}`").cast("string")).alias("address")
    sites = pages.select(site, F.xxhash64(html).alias("page"), address, html.alias("html")).where("host <> ''")
    kinds = "host string, page bigint, address bigint, content bigint, subtree bigint"
    seen = materialize(sites.mapInPandas(hashes, kinds), "seen")
    different = F.least(F.count_distinct("content"), F.count_distinct("address"))
    hosts = seen.groupBy("host").agg(different.alias("pages")).where(F.col("pages") >= least_pages)
    often = seen.groupBy("host", "subtree").agg(different.alias("n")).where(F.col("n") >= least_pages)
    recurring = often.join(materialize(hosts, "hosts"), "host").where(F.col("n") >= share * F.col("pages"))
    recurring = materialize(recurring.select("host", "subtree"), "subtrees")
    # A page takes along its own templates only, however many its host has.
    own = seen.join(recurring, ["host", "subtree"]).groupBy("host", "page").agg(F.collect_set("subtree").alias("templates"))
    return materialize(own, "templates")


def extract(
    pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE,
    key: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """``key``, ``url``, ``text``, ``n_chars`` for each row.

    A null html is an empty one; a page without main text has an empty text. A null or odd address has no host, so
    only the page's own marks count. Repeated rows are rows of their own, but one page in the counts; a null key is
    kept; an empty table gives no row; other columns are not read.
    """
    templates = site_templates(pages, least_pages, share, url, html)
    own = pages.select(
        F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias(url), host_of(F.col(f"`{url}`")).alias("_host"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("_html"),
    )
    own = own.withColumn("_page", F.xxhash64("_html"))
    known = templates.select(F.col("host").alias("_host"), F.col("page").alias("_page"), F.col("templates").alias("_known"))
    joined = own.join(known, ["_host", "_page"], "left")

    @F.pandas_udf("string")
    def text(sources: pd.Series, known: pd.Series) -> pd.Series:
        out = [main_text(s, frozenset(() if k is None else k)) for s, k in zip(sources, known, strict=True)]
        return pd.Series(out, dtype=object)

    out = joined.select(F.col(key), F.col(url), text("_html", "_known").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
