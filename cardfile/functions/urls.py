"""URL rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, strip, text

# Endings or parts that rule out an address.
FILE_ENDINGS = ["pdf", "doc", "docx", "xls", "xlsx", "jpg", "jpeg", "png", "gif", "zip", "rar"]
FOREIGN_PARTS = ["mailto:", "tel:", "javascript:", "#"]

# Words that make a link an agent link, and words that make it anything but one.
AGENT_HREF_WORDS = [
    "/agent/", "/realtor/", "/profile/", "agent", "realtor", "profile",
    "/members/", "/team/", "/staff/", "/broker/", "/about/", "/people/",
]
AGENT_TEXT_WORDS = [
    "agent", "realtor", "broker", "associate", "view profile", "profile",
    "meet", "team", "about", "bio", "contact",
]
AGENT_EXCLUDED_WORDS = ["login", "signin", "register", "signup", "admin", "dashboard", "logout"]

# Control characters and the blank, which URL parsers drop at the start.
LEADING_JUNK = "".join(map(chr, range(33)))

# Query parameters that carry a page number, in order of preference.
PAGE_PARAMS = ["page", "p", "pagenum", "pg", "pagination"]


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests)


def is_valid_url(c: Column | str, exclusions: bool = True) -> Column:
    """http(s), a host, maybe a port, then nothing or a path without white space; and not a file
    or another kind of link, unless ``exclusions`` is off.

    A host is localhost, four numbers, or labels of at most 63 letters, digits and inner hyphens
    before a top level of 2 to 6 letters. The label rules are tested one by one: a pattern that
    repeats over labels recurses per label, and one junk address would overflow the stack.
    """
    u = text(c)
    host = F.regexp_extract(u, r"(?iU)^https?://([A-Z\d.\-]++)(?::\d+)?(?:/?|[/?]\S+)$", 1)
    shape = let(host, _is_host)
    if not exclusions:
        return shape
    endings = "|".join(FILE_ENDINGS)
    return shape & ~u.rlike(rf"(?iU)\.(?:{endings})$|{'|'.join(FOREIGN_PARTS)}")


def _is_host(host: Column) -> Column:
    domain = (
        host.rlike(r"(?iU)^[A-Z0-9.\-]++$")
        & host.rlike(r"(?iU)\.[A-Z]{2,6}\.?$")
        & ~host.rlike(r"(?iU)^[.\-]|\.[.\-]|-\.|[A-Z0-9\-]{64}")
    )
    return domain | host.rlike(r"(?iU)^(?:localhost|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})$")


def ensure_scheme(c: Column | str) -> Column:
    """``https://`` before anything that does not start with a lower-case http(s) scheme."""
    u = strip(text(c))
    return F.when((u == "") | u.rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))


def normalize_url(c: Column | str) -> Column:
    """Scheme and host in lower case, no fragment, no empty query.

    As in Python's URL parser, leading blanks and control characters and inner line breaks go.
    """

    def lower_head(u: Column) -> Column:
        head = F.regexp_extract(u, r"^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?]*)?)", 1)
        return let(head, lambda h: F.concat(F.lower(h), F.substr(u, F.length(h) + 1)))

    def without_empty_query(u: Column) -> Column:
        return F.when(F.instr(u, "?") == F.length(u), F.substring_index(u, "?", 1)).otherwise(u)

    tidy = F.ltrim(col(c), F.lit(LEADING_JUNK))
    for char in ("\t", "\r", "\n"):
        tidy = F.replace(tidy, F.lit(char), F.lit(""))
    return let(F.substring_index(tidy, "#", 1), lambda u: let(without_empty_query(u), lower_head))


def site_of(c: Column | str) -> Column:
    """Scheme and host of an absolute address."""
    return F.regexp_extract(col(c), r"^((?i:https?)://[^/?#]+)", 1)


def _without_dots(path: Column) -> Column:
    """A path that starts with a slash, its segments ``.`` and ``..`` worked off."""

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    def joined(parts: Column) -> Column:
        kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), step)
        end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, end), "/"))

    plain = F.when(path.rlike(r"/\.\.?(/|$)"), let(F.split(path, "/", -1), joined))
    return plain.otherwise(path)


def resolve(base: Column | str, href: Column | str) -> Column:
    """Absolute form of hrefs that start with a slash; all others stay as they are.

    Dot segments are worked off in paths of the same host.
    """
    h = col(href)
    scheme = F.regexp_extract(col(base), r"^((?i:https?):)", 1)
    path = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.substring(h, F.length(path) + 1, F.length(h))
    return (
        F.when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(site_of(base), _without_dots(path), rest))
        .otherwise(h)
    )


def follow(base: Column | str, href: Column | str) -> Column:
    """Where a browser at ``base`` goes by ``href``: ``base`` itself where it goes nowhere.

    Blank ones, scripts and mail, telephone or data addresses lead nowhere; a fragment leads into the page. Queries and relative paths
    start from the path of ``base``; dot segments are worked off.
    """
    u, h = col(base), strip(text(href))
    bare = F.regexp_extract(u, r"^([^?#]*)", 1)
    path = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.substring(h, F.length(path) + 1, F.length(h))
    folder = F.regexp_extract(bare, r"^(?i:https?)://[^/]+(/(?:.*/)?)", 1)
    near = F.concat(site_of(u), _without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), path)), rest)
    return (
        F.when((h == "") | h.rlike("^(?i:javascript|mailto|tel|data):"), u)
        .when(h.startswith("#"), F.concat(F.substring_index(u, "#", 1), h))
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | h.startswith("/"), resolve(u, h))
        .when(h.startswith("?"), F.concat(bare, h))
        .otherwise(near)
    )


def followable(href: Column | str) -> Column:
    h = text(href)
    return ~(h.startswith("#") | h.startswith("javascript:"))


def is_agent_link(
    href: Column | str,
    label: Column | str,
    href_words: list[str] = AGENT_HREF_WORDS,
    text_words: list[str] = AGENT_TEXT_WORDS,
    excluded: list[str] = AGENT_EXCLUDED_WORDS,
) -> Column:
    h, t = F.lower(text(href)), F.lower(text(label))
    wanted = _any([h.contains(w) for w in href_words] + [t.contains(w) for w in text_words])
    return wanted & ~_any([h.contains(w) for w in excluded])


def _with_param(u: Column, name: str, value: Column) -> Column:
    """The address with one ``name=value`` where the query has ``name`` first; repeats of it go."""
    whole = F.substring_index(u, "#", 1)
    path = F.substring_index(whole, "?", 1)
    parts = F.split(F.substring(whole, F.length(path) + 2, F.length(whole)), "&", -1)
    given = lambda p: p.startswith(f"{name}=")

    def swapped(parts: Column) -> Column:
        first = F.array_position(F.transform(parts, given), True)
        each = F.transform(
            parts,
            lambda p, i: F.when(~given(p), p).when(i + 1 == first, F.concat(F.lit(f"{name}="), value)),
        )
        query = F.array_join(F.filter(each, lambda p: p.isNotNull()), "&")
        return F.concat(path, F.lit("?"), query, F.substring(u, F.length(whole) + 1, F.length(u)))

    return let(parts, swapped)


def page_url(c: Column | str, page: Column | int) -> Column:
    """Address of another page of a listing; null when there is no rule for it."""
    u = col(c)
    n = (F.lit(page) if isinstance(page, int) else page).cast("string")
    out = None
    for name in PAGE_PARAMS:
        holds = u.rlike(rf"^[^?#]*\?(?:[^#]*&)?{name}=[^&#]")
        swap = _with_param(u, name, n)
        out = F.when(holds, swap) if out is None else out.when(holds, swap)
    slash = F.when(u.endswith("/"), "").otherwise("/")
    appended = F.concat(u, slash, F.lit("page/"), n, F.lit("/"))
    return out.when(~u.contains("page"), appended)


def page_urls(c: Column | str, last: int) -> Column:
    """Candidate pages 2 to ``last`` as an array of (page, url)."""
    return F.transform(
        F.sequence(F.lit(2), F.lit(last)),
        lambda n: F.struct(n.alias("page"), page_url(c, n).alias("url")),
    )


def strip_mailto(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"^mailto:", "")


def drop_tel(c: Column | str) -> Column:
    return strip(F.replace(col(c), F.lit("tel:"), F.lit("")))


def page_link_hrefs(html: Column | str) -> Column:
    """Double-quoted hrefs of anchors straight from the source text, without shredding."""
    return F.regexp_extract_all(col(html), F.lit(r'<a\b[^>]*?href="([^"]*)"'), F.lit(1))
