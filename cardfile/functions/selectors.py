"""Element selection on a ``nodes`` array.

A selector is a chain of steps; each step names a tag, tests on the element, and whether it is a
descendant or a child of what the step before selected::

    one("div", has("class", "kIPpNw")).inside("a", has("href", "tel:"))
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

Test = Callable[[Column, Column], Column]  # (node, all nodes) -> boolean


def attr(node: Column, name: str) -> Column:
    return F.coalesce(F.element_at(node["attrs"], name), F.lit(""))


def is_attr(name: str, value: str) -> Test:
    return lambda n, _: attr(n, name) == value


def has(name: str, part: str) -> Test:
    return lambda n, _: attr(n, name).contains(part)


def starts(name: str, prefix: str) -> Test:
    return lambda n, _: attr(n, name).startswith(prefix)


def has_text(part: str) -> Test:
    """The words of the element, those of its descendants included."""
    return lambda n, nodes: text_content(nodes, n).contains(part)


def has_own_text(part: str) -> Test:
    """The first piece of text that is a direct child."""
    return lambda n, nodes: F.coalesce(
        F.get(F.filter(inside_of(nodes, n), lambda t: _is_text(t) & (t["parent"] == n["id"])), 0)[
            "text"
        ].contains(part),
        F.lit(False),
    )


def holds(tag: str, *tests: Test) -> Test:
    """Some descendant fits."""
    return lambda n, nodes: F.exists(
        inside_of(nodes, n), lambda d: _fits(d, nodes, tag, tests)
    )


def nth(position: int) -> Test:
    """Position among the children of the parent with the same tag."""
    return lambda n, _: n["nth"] == position


def inside_of(nodes: Column, n: Column) -> Column:
    """Descendants of a node: its numbers are a run, so this is a slice and not a search."""
    return F.slice(nodes, n["id"] + 1, n["last"] - n["id"])


def with_loose(nodes: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of the nodes as an array of its own.

    Spark copies a whole stored array for each slice of it, but of an array that was just made only the slice: with
    many slices per page the work is then that of the slices.
    """
    return let(F.filter(_nodes(nodes), lambda n: n["id"].isNotNull()), body)


def _is_text(n: Column) -> Column:
    return n["tag"] == "#text"


def _fits(n: Column, nodes: Column, tag: str, tests: tuple[Test, ...]) -> Column:
    out = (n["tag"] != "#text") if tag == "*" else (n["tag"] == tag)
    for test in tests:
        out = out & test(n, nodes)
    return out


def text_content(nodes: Column, n: Column) -> Column:
    """Text of all descendants as it stands in the source."""
    return F.array_join(
        F.transform(F.filter(inside_of(nodes, n), _is_text), lambda t: t["text"]), ""
    )


def inner_text(nodes: Column, n: Column) -> Column:
    """Text as shown: gaps collapse to one space, blocks and ``<br>`` start a new line, no
    white space at the ends."""

    def shown(t: Column) -> Column:
        words = F.regexp_replace(t["text"], r"[ \t\r\n\f]+", " ")
        new_line = F.when(words == " ", "").otherwise(F.concat(F.lit("\n"), F.ltrim(words)))
        return F.when(t["gap"], new_line).otherwise(words)

    def one_space(line: Column) -> Column:
        return F.when(line.contains("  "), F.regexp_replace(line, " {2,}", " ")).otherwise(line)

    pieces = F.transform(F.filter(inside_of(nodes, n), _is_text), shown)
    return strip(F.replace(let(F.array_join(pieces, ""), one_space), F.lit(" \n"), F.lit("\n")))


@dataclass(frozen=True)
class Step:
    tag: str
    tests: tuple[Test, ...]
    child: bool


@dataclass(frozen=True)
class Selector:
    steps: tuple[Step, ...]

    def inside(self, tag: str, *tests: Test) -> Selector:
        return replace(self, steps=(*self.steps, Step(tag, tests, child=False)))

    def child(self, tag: str, *tests: Test) -> Selector:
        return replace(self, steps=(*self.steps, Step(tag, tests, child=True)))

    def select(self, nodes: Column | str) -> Column:
        """Matching nodes in document order."""
        ns = _nodes(nodes)
        found = F.filter(ns, lambda n: _fits(n, ns, self.steps[0].tag, self.steps[0].tests))
        for step in self.steps[1:]:
            found = let(found, partial(_next_step, ns, step))
        return found


def _outermost(found: Column) -> Column:
    """Of nodes in document order, a lambda variable, those that lie inside none of the others."""

    def step(kept: Column, n: Column) -> Column:
        ends = F.coalesce(F.get(kept, F.size(kept) - 1)["last"], F.lit(-1))
        return F.when(n["id"] <= ends, kept).otherwise(F.concat(kept, F.array(n)))

    # Nodes are runs that hold each other or do not meet: where any two are nested, so are two neighbours.
    nested = F.exists(F.transform(found, lambda n, i: F.coalesce(F.get(found, i + 1)["id"] <= n["last"], F.lit(False))), lambda x: x)
    return F.when(nested, F.aggregate(found, F.slice(found, 1, 0), step)).otherwise(found)


def _next_step(nodes: Column, step: Step, before: Column) -> Column:
    """Nodes below those found so far, in document order. A run is looked through once, however many nodes it was found by."""

    def fits(n: Column) -> Column:
        return _fits(n, nodes, step.tag, step.tests)

    def below(outer: Column) -> Column:
        if not step.child:
            return F.flatten(F.transform(outer, lambda p: F.filter(inside_of(nodes, p), fits)))
        own = F.transform(outer, lambda p: F.filter(inside_of(nodes, p), lambda n: (n["parent"] == p["id"]) & fits(n)))
        any_ = F.filter(nodes, lambda n: fits(n) & F.exists(before, lambda p: n["parent"] == p["id"]))
        return F.when(F.size(outer) == F.size(before), F.flatten(own)).otherwise(any_)

    return let(_outermost(before), below)


def one(tag: str, *tests: Test) -> Selector:
    return Selector((Step(tag, tests, child=False),))


def first(nodes: Column | str, sel: Selector) -> Column:
    return F.get(sel.select(nodes), 0)


def _nodes(nodes: Column | str) -> Column:
    return F.col(nodes) if isinstance(nodes, str) else nodes


def node_text(nodes: Column | str, sel: Selector, raw: bool = False) -> Column:
    """Text of the first match, blank when there is none."""
    pick = text_content if raw else inner_text
    texts = F.transform(F.slice(sel.select(nodes), 1, 1), lambda n: pick(_nodes(nodes), n))
    return F.coalesce(F.get(texts, 0), F.lit(""))


def all_text(nodes: Column | str, sel: Selector) -> Column:
    """Texts of all matches in document order."""
    return F.transform(sel.select(nodes), lambda n: inner_text(_nodes(nodes), n))


def node_attr(nodes: Column | str, sel: Selector, name: str) -> Column:
    """Attribute of the first match, blank when there is none."""
    return F.coalesce(F.element_at(first(nodes, sel)["attrs"], name), F.lit(""))


def area(nodes: Column | str, html: Column | str, sel: Selector) -> Column:
    """Text, inner HTML and number of elements below the first match."""
    ns, source = _nodes(nodes), _nodes(html)
    found = F.transform(
        F.slice(sel.select(nodes), 1, 1),
        lambda n: F.struct(
            inner_text(ns, n).alias("area_text"),
            strip(F.substr(source, n["inner_from"] + 1, n["inner_to"] - n["inner_from"])).alias(
                "area_html"
            ),
            F.size(F.filter(inside_of(ns, n), lambda d: ~_is_text(d))).alias("element_count"),
        ),
    )
    none = F.struct(
        F.lit("").alias("area_text"), F.lit("").alias("area_html"), F.lit(0).alias("element_count")
    )
    return F.coalesce(F.get(found, 0), none)


def page_parts(nodes: Column | str, area: Selector | None = None) -> dict[str, Column]:
    """Text of an area (the body), and its links, images, headings and paragraphs as text lines.

    Headings go by level, then by place.
    """
    area = area or one("body")

    def inside(ns: Column, tag: str) -> Column:
        first_area = F.slice(area.select(ns), 1, 1)
        return F.flatten(F.transform(first_area, lambda a: F.filter(inside_of(ns, a), lambda n: n["tag"] == tag)))

    def filled(ns: Column, tag: str) -> Column:
        return F.filter(F.transform(inside(ns, tag), lambda n: inner_text(ns, n)), lambda t: t != "")

    def headings(ns: Column, tag: str) -> Column:
        return F.transform(filled(ns, tag), lambda t: F.concat(F.lit(f"{tag}: "), t))

    def pair(before: Column, after: Column) -> Column:
        return F.concat(before, F.lit(" -> "), after)

    parts = {
        "main_text": lambda ns: node_text(ns, area),
        "all_links": lambda ns: F.transform(inside(ns, "a"), lambda n: pair(inner_text(ns, n), attr(n, "href"))),
        "all_images": lambda ns: F.transform(inside(ns, "img"), lambda n: pair(attr(n, "alt"), attr(n, "src"))),
        "headings": lambda ns: F.concat(*[headings(ns, f"h{level}") for level in range(1, 7)]),
        "paragraphs": lambda ns: filled(ns, "p"),
    }
    return {name: with_loose(nodes, part) for name, part in parts.items()}
