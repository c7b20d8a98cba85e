"""HTML text to an array of nodes, one array per page.

The nodes of a page stay in the row of the page, numbered 1..n in document order, and every node
knows the number of its last descendant. So "inside", "child of" and "inner text" are array
expressions on that row (``selectors.py``), and field extraction needs no shuffle at all.
This is the only Python in the library; it gets and returns Arrow arrays.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col

NODES_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("parent", T.IntegerType()),
            T.StructField("last", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("nth", T.IntegerType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
            T.StructField("gap", T.BooleanType()),
            T.StructField("inner_from", T.IntegerType()),
            T.StructField("inner_to", T.IntegerType()),
        ]
    )
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(
    r"([^\s=>\"'/][^\s=>/]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+"
)

# Output is cut into arrays of about this many nodes, whatever the size of the input batch.
_NODES_PER_ARRAY = 50_000

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody "
    "td tfoot th thead tr ul".split()
)
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title")}
_NO_TEXT = frozenset(("script", "style"))
# An opening tag ends the open elements named first, looking no further up than those named second.
_ENDS = {t: (frozenset("p"), frozenset(("td", "th", "table", "button"))) for t in _BLOCK}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ENDS |= {t: (_HEADINGS | {"p"}, _ENDS[t][1]) for t in _HEADINGS}
_ENDS |= {
    "a": (frozenset("a"), frozenset(("td", "th", "table", "button"))),
    "li": (frozenset(("li", "p")), frozenset(("ul", "ol"))),
    "dt": (frozenset(("dt", "dd", "p")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd", "p")), frozenset(("dl",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}


_IN_TABLE = frozenset("table caption thead tbody tfoot tr td th body html".split())
_CELL = frozenset(("table", "td", "th"))


class _Page:
    """Node lists of some pages; columns, not objects."""

    def __init__(self) -> None:
        # id, parent, tag, nth, text, gap, inner_from, number of attributes so far
        self.rows: list[tuple] = []
        self.last: list[int] = []
        self.inner_to: list[int] = []
        self.keys: list[str] = []
        self.values: list[str] = []
        self.offsets = [0]

    def add(self, html: str | None) -> None:
        rows, last, inner_to, keys = self.rows, self.last, self.inner_to, self.keys
        html = html or ""
        base, size = len(rows), len(html)
        stack = [(0, "", {})]  # node number, tag, tags of its children so far
        open_tags: dict[str, list[int]] = {}  # places in the stack, so that closing needs no walk
        gap = False  # a block has begun or ended since the last words
        pos = 0

        def pop(at):
            number, tag, _ = stack.pop()
            open_tags[tag].pop()
            last[base + number - 1] = len(rows) - base
            inner_to[base + number - 1] = at

        def highest(tags):
            """Place of the innermost open element with one of the tags; 0 if there is none."""
            return max((open_tags[t][-1] for t in tags if open_tags.get(t)), default=0)

        def words(start, stop):
            nonlocal gap
            text = html[start:stop]
            number = len(rows) - base + 1
            parent, _, seen = stack[-1]
            seen["#text"] = nth = seen.get("#text", 0) + 1
            if "&" in text:
                text = unescape(text)
            rows.append((number, parent, "#text", nth, text, gap, 0, len(keys)))
            last.append(number)
            inner_to.append(0)
            if gap and not text.isspace():
                gap = False

        while pos < size:
            hit = _TOKEN.search(html, pos)
            if hit is None:
                words(pos, size)
                break
            begin, end = hit.span()
            if begin > pos:
                words(pos, begin)
            pos = end
            closing, tag, inside = hit.groups()
            if closing:
                closing = closing.lower()
                gap = gap or closing in _BLOCK
                depth = highest((closing,))
                if depth and (closing in _IN_TABLE or highest(_CELL) <= depth):
                    while len(stack) > depth:
                        pop(begin)
            elif tag:
                tag = tag.lower()
                gap = gap or tag in _BLOCK or tag == "br"
                if tag in _ENDS:
                    closes, until = _ENDS[tag]
                    depth = highest(closes)
                    if depth > highest(until):
                        while len(stack) > depth:
                            pop(begin)
                if inside:
                    attrs: dict[str, str] = {}
                    for name, quoted, single, bare in _ATTR.findall(inside):
                        value = quoted or single or bare
                        attrs.setdefault(name.lower(), unescape(value) if "&" in value else value)
                    keys.extend(attrs)
                    self.values.extend(attrs.values())
                number = len(rows) - base + 1
                parent, _, seen = stack[-1]
                seen[tag] = nth = seen.get(tag, 0) + 1
                rows.append((number, parent, tag, nth, None, gap, end, len(keys)))
                last.append(number)
                inner_to.append(end)
                if tag in _VOID:
                    continue
                open_tags.setdefault(tag, []).append(len(stack))
                stack.append((number, tag, {}))
                if tag in _RAW:
                    close = _RAW[tag].search(html, end)
                    stop = close.start() if close else size
                    pos = html.find(">", stop) + 1 or size
                    if tag not in _NO_TEXT and stop > end:
                        words(end, stop)
                    pop(stop)
        while len(stack) > 1:
            pop(size)
        self.offsets.append(len(rows))

    def array(self) -> pa.Array:
        ids, parent, tag, nth, text, gap, inner_from, attr_ends = zip(*self.rows) if self.rows else [()] * 8
        attrs = pa.MapArray.from_arrays(
            pa.array((0, *attr_ends), pa.int32()),
            pa.array(self.keys, pa.string()),
            pa.array(self.values, pa.string()),
        )
        fields = {
            "id": pa.array(ids, pa.int32()),
            "parent": pa.array(parent, pa.int32()),
            "last": pa.array(self.last, pa.int32()),
            "tag": pa.array(tag, pa.string()),
            "nth": pa.array(nth, pa.int32()),
            "attrs": attrs,
            "text": pa.array(text, pa.string()),
            "gap": pa.array(gap, pa.bool_()),
            "inner_from": pa.array(inner_from, pa.int32()),
            "inner_to": pa.array(self.inner_to, pa.int32()),
        }
        nodes = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), nodes)


# The code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.arrow_udf(returnType=NODES_TYPE)
def _shred(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = _Page()
        for html in batch:
            out.add(html.as_py())
            if len(out.rows) >= _NODES_PER_ARRAY:
                yield out.array()
                out = _Page()
        yield out.array()


# Not declared deterministic, so a filter on extracted fields does not run the shredder twice.
_shred = _shred.asNondeterministic()


def shred(html: Column | str) -> Column:
    """Nodes of a page; null and empty pages give an empty array."""
    return _shred(col(html))


def with_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with a ``nodes`` column.

    Put anti joins and filters on ``pages`` before this call: they then run below the shredder.
    """
    return pages.withColumn("nodes", shred(html))


def explode_nodes(shredded: DataFrame, *keep: str) -> DataFrame:
    """One row per node, with the named page columns."""
    return shredded.select(*keep, F.inline("nodes")).withColumnRenamed("id", "node_id")
