import random
import time

import pytest
from pyspark.sql import functions as F

from cardfile.functions import selectors as sel
from cardfile.functions.shred import explode_nodes, with_nodes
from cardfile.operators import links


def shredded(spark, *htmls):
    return with_nodes(spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string"))


def one_value(spark, html, expr):
    return shredded(spark, html).select(expr).first()[0]


def tree(spark, html):
    rows = explode_nodes(shredded(spark, html), "page_id").orderBy("node_id").collect()
    return [(r.node_id, r.parent, r.last, r.tag) for r in rows]


def test_null_and_empty_pages(spark):
    sizes = shredded(spark, None, "", "   ", "x").select(F.size("nodes")).collect()
    assert [r[0] for r in sizes] == [0, 0, 1, 1]


def test_tree(spark):
    assert tree(spark, "<div><p>a<b>c<br><p>d</div>e") == [
        (1, 0, 8, "div"), (2, 1, 6, "p"), (3, 2, 3, "#text"), (4, 2, 6, "b"), (5, 4, 5, "#text"),
        (6, 4, 6, "br"), (7, 1, 8, "p"), (8, 7, 8, "#text"), (9, 0, 9, "#text"),
    ]
    assert [t[3] for t in tree(spark, "<ul><li>a<li>b</ul></p><x/>")] == ["ul", "li", "#text", "li", "#text", "x"]
    nested = tree(spark, "<table><tr><td>a<table><tr><td>b</table><td>c<tr><td>d</table>")
    assert [t[1] for t in nested if t[3] == "td"] == [2, 6, 2, 11]


def test_end_tags_stay_in_their_cell(spark):
    got = tree(spark, "<p><table><tr><td>a</p>b</b><td>c</table>d</p>e")
    parent = {i: p for i, p, _, _ in got}
    tags = [t for *_, t in got]
    assert tags == ["p", "table", "tr", "td", "#text", "#text", "td", "#text", "#text", "#text"]
    # the table ends the paragraph, so the closing tag in the cell has nothing to close
    assert parent == {1: 0, 2: 0, 3: 2, 4: 3, 5: 4, 6: 4, 7: 3, 8: 7, 9: 0, 10: 0}
    got = tree(spark, "<b>x<table><tr><td>a</b>c</table>d</b>e")
    assert [p for _, p, _, t in got if t == "#text"] == [1, 5, 5, 1, 0]


def test_deep_nesting(spark):
    rows = shredded(spark, "<i>" * 5000 + "x" + "</i>" * 5000 + "<b>y</b>").select("nodes").first()[0]
    assert len(rows) == 5003 and rows[-2].tag == "b" and rows[-2].parent == 0


def test_anchors_and_headings_do_not_nest(spark):
    got = tree(spark, "<a href=/1>Ann<a href=/2>Bob</a><h1>x<h2>y</h2>z")
    assert [(t, p) for _, p, _, t in got] == [("a", 0), ("#text", 1), ("a", 0), ("#text", 3), ("h1", 0), ("#text", 5), ("h2", 0), ("#text", 7), ("#text", 0)]


def test_deep_scripts_have_no_text(spark):
    got = tree(spark, "<i>" * 600 + "<script>'<a href=/agent/9>x</a>'</script-x></script >end")
    assert [t for *_, t in got[600:]] == ["script", "#text"]


def test_junk_is_linear(spark):
    import time

    junk = ["<script>" + "</script" * 600_000, "<p><table><td>" + "<i>" * 200_000 + "<div>" * 200_000 + "</b>" * 200_000]
    start = time.perf_counter()
    assert all(r.n > 0 for r in shredded(spark, *junk).selectExpr("size(nodes) AS n").collect())
    assert time.perf_counter() - start < 60


def test_intervals_hold_on_junk(spark):
    rng = random.Random(2)
    parts = ["<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<li>", "<br>", "text ", "<", ">", '"', "<!--", "-->",
             "<script>", "</script>", "<td>", "<a href='x", "'>", "&amp;", "</", "<tr>", "=", "<![x["]
    pages = ["".join(rng.choices(parts, k=40)) for _ in range(300)]
    rows = shredded(spark, *pages).select("nodes").collect()
    for (nodes,) in rows:
        for at, n in enumerate(nodes, 1):
            assert n.id == at and n.parent < at <= n.last <= len(nodes)
            assert not n.parent or nodes[n.parent - 1].last >= n.last


def test_text_rules(spark):
    page = "<div id=a>one<br>two  <b>three</b>\n<p>four</p>five<script>no</script><!-- no --></div>"
    a = sel.one("div", sel.is_attr("id", "a"))
    assert one_value(spark, page, sel.node_text("nodes", a)) == "one\ntwo three\nfour\nfive"
    assert one_value(spark, page, sel.node_text("nodes", a, raw=True)) == "onetwo  three\nfourfive"
    assert one_value(spark, page, sel.node_text("nodes", sel.one("h1"))) == ""
    assert one_value(spark, "<p>a &lt; b&nbsp;</p>", sel.node_text("nodes", sel.one("p"))) == "a < b"


def test_attributes(spark):
    page = """<a HREF = 'x"y' Title="q&amp;r" disabled>1</a><a href=plain>2</a><a>3</a>"""
    got = shredded(spark, page).select(F.transform(sel.one("a").select("nodes"), lambda n: n["attrs"])).first()[0]
    assert got == [{"href": 'x"y', "title": "q&r", "disabled": ""}, {"href": "plain"}, {}]
    assert one_value(spark, page, sel.node_attr("nodes", sel.one("a"), "title")) == "q&r"
    assert one_value(spark, page, sel.node_attr("nodes", sel.one("b"), "title")) == ""


@pytest.mark.parametrize(
    "selector, ids",
    [
        (sel.one("a"), [3, 7, 11]),
        (sel.one("div", sel.has("class", "x")).inside("a"), [3, 7]),
        (sel.one("div").child("a"), [3, 11]),
        (sel.one("div").inside("div").inside("a"), [7]),
        (sel.one("*", sel.is_attr("id", "r")).child("div", sel.nth(2)), [10]),
        (sel.one("a", sel.starts("href", "http")), [7]),
        (sel.one("a", sel.has_text("deep")), [7]),
        (sel.one("a", sel.holds("i", sel.has_own_text("deep"))), [7]),
        (sel.one("a", sel.has_own_text("deep")), []),
    ],
)
def test_selectors(spark, selector, ids):
    page = (
        "<section id=r><div class='x'><a href=/1>t</a><div><p><a href=http://2><i>deep</i></a></div></div>"
        "<div><a>z</a></div></section>"
    )
    got = shredded(spark, page).select(F.transform(selector.select("nodes"), lambda n: n["id"])).first()[0]
    assert got == ids


def test_area_and_parts(spark):
    page = "<body><main><h2>B</h2><h1> A </h1><p></p><p>x<img alt=i src=s></p> <a href=u>l</a></main></body>"
    got = shredded(spark, page).select(F.inline(F.array(sel.area("nodes", "html", sel.one("main"))))).first()
    assert got.area_html == page[12:-14] and got.element_count == 6
    assert got.area_text == "B\nA\nx\nl"
    gone = shredded(spark, page).select(F.inline(F.array(sel.area("nodes", "html", sel.one("nav"))))).first()
    assert tuple(gone) == ("", "", 0)
    parts = shredded(spark, page).select(*[c.alias(n) for n, c in sel.page_parts("nodes").items()]).first()
    assert parts.main_text == "B\nA\nx\nl"
    assert parts.all_links == ["l -> u"] and parts.all_images == ["i -> s"]
    assert parts.headings == ["h1: A", "h2: B"] and parts.paragraphs == ["x"]


def test_link_ranks(spark):
    page = "<div class='my-agent'><a href=/p>x</a></div><a href=/agent/1>y</a><a href=/q><b>Realtor</b></a><a>no</a>"
    rows = links.page_links(shredded(spark, page), "page_id").collect()
    assert [(r.href, r.label, r.rule_rank) for r in rows] == [
        ("/p", "x", 6), ("/agent/1", "y", 1), ("/q", "Realtor", 9),
    ]
    assert links.page_links(shredded(spark, page), "page_id", rules=[]).filter("rule_rank is null").count() == 3


def test_phone_falls_back_to_any_tel_link(spark):
    rows = shredded(spark, "<a href='tel: 305 1'>call</a>", "<p>none</p>")
    got = links.profile_fields(rows, links.OVERVIEW_PROFILE, "page_id").orderBy("page_id").collect()
    assert [r.phone for r in got] == ["305 1", ""]


def test_output_arrays_are_cut(spark):
    pages = spark.range(40).select(
        F.col("id").alias("page_id"), F.repeat(F.lit("<p>x"), 2000).alias("html")
    )
    assert with_nodes(pages.coalesce(1)).agg(F.sum(F.size("nodes"))).first()[0] == 40 * 4000


def test_shredder_runs_once_per_page(spark):
    df = links.profile_fields(shredded(spark, "<h1>x</h1>"), {"Name": sel.one("h1")}, "page_id").filter("name <> ''")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_offsets_count_characters(spark):
    page = "<p>😀é</p><main> 😀<b>x</b>é </main>😀"
    got = shredded(spark, page).select(F.inline(F.array(sel.area("nodes", "html", sel.one("main"))))).first()
    assert (got.area_html, got.area_text, got.element_count) == ("😀<b>x</b>é", "😀xé", 1)


def test_same_tags_and_words_as_the_standard_parser(spark):
    """Tags, attributes and words of whole captured pages, in document order."""
    from html.parser import HTMLParser

    class Standard(HTMLParser):
        def __init__(self):
            super().__init__()
            self.tags, self.words, self.quiet = [], [], False

        def handle_starttag(self, tag, attrs):
            self.tags.append((tag, {k: v or "" for k, v in attrs}))
            self.quiet = tag in ("script", "style")

        def handle_endtag(self, tag):
            self.quiet = False

        def handle_data(self, data):
            if not self.quiet:
                self.words.append(data)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for html, nodes in with_nodes(pages).select("html", "nodes").collect():
        standard = Standard()
        standard.feed(html)
        standard.close()
        assert [(n.tag, n.attrs) for n in nodes if n.tag != "#text"] == standard.tags
        assert "".join(n.text for n in nodes if n.tag == "#text") == "".join(standard.words)


def test_steps_below_nested_nodes(spark):
    """Nodes found by several of nested ones come once and in order; children are those of any of them."""
    html = "<div id=1><p>a</p><div id=2><p>b</p><ul><p>c</p></ul></div><p>d</p></div><div id=3><p>e</p></div><p>f</p>"
    df = with_nodes(spark.createDataFrame([(html,)], "html string"))
    texts = lambda s: df.select(sel.all_text("nodes", s)).first()[0]
    assert texts(sel.one("div").inside("p")) == ["a", "b", "c", "d", "e"]
    assert texts(sel.one("div").child("p")) == ["a", "b", "d", "e"]
    assert texts(sel.one("ul").child("p")) == ["c"]
    assert texts(sel.one("div", sel.is_attr("id", "9")).child("p")) == []


def test_links_of_a_page_cost_their_number(spark):
    """Sixteen thousand links with every rule to try: with each looked up among all others this took minutes."""
    body = "".join(f'<div class="agent"><a href="/agent/{i}">Agent <b>{i}</b></a></div>' for i in range(16_000))
    df = with_nodes(spark.createDataFrame([(1, body)], "page_id int, html string"))
    start = time.monotonic()
    got = links.page_links(df, "page_id").selectExpr("count(*)", "sum(rule_rank)", "max(label)").first()
    assert tuple(got) == (16_000, 16_000, "Agent 9999") and time.monotonic() - start < 60


def test_next_address(spark):
    page = lambda url, n, html: (url, n, html)
    rows = [
        page("https://a.com/l?p=1", 1, "<a href='?p=2'>Next</a>"), page("https://a.com/l", 1, "<a href='/l'>Next</a>"),
        page("https://a.com/page/x", 3, "<a href=/7>4</a>"), page("https://a.com/page/x", 3, "<a href=/page/x>4</a>"),
        page("https://a.com/page/x", 3, None), page("https://a.com/d/e/", 1, "<a title=Next href=../f#g>&gt;</a>"),
    ]
    df = with_nodes(spark.createDataFrame(rows, "url string, n int, html string"))
    got = [tuple(r) for r in links.next_address(df, "url", "n").collect()]
    assert got == [
        ("https://a.com/l?p=2", "link"), ("https://a.com/l/page/2/", "address"), ("https://a.com/7", "number"), (None, None),
        (None, None), ("https://a.com/d/f#g", "link"),
    ]
