"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for all operators."""

import gzip
import random
import re
import time
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_llm_queries import base_spans

import corpus_pipeline
from cardfile.llm import chat, mixing, passages, pii, quality, simhash, site_templates, tiling, url_lists, warc
from cardfile.llm.catalog import QUERIES

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns with the names that the operators use inside, and in another case.
CLASH = ["Key", "row", "fp", "root", "size", "due", "copies", "spans", "_row", "_words", "rejected_by", "TURNS", "first"]
PROSE = (
    "The council met on Tuesday to talk about the old bridge over the river. Several members said that repairs cannot "
    "wait for another winter, while others asked where the money would come from.\nA small group of shop owners had "
    "written a letter, which the clerk read aloud before the vote was taken. After two hours the chair closed the meeting "
    "and promised a full report by the end of the month, with costs, dates and names of the firms that had made offers."
)


def rows_of(spark, rows, columns=COLUMNS, clash=True):
    df = spark.createDataFrame(rows, columns)
    for i, name in enumerate(CLASH if clash else ()):
        df = df.withColumn(name, F.lit(f"x{i}"))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    long_text = " ".join(f"w{i}" for i in range(60_000)) + " " + "a" * 100_000 + " +" * 5_000
    texts = [None, "", " \n\t ", "one", PROSE, PROSE, PROSE.replace("Tuesday", "Monday"), long_text, "1.2.3." * 20_000]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None) for i, t in enumerate(texts)]
    return rows_of(spark, [*rows, rows[4], (None, PROSE, "en", "s", 5), (None, None, None, None, None)]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return rows_of(spark, [])


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (None, "short")], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return str(folder)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, empty, sf, name, stage):
    out = stage(spark, odd, sf)
    assert out.columns[: len(odd.columns)] == odd.columns or name == "source_mix"
    assert out.count() <= odd.count() * 3
    assert stage(spark, empty, sf).count() == 0


def test_quality(spark, odd):
    good = quality.keep_good(odd)
    assert {r.text for r in good.collect()} == {PROSE, PROSE.replace("Tuesday", "Monday")}
    assert good.count() == 5  # repeated rows are judged alike
    base = {r.doc_id: r for r in quality.with_base(odd.select("doc_id", "text")).collect()}
    assert (base[0].n_words, base[0].base_failed) == (0, True)
    assert base[7].n_words == 65_001
    rows = spark.createDataFrame([(1, "a b c x a b c\n\nb\nb \nb\r\nb")], "doc_id int, text string")
    r = quality.with_base(rows).first()
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.word_chars) == (11, 6 + 4, 1, 11)


def test_order_follows_cost_and_selectivity(spark):
    rows = spark.createDataFrame([(i, f"{'x' if i % 2 else 'y'}{i}") for i in range(20)], "doc_id int, text string")
    slow = quality.Rule("slow", lambda f: F.sha2(F.repeat(f.text, 20_000), 512).isNull())
    half = quality.Rule("half", lambda f: f.text.startswith("x"))
    assert [x["rule"].name for x in quality.measure(rows, (slow, half))] == ["half", "slow"]
    assert quality.quality_cascade(rows, (slow, half)).where("rejected_by = 'half'").count() == 10


def test_simhash(spark, odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    blank = {r.component_id for r in got if r.fingerprint == 0}
    assert blank == {0}
    kept = [r.doc_id for r in simhash.drop_near_duplicates(odd).collect()]
    assert sorted(kept) == sorted({r.component_id for r in got})
    assert simhash.near_duplicates(empty).count() == 0


def test_tiles():
    assert tiling.tiles([1, 2, 3, 4, 5, 6], [4, 5, 6, -1, 1, 2, 3], 3) == [(3, 0, 3), (0, 4, 3)]
    assert tiling.tiles([1, 2, 3, 4], [1, 2, 3, 4, 1, 2, 3, 4], 2) == [(0, 0, 4)]
    assert tiling.tiles([1, 1, 1, 1], [1, 1, 1], 2) == [(0, 0, 3)]
    assert tiling.tiles([], [1], 2) == []


def test_reordered_passage_is_a_leak(spark):
    words = [f"w{i}" for i in range(40)]
    moved = " ".join(words[25:] + ["and"] + words[:12] + ["so"] + words[12:25])
    docs = rows_of(
        spark,
        [(1, "Before " + moved.upper() + "!", "", "", 0), (1, "Before " + moved.upper() + "!", "", "", 0),
         (2, " ".join(words[:30]), "", "", 0), (3, None, "", "", 0), (None, ", ".join(words), "", "", 0)],
    )
    benchmark = spark.createDataFrame(
        [(7, " ".join(words)), (9, " ".join(words).upper()), (8, None), (6, "w1 w2")], "item_id bigint, text string"
    )
    got = {(r.doc_id, r.item_id, r.covered_words, r.n_tiles) for r in tiling.leaks(docs, benchmark).collect()}
    assert got == {(1, 7, 40, 3), (None, 7, 40, 1)}
    assert tiling.leaks(docs, benchmark).count() == 2
    assert sorted(r.doc_id for r in tiling.decontaminate(docs, benchmark).collect()) == [2, 3]
    assert tiling.leaks(docs, benchmark.limit(0)).count() == 0


NUMBERS = [
    "a@b.c_d@e.f x@@y.z q.w+e-r@host-1.co.uk. a@b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.1.1 9999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 12345 4111111111111111 0" * 3, "+49 (30) 123-456.78 +1 +12 345 + 123456789 +123456789-",
    "é😀 a@b.co 😀 10.0.0.1😀+1 555 123 4567", "", "no data here", "mail me: jane at example dot org or (030) 123 456 78",
]


def test_personal_data(spark, odd, empty):
    rows = spark.createDataFrame(list(enumerate(NUMBERS)), "doc_id int, text string")
    for r in pii.find_spans(rows).collect():
        base = [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans if s.base]
        assert base == base_spans(NUMBERS[r.doc_id])
    found = {r.doc_id: r.spans for r in pii.find_spans(odd).collect()}
    assert {k for k, s in found.items() if s} == {8}
    assert [(pii.KINDS[s.kind], s.start, s.end) for s in found[8]] == base_spans("1.2.3." * 20_000)
    clean = pii.redact(spark.createDataFrame([(1, "😀 x a.b@c.de, 4111111111111111!", 9)], "doc_id int, text string, n_chars int"))
    r = clean.first()
    assert (r.text, r.n_chars) == ("😀 x [EMAIL], [CARD]!", len("😀 x [EMAIL], [CARD]!"))
    assert [r.doc_id for r in pii.redact(odd).exceptAll(odd).collect()] == [8]


def test_prose_is_not_proposed(spark):
    texts = ["She looked at that. The end", "meet at noon.Then go", "jane (at) example.org", "jane at example dot org", "a @ b.co"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    proposed = rows.select("doc_id", F.explode(pii.spans_of(F.col("text"))).alias("s")).where("s.kind = 0 and s.label is null")
    assert {r.doc_id for r in proposed.collect()} == {2, 3, 4}


def test_trees_find_what_the_patterns_miss(spark):
    """Held-out: proposals without a label that look like the positive rows are added, checks that fail are not."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "4012 8888 8888 1881"]
    texts = [f"my card {c} thanks {i}" for i, c in enumerate(cards * 60)] + [f"order {4111111111111112 + 10 * i} sent" for i in range(100)]
    texts += ["my card 4012  8888  8888  1881 it is", "number 4012  8888  8888  1882 it is"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find_spans(rows).where("doc_id >= 340").collect()}
    assert got == {340: [(2, False)], 341: []}


def test_loose_forms_are_proposed_whole(spark):
    forms = {
        "202-555-0143": 3, "415 555 2671": 3, "(030) 123 456 78": 3, "4155552671": 3, "jane [at] corp.example.com": 0,
        "jane at corp dot example dot com": 0, "jane (at) mail (dot) corp.example.org": 0, "10 . 0 . 0 . 1": 1,
    }
    for word, label in (("call", {2}), ("order no.", {0})):
        rows = spark.createDataFrame([(f"{word} {x} now", x, k) for x, k in forms.items()], "text string, form string, wanted int")
        got = rows.select("*", F.explode(pii.spans_of(F.col("text"))).alias("s")).where("s.kind = wanted").collect()
        whole = {r.form: r.s.label for r in got if r.s.match == r.form}
        assert whole.keys() == forms.keys()
        assert {whole[x] for x, k in forms.items() if k == 3} == label


def test_planted_forms_are_caught_and_clean_texts_stay(spark):
    """Recall on rows whose form has no label of its own, precision on numbers of other kinds; steps and expression agree."""
    rng = random.Random(3)
    n = lambda k: "".join(rng.choice("23456789") for _ in range(k))
    filler = lambda: " ".join(rng.choice("the river bank was calm and grey that day".split()) for _ in range(6))
    phone = lambda: rng.choice([f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)} {n(3)} {n(4)}", f"({n(3)}) {n(3)}-{n(4)}"])
    mail = lambda: rng.choice([f"ann{n(2)} [at] corp.x{n(2)}.com", f"bob{n(2)}(at)x{n(3)}.org", f"eve{n(1)} at x{n(2)} dot net"])
    texts, kinds = [], []
    for _ in range(150):
        for text, kind in (
            (f"{filler()} call {phone()} {filler()}", 3), (f"{filler()} mail {mail()} {filler()}", 0), (f"reach +1 {n(3)} {n(3)} {n(4)} {filler()}", 3),
            (f"{filler()} order {phone()} {filler()}", None), (f"{filler()} version {n(2)} . {n(1)} . {n(1)} . {n(1)} {filler()}", None),
            (f"{filler()} isbn {n(10)} {filler()}", None), (f"{filler()} {n(10)} {filler()}", None), (filler(), None),
            (f"{filler()} {mail()} {filler()}", 0), (f"a{n(3)}@b{n(3)}.org {filler()}", 0),
        ):
            texts.append(text)
            kinds.append(kind)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: {s.kind for s in r.spans} for r in pii.find_spans(rows).collect()}
    wanted = [i for i, k in enumerate(kinds) if k is not None]
    assert sum(kinds[i] in found[i] for i in wanted) >= 0.9 * len(wanted)
    assert sum(bool(found[i]) for i, k in enumerate(kinds) if k is None) <= 0.02 * len(texts)
    steps = pii.with_spans(rows, F.col("text"), "s").select("doc_id", "s")
    assert steps.exceptAll(rows.select("doc_id", pii.spans_of(F.col("text")).alias("s"))).count() == 0


def test_trees_and_thresholds_come_from_all_labelled_rows(spark, monkeypatch):
    """More labelled rows than a bounded sample would take; a rare kind of row counts too."""
    learned, judged = [], []
    fitted, thresholds = pii._fitted, pii._thresholds
    monkeypatch.setattr(pii, "_fitted", lambda data, *a: (learned.append(data.agg(F.sum("weight")).first()[0]), fitted(data, *a))[1])
    monkeypatch.setattr(pii, "_thresholds", lambda rows: (judged.append(rows.where("s is not null").agg(F.sum("weight")).first()[0]), thresholds(rows))[1])
    feature = F.struct(*[F.when(F.lit(n == "digits"), F.col("id") % 16).otherwise(0).cast("double").alias(n) for n in pii.FEATURES])
    rows = spark.range(24_000).select("id", F.lit(0).alias("kind"), "id", (F.col("id") + 1).alias("end"), feature.alias("f"))
    rows = rows.toDF("id", "kind", "start", "end", "f").withColumn("label", (F.col("id") % 16 >= 5).cast("int"))
    score, least = pii.train(rows, rounds=2)
    assert max(learned) == judged[0] == 24_000 and sum(learned) == 3 * 24_000
    right = rows.where((score(F.col("f")) >= least[0] - 1e-6) == (F.col("label") == 1))
    assert right.count() == 24_000


def test_trees_are_trained_one_after_the_other(spark, monkeypatch):
    """Side by side the trainings' jobs took more memory than the driver has."""
    at_once, most = [], []

    def fitted(data, *a):
        at_once.append(1)
        most.append(len(at_once))
        time.sleep(0.3)
        at_once.pop()
        return lambda f: F.lit(0.5)

    monkeypatch.setattr(pii, "_fitted", fitted)
    feature = F.struct(*[F.lit(0.0).alias(n) for n in pii.FEATURES])
    rows = spark.range(60).select("id", F.lit(0).alias("kind"), F.lit(0).alias("start"), F.lit(1).alias("end"), feature.alias("f"))
    pii.train(rows.withColumn("label", (F.col("id") % 2).cast("int")))
    assert most == [1] * (1 + pii.FOLDS)


def test_text_of_many_spans(spark):
    """Spans over the bounds of chunks and blocks, some that overlap, in a text of more than a million characters."""
    text = "é 1.2.3.4@a.bc, +1 (234) 555-6789 " * 30_000
    new = pii.redact(spark.createDataFrame([(1, text, 0)], "doc_id int, text string, n_chars int")).first()
    assert new.text == "é [EMAIL], [PHONE] " * 30_000 and new.n_chars == len(new.text)


def test_mix(spark, odd, empty):
    out = mixing.mixed(odd).collect()
    assert sum(r.n_rows for r in out) == odd.count()
    assert all(r.copies == 0 for r in out if r["size"] == 0)
    assert mixing.mix(odd).columns == [c for c in odd.columns if c != "copies"] + ["copies"]
    assert mixing.mixed(empty).count() == 0
    # The first source takes 5 of 7 parts, but no more than three times its own size.
    two = rows_of(spark, [(i, "a b", "", "a" if i < 10 else "b", 0) for i in range(100)])
    target = {r.source: r.target for r in mixing.mixed(two).collect()}
    assert target == {"a": 60.0, "b": 140.0}


def test_tree_of_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    docs = rows_of(spark, [(i, "w " * (1 + i % 7), "", "ab"[i % 3 == 0], 0) for i in range(400)])
    out = mixing.mixed(docs).collect()
    for s in "ab":
        taken = sum(r.copies * r["size"] for r in out if r.source == s)
        assert abs(taken - next(r.target for r in out if r.source == s)) <= 7


def test_chat(spark):
    said = r"\b<turn user>\l </turn>" + "\n\\"
    rows = spark.createDataFrame(
        [(1, 1, "assistant", said), (1, 0, "user", None), (None, None, None, None), (1, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    ).withColumn("turns", F.lit(1)).withColumn("Layout", F.lit(2))
    out = chat.format_turns(chat.collect_turns(rows, "conv_id", "turn"))
    got = {r.conv_id: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("segments")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1].back] == [("user", ""), ("assistant", said), ("assistant", said)]
    assert got[1].loss == said * 2
    assert [tuple(t) for t in got[None].back] == [("", "")]
    assert chat.collect_turns(rows.limit(0), "conv_id", "turn").count() == 0


def test_layouts(spark):
    kinds = (
        "id int, prompt string, completion string, system string, instruction string, input string, output string, "
        "messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, other int"
    )
    none = [None] * 10
    put = lambda i, **x: tuple([i, *[x.get(c.split()[0]) for c in kinds.split(", ")[1:]]])
    rows = spark.createDataFrame(
        [
            put(1, prompt="p", completion="c", other=3),
            put(2, prompt="p", completion="c", system="s"),
            put(3, instruction="i", input="x", output="o"),
            put(4, instruction="i", output="o"),
            put(5, messages=[("user", "u"), ("assistant", None)]),
            put(6, conversations=[("human", "h"), ("gpt", "g")]),
            put(7, prompt="p"),
        ],
        kinds,
    )
    assert len(none) == len(rows.columns)
    got = {r.id: r.turns and [tuple(t) for t in r.turns] for r in chat.with_turns(rows).collect()}
    assert got == {
        1: [("user", "p"), ("assistant", "c")],
        2: [("system", "s"), ("user", "p"), ("assistant", "c")],
        3: [("user", "i\n\nx"), ("assistant", "o")],
        4: [("user", "i"), ("assistant", "o")],
        5: [("user", "u"), ("assistant", "")],
        6: [("user", "h"), ("assistant", "g")],
        7: None,
    }
    assert chat.with_fingerprint(rows).select("layout").distinct().count() == 7


def test_rows_with_more_fields_are_mapped(spark):
    kinds = "id int, text string, prompt string, completion string, messages array<struct<role:string,content:string>>"
    said = [("user", "u"), ("assistant", "a")]
    rows = spark.createDataFrame([(1, "extra", None, None, said), (2, None, "p", None, None), (3, "t", "p", "c", None), (4, None, None, None, None)], kinds)
    got = {r.id: r.turns and [tuple(t) for t in r.turns] for r in chat.with_turns(rows).collect()}
    assert got == {1: said, 2: None, 3: [("user", "p"), ("assistant", "c")], 4: [("", "")]}
    left = chat.unmapped(rows).collect()
    assert [(r.id, r.layout) for r in left] == [(2, chat.path_hash(["prompt"]))]
    deep = rows.where("id = 1").selectExpr("id", "struct(messages) AS data")
    mapping = chat.Mapping(
        "data", ("data.messages[].role",), lambda f: F.transform(f("data.messages"), lambda m: chat.turn(m["role"], m["content"])),
        ("data.messages[].content",),
    )
    assert [tuple(t) for t in chat.with_turns(deep, mappings=(mapping,)).first().turns] == said


PAGE = (
    "<html><head><title>t</title><script>a('</p>')</script></head><body class='has-sidebar'><header>Top</header><nav>N</nav>"
    "<div class='cookie-notice'>C</div><main><h1>A &amp; B</h1><p>one\n two<br>three<p>four <b>bold</b></p>"
    "<div id=share-buttons>S</div><ul><li>x<li>y</ul><form>F</form><aside>Q</aside>"
    "<section class='comments'><p>reader</section></main><footer>Z</footer><!-- c --></body></html>"
)


def test_main_text():
    assert site_templates.main_text(PAGE) == "A & B\none two three\nfour bold\nx\ny"
    assert site_templates.main_text("") == ""
    assert site_templates.main_text("plain &lt;text&gt;") == "plain <text>"
    assert site_templates.main_text("<p>a<script>b") == "a"
    junk = "<a " * 200_000
    assert site_templates.main_text(junk + "<p>x") == "x"
    assert site_templates.main_text("<i>" * 5_000 + "deep") == "deep"


def test_layout_names_drop_nothing():
    said = "<article><p>story</p></article>"
    for mark in ("class='content has-sidebar'", "class=no-sidebar", "id=page class=header-fixed", "class=sidebar", "class='related-work'"):
        assert site_templates.main_text(f"<body><div {mark}>{said}</div></body>") == "story"
    text = site_templates.main_text("<section class=related-work><p>a b c</p></section><div class='site-sidebar'>x</div><p>d e f</p>")
    assert text == "a b c\nd e f"
    assert site_templates.main_text("<div id=notice><p>most of the page</p></div><p>rest</p>") == "most of the page\nrest"
    comments = "<div id=comments><article class=comment-body><p>reader</p></article></div>"
    assert site_templates.main_text(f"<article><p>a longer story</p></article>{comments}") == "a longer story"


def test_text_outside_articles_is_read(spark):
    assert site_templates.main_text("<main><h1>Title</h1><p>text</p><article>card</article></main>") == "Title\ntext\ncard"
    page = "<div id=content><p>story {0}</p></div><p>menu</p><article>teaser {0}</article>"
    pages = spark.createDataFrame([(i, f"http://a.b/{i}", page.format(i)) for i in range(12)], "page_id int, url string, html string")
    assert {r.text for r in site_templates.extract(pages).collect()} == {f"story {i}\nteaser {i}" for i in range(12)}


def test_recurring_subtrees_go(spark):
    page = lambda host, i: f"<body><div><p>Welcome to {host}<p>always</div><p>text {i}</p><p>often</p></body>"
    rows = [(i, f"http://U@Big.example:80/{i}", page("big", i)) for i in range(12)]
    rows += [(20 + i, f"https://small.example/{i}", page("small", i)) for i in range(3)]
    rows += [(30, None, page("none", 1)), (31, "nonsense", None), (None, "http://big.example/x", ""), rows[0]]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("h")).withColumn("TEXT", F.lit(0))
    got = {r.page_id: (r.text, r.n_chars) for r in site_templates.extract(pages).collect()}
    assert got[3] == ("text 3", 6)
    assert got[21][0] == "Welcome to small\nalways\ntext 1\noften"
    assert got[30][0] == "Welcome to none\nalways\ntext 1\noften"
    assert got[31] == ("", 0) and got[None] == ("", 0)
    assert site_templates.extract(pages).count() == len(rows)
    assert site_templates.extract(pages.limit(0)).count() == 0


def test_different_pages_are_counted(spark):
    story = lambda i: f"<body><h1>Title {i}</h1><p>story {i}</p></body>"
    copies = [(i, f"http://copies.example/{i}", story(0)) for i in range(12)]
    again = [(20 + i, "http://again.example/x", story(0) + f"<p>seen {i} times</p>") for i in range(12)]
    some = [(40 + i, f"http://some.example/{i}", story(i) + "<p>section notice</p>" * (i < 8)) for i in range(20)]
    few = [(70 + i, f"http://few.example/{i}", story(i) + "<p>always</p>") for i in range(5)]
    pages = spark.createDataFrame(copies + again + some + few, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in site_templates.extract(pages).collect()}
    assert {got[i] for i, _, _ in copies} == {"Title 0\nstory 0"}
    assert [got[i] for i, _, _ in again] == [f"Title 0\nstory 0\nseen {i} times" for i in range(12)]
    assert [got[i] for i, _, _ in some] == [f"Title {i}\nstory {i}" for i in range(20)]
    assert [got[i] for i, _, _ in few] == [f"Title {i}\nstory {i}" for i in range(5)]


def test_url_lists(spark):
    at = lambda m, d: datetime(2024, m, d, 12)
    entries = spark.createDataFrame(
        [("host:x.org", "block", at(1, 10)), ("host:x.org", "allow", at(3, 5)), ("host:x.org", "allow", at(3, 5)),
         ("url:a.x.org/p", "allow", at(2, 1)), ("host:a.x.org", "block", at(3, 31)), (None, "block", at(1, 1)),
         ("host:y.org", "block", None)],
        "pattern string, action string, listed_on timestamp",
    )
    asked = [
        ("http://x.org/", at(1, 9), None), ("http://x.org/", at(1, 10), "block"), ("http://q.X.org:8/", at(2, 20), "block"),
        ("http://x.org/", at(3, 4), "block"), ("http://x.org/", at(3, 5), "allow"), ("http://x.org/", datetime(2031, 1, 1), "allow"),
        ("https://a.x.org/p/#f", at(2, 2), "allow"), ("https://a.x.org/q", at(2, 2), "block"), ("https://a.x.org/q", at(4, 1), "block"),
        ("http://y.org", at(5, 1), None), (None, at(5, 1), None), ("http://x.org/", None, None), ("junk", at(5, 1), None),
        ("http://notx.org/", at(2, 2), None),
    ]
    rows = [(i, u, t, w) for i, (u, t, w) in enumerate(asked)]
    captures = spark.createDataFrame([*rows, rows[1]], "page_id int, url string, fetched_at timestamp, month string")
    judged = url_lists.judge(captures, entries).collect()
    assert len(judged) == len(rows) + 1
    assert {r.page_id: r.list_action for r in judged} == {i: w for i, (_, _, w) in enumerate(asked)}
    assert url_lists.allowed(captures, entries).columns == captures.columns
    assert url_lists.judge(captures, entries.limit(0)).where("list_action is null").count() == len(rows) + 1
    assert url_lists.judge(captures.limit(0), entries).count() == 0


def test_lists_and_hosts_in_any_case(spark):
    at = datetime(2024, 1, 1)
    entries = spark.createDataFrame(
        [("url:http://Example.org/P/", "block", at), ("host:Shop.ORG", "block", at), ("note", "block", at)],
        "pattern string, action string, listed_on timestamp",
    )
    asked = ["http://example.org/P", "HTTP://EXAMPLE.org/P#x", "http://example.org/p", "http://a.SHOP.org/", "http://example.org?P"]
    captures = spark.createDataFrame([(u, at) for u in asked], "url string, fetched_at timestamp")
    got = {r.url: r.list_action for r in url_lists.judge(captures, entries).collect()}
    assert [got[u] for u in asked] == ["block", "block", None, "block", None]


def test_only_months_with_captures_are_filled(spark):
    entries = spark.createDataFrame([("host:x.org", "block", datetime(2024, 1, 10))], "pattern string, action string, listed_on timestamp")
    times = [datetime(2024, 1, 9), datetime(2024, 5, 1), datetime(9000, 1, 1), datetime(2, 1, 1)]
    captures = spark.createDataFrame([("http://x.org/", t) for t in times], "url string, fetched_at timestamp")
    got = {r.fetched_at: r.list_action for r in url_lists.judge(captures, entries).collect()}
    assert [got[t] for t in times] == [None, "block", "block", None]
    months = captures.select(F.lit("host:x.org").alias("pattern"), F.date_trunc("month", "fetched_at").alias("month"))
    assert url_lists.validity(entries, months).count() == 3
    assert url_lists.validity(entries).count() == 1


def test_archives(spark):
    large = "é<p>WARC/1.1\r\n\r\n" * 20_000
    rows = [(5, "u\r\nv", "same"), (3, None, "same"), (9, "u", large), (None, "u", "same"), (4, "u", None), (6, "u", ""), (7, "u", "x" * 64_000)]
    pages = spark.createDataFrame([*rows, rows[2], rows[0]], "page_id bigint, url string, html string").withColumn("ID", F.lit("q"))
    path = warc.write_archives(pages, segment=1_000)
    kinds = {r.type: r["count"] for r in warc.read_records(spark, path).groupBy("type").count().collect()}
    assert kinds["continuation"] > 700
    got = warc.read_captures(spark, path).collect()
    assert len(got) == len(rows) + 2 and not any(r.problem for r in got)
    by = {r.page_id: r for r in got}
    assert by[9].payload == large.encode() and by[9].payload_bytes == len(large.encode())
    assert (by[3].record_type, by[5].record_type, by[5].refers_to, by[5].payload_bytes) == ("response", "revisit", 3, 4)
    assert (by[None].record_type, by[None].refers_to) == ("revisit", 3)
    assert (by[4].record_type, by[6].record_type, by[6].refers_to) == ("response", "revisit", 4)
    assert by[5].url == "u%0D%0Av" and by[3].url is None
    assert warc.read_captures(spark, warc.write_archives(pages.limit(0))).count() == 0
    small = warc.read_captures(spark, warc.write_archives(pages, least_bytes=5)).where("payload_bytes = 4")
    assert {r.record_type for r in small.collect()} == {"response"}


def test_broken_segments_are_told(spark):
    path = warc.write_archives(spark.createDataFrame([(1, "u", "x" * 5_000)], "page_id bigint, url string, html string"), segment=1_000)
    records = warc.read_records(spark, path)
    assert warc.reassembled(records).first().problem is None
    assert warc.reassembled(records.where("segment <> 2")).first().problem == "segments are missing or repeated"
    assert warc.reassembled(records.where("segment < 5")).first().problem == "the length is not the total"
    assert warc.reassembled(records.union(records.where("segment = 3"))).first().problem == "segments are missing or repeated"


def _archive(tmp_path, name: str, content: bytes) -> str:
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.warc").write_bytes(content)
    return str(folder)


def test_archives_of_others(spark, tmp_path):
    """Version 1.0, plain line ends in headers, gzip by record, bodies without chunks, other digests and other records."""
    http = b"HTTP/1.0 200 OK\r\nX-Note: chunked\r\n\r\nbody"
    old = lambda kind, block, more=b"": (
        b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nwarc-target-uri: http://a.b/\r\n c\r\n" + more + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    )
    records = [
        old(b"warcinfo", b"software: x"), old(b"response", http, b"X-Page-Id: none\r\nWARC-Payload-Digest: md5:00\r\n"),
        old(b"request", b"GET / HTTP/1.0\r\n\r\n"), old(b"resource", b"a\r\n\r\nb").replace(b"\r\n\r\na", b"\n\na"),
    ]
    for name, content in (("plain", b"".join(records)), ("zipped", b"".join(gzip.compress(r) for r in records))):
        path = _archive(tmp_path, name, content)
        assert warc.read_records(spark, path).count() == 4
        got = warc.read_captures(spark, path).collect()
        assert {(r.record_type, bytes(r.payload), r.url, r.page_id, r.problem) for r in got} == {
            ("response", b"body", "http://a.b/ c", None, None), ("resource", b"a\r\n\r\nb", "http://a.b/ c", None, None),
        }


def test_damaged_archives_are_told(spark, tmp_path):
    whole = warc.record("resource", b"fine", {"X-Page-Id": 1}) + b"\r\n\r\n"
    last = warc.record("resource", b"0123456789", {"X-Page-Id": 2})
    no_length = b"WARC/1.1\r\nWARC-Type: resource\r\nX-Page-Id: 2\r\n\r\nx\r\n\r\n"
    too_long = b"WARC/1.0\r\nWARC-Type: resource\r\nX-Page-Id: 2\r\nContent-Length: 99999\r\n\r\nx\r\n\r\n"
    cases = [
        (whole + last[:-3], {(1, None), (2, "the block ends early")}),
        (whole + last[:-12], {(1, None), (2, "the header ends early")}),
        (no_length + whole, {(2, "there is no length"), (1, None)}),
        (no_length.replace(b"x\r", b"Content-Length: -4\r") + whole, {(2, "there is no length"), (1, None)}),
        (too_long + whole, {(2, "the block ends early"), (1, None)}),
        (b"\xffjunk\r\n" + whole, {(None, "there is no record at the start"), (1, None)}),
        (b"junk", {(None, "there is no record")}),
        (gzip.compress(whole) + gzip.compress(last)[:-4], {(1, None), (2, None), (None, "the compressed file ends early")}),
        (b"\x1f\x8bjunk", {(None, "the compression is broken")}),
        (b"", set()),
    ]
    for i, (content, wanted) in enumerate(cases):
        got = warc.read_captures(spark, _archive(tmp_path, str(i), content)).collect()
        assert all((r.payload is None) == (r.problem is not None) for r in got)
        found = {(r.page_id, r.problem) for r in got}
        assert found == wanted, (i, found)


def test_chunks():
    for size in (0, 1, 99, 100, 101, 1_000):
        data = bytes(range(256)) * 4
        assert warc.dechunked(warc.chunked(data[:size], 100)) == data[:size]
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_passages(spark, odd, empty):
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(80)]
    fuzzy = [("q" if i % 14 == 7 else w) for i, w in enumerate(passage)]
    docs = rows_of(
        spark,
        [(1, " ".join(words[:100] + passage + words[100:200]), "", "", 0), (2, " ".join(words[200:300] + fuzzy + words[300:400]), "", "", 0),
         (3, " ".join(words[200:240]), "", "", 0), (4, " ".join(passage).upper(), "", "", 0), (5, " ".join(passage).upper(), "", "", 0),
         (None, " ".join(passage), "", "", 0)],
    )
    got = {(r.doc_id, r.start_word, r.end_word, r.other_id, r.other_start, r.other_end) for r in passages.shared_passages(docs).collect()}
    assert got >= {(2, 100, 180, 1, 100, 180), (4, 0, 80, 1, 100, 180), (5, 0, 80, 4, 0, 80)}
    at = {1: (100, 180), 2: (100, 180), 4: (0, 80), 5: (0, 80)}
    assert all(at[x[0]] == x[1:3] and at[x[3]] == x[4:] for x in got)
    assert passages.shared_passages(empty).count() == 0
    # The same prose twice under one key and once without a key: no other text shares it, but for the one with another day.
    assert {(r.doc_id, r.other_id) for r in passages.shared_passages(odd).collect()} == {(5, 4), (6, 4)}


def test_passage_between_the_ends_of_its_seeds(spark):
    """Texts in the middle share a passage whose halves many other texts have, with the last word of a half edited too."""
    for n, edited in ((2, {}), (12, {}), (12, {29: "x"})):
        passage = [f"p{i}" for i in range(60)]
        rows = [(i, passage[:30] if i % 2 else passage[30:]) for i in [*range(n), *range(1000 - n, 1000)]]
        rows += [(500, passage), (600, [edited.get(i, w) for i, w in enumerate(passage)])]
        own = lambda i: [f"t{i}w{j}" for j in range(50)]
        docs = rows_of(spark, [(i, " ".join(own(i) + w + own(-i - 1)), "", "", 0) for i, w in rows])
        got = {(r.doc_id, r.start_word, r.end_word, r.other_id) for r in passages.shared_passages(docs).collect()}
        assert got == {(600, 50, 110, 500)}


def test_passage_of_many_texts_has_one_row_each(spark):
    rows = [(i, " ".join([f"t{i}w{j}" for j in range(20)] + [f"p{j}" for j in range(60)]), "", "", 0) for i in range(40)]
    got = passages.shared_passages(rows_of(spark, rows)).collect()
    assert {r.doc_id for r in got} == set(range(1, 40))
    assert len(got) < 120


def test_texts_of_hot_seeds_all_meet(spark, tmp_path, monkeypatch):
    """An edited passage whose seeds, also the paired ones, are in many texts before and after that have no such passage."""
    monkeypatch.setattr(passages, "BLOCK", 7)
    words = [f"p{i}" for i in range(60)]
    pieces = lambda i: [words[:30], words[30:], words[10:50], words[:20] + [f"u{i}_{j}" for j in range(20)] + words[40:]]
    rows = [(4 * i + j, w) for i in [*range(20), *range(1000, 1020)] for j, w in enumerate(pieces(i))]
    rows += [(500, words), (600, [f"x{i}" if i % 8 == 7 else w for i, w in enumerate(words)])]
    own = lambda i: [f"t{i}w{j}" for j in range(50)]
    docs = rows_of(spark, [(i, " ".join(own(i) + w + own(-i - 1)), "", "", 0) for i, w in rows], clash=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_substring_dedup"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(600, 500)}


def test_edited_passages_are_found(spark):
    rng, rows, planted = random.Random(5), [], 0
    for i, (words, changed) in enumerate([(60, 0.1), (60, 0.15), (100, 0.15), (100, 0.18)] * 50):
        passage = [f"p{i}_{j}" for j in range(words)]
        places = set(rng.sample(range(words), int(changed * words)))
        for doc, text in ((2 * i, passage), (2 * i + 1, [f"e{j}" if j in places else w for j, w in enumerate(passage)])):
            rows.append((doc, " ".join([f"a{doc}_{j}" for j in range(30)] + text + [f"b{doc}_{j}" for j in range(30)]), "", "", 0))
        planted += 1
    got = {r.doc_id for r in passages.shared_passages(rows_of(spark, rows)).collect()}
    assert got <= {2 * i + 1 for i in range(planted)}
    assert len(got) >= 0.97 * planted


def test_pairs_left_out_hold_no_passage():
    """Blocks of texts from few words, with lines and passages that come again and again, against all pairs of texts one by one."""
    rng, k = random.Random(3), 5
    lines = [[f"l{i}_{j}" for j in range(rng.randint(6, 70))] for i in range(8)]
    texts = []
    for _ in range(90):
        words = []
        for _ in range(rng.randint(1, 6)):
            line, kind = rng.choice(lines), rng.random()
            if kind < 0.3:
                words += [rng.choice(["a", "b", "c"]) for _ in range(rng.randint(1, 60))]
            elif kind < 0.4:
                words += ["z"] * rng.randint(1, 70)
            elif kind < 0.7:
                words += [w if rng.random() > rng.choice([0.05, 0.2]) else rng.choice("xyz") for w in line]
            else:
                words += line + [f"u{rng.random()}" for _ in range(rng.randint(0, 60))]
        texts.append(words)

    def block(part):
        names = sorted({w for i in part for w in texts[i]})
        at = {w: i for i, w in enumerate(names)}
        own = [part, [len(texts[i]) for i in part], pd.util.hash_array(np.array(names, dtype=object)), [at[w] for i in part for w in texts[i]]]
        row = {c: passages._planes(np.array(v).astype(t)) for c, v, t in zip(("docs", "sizes", "names", "ids"), own, ("<i8", "<i4", "<u8", "<u4"))}
        return passages._Block(row | dict.fromkeys(("later", "earlier", "p", "q"), b""), k)

    a, b = block(list(range(0, 90, 2))), block(list(range(1, 90, 2)))
    for one, two in ((a, a), (a, b), (b, a)):
        rows = lambda batches: {tuple(r.values()) for x in batches if x for r in x.to_pylist()}
        found = rows(passages.passages_between(one, two, k, 50, 0.8))
        every = passages._Rows(one.words if one is two else np.r_[one.words, two.words], k, 50, 0.8)
        none = np.zeros(0, dtype=np.int64)
        for d in range(len(one.docs)):
            for e in range(d if one is two else len(two.docs)):
                sides = (one, d, 0, two, e, 0 if one is two else len(one.words))
                every.add(*(sides if one.docs[d] > two.docs[e] else sides[3:] + sides[:3]), (none, none))
        assert len(found) > 100
        assert found == rows([every.batch()])


def test_texts_that_meet_are_not_shuffled(spark, tmp_path, monkeypatch):
    """A line that all texts have makes each two of them meet: no exchange has a row for that. The passage of two texts is found."""
    monkeypatch.setattr(passages, "BLOCK", 20)
    line, passage = [f"l{i}" for i in range(14)], [f"p{i}" for i in range(60)]
    own = lambda i: [f"t{i}w{j}" for j in range(30)]
    rows = [(i, " ".join(own(i) + line + own(-i - 1) + (passage if i in (30, 90) else []))) for i in range(120)]
    rows_of(spark, [(i, t, "", "", 0) for i, t in rows], clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op9_substring_dedup"](spark, str(tmp_path))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(90, 74, 134, 30, 74, 134, 1.0)]


def test_chains():
    x, y = list(range(0, 60, 4)) + [5, 9], list(range(100, 160, 4)) + [3, 500]
    found = [[(x[i], y[i]) for i in c] for c in passages.chains(x, y, 5)]
    assert found == [[(i, 100 + i) for i in range(0, 60, 4)]]
    a, b = [f"a{i}" for i in range(60)], [f"a{i}" for i in range(60)]
    b[31:33] = ["new", "words", "here"]
    assert list(passages.align(["x"] + a, b, [1, 11, 41], [0, 10, 41], 5)) == [(1, 61, 0, 61, 1 - 3 / 61)]
    b[20:45] = [f"b{i}" for i in range(70)]
    assert [p[:4] for p in passages.align(a, b, [0, 5, 46, 50], [0, 5, 92, 96], 5)] == [(0, 20, 0, 20), (44, 60, 90, 106)]
    assert passages.edits(list("kitten"), list("sitting")) == 3


def test_words_of_contract():
    assert re.findall(r"[^\x20\x09-\x0D]+", "a b\x1cc d") == ["a b\x1cc", "d"]
