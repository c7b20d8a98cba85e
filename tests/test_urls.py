import random
import re

import pytest

from cardfile.functions import urls


@pytest.mark.parametrize(
    "url, shaped, valid",
    [
        ("https://a.com", True, True),
        ("HTTP://A.COM:80/x?y=1", True, True),
        ("http://localhost:4040", True, True),
        ("http://10.0.0.1/x", True, True),
        ("http://a.com.", True, True),
        ("https://a.example", False, False),
        ("https://a.com/x y", False, False),
        ("https://a.com/#top", True, False),
        ("https://a.com/b.PDF", True, False),
        ("https://a.com/b.pdfx", True, True),
        ("https://a.com?u=mailto:x", True, False),
        ("ftp://a.com", False, False),
        ("https://-a.com", False, False),
        ("https://a-.com", False, False),
        ("https://" + "a" * 63 + ".com", True, True),
        ("https://" + "a" * 64 + ".com", False, False),
        ("https://a..com", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_valid(values, url, shaped, valid):
    assert values(lambda c: urls.is_valid_url(c, exclusions=False), [url]) == [shaped]
    assert values(urls.is_valid_url, [url]) == [valid]


def test_shape_equals_one_pattern(values):
    """The label tests together accept what a single pattern for the whole address accepts."""
    # Fixed value: the shape of a usable address.
    whole = re.compile(
        r"https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost"
        r"|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$",
        re.IGNORECASE,
    )
    rng = random.Random(5)
    tokens = ["a.", "b1.", ".com", ".com", "-", ".", "1", "22.", ":8", "/", "?q", " ", "localhost", "a" * 62, ".museums"]
    inputs = [
        rng.choice(["http://", "HTTPS://"]) + "".join(rng.choices(tokens, k=rng.randrange(1, 9)))
        for _ in range(3000)
    ]
    expected = [whole.match(u) is not None for u in inputs]
    assert 50 < sum(expected) < 2900
    assert values(lambda c: urls.is_valid_url(c, exclusions=False), inputs) == expected


def test_many_labels_do_not_overflow(values):
    assert values(urls.is_valid_url, ["http://" + "a." * 50_000 + "com/x"]) == [True]


def test_rewrites(values):
    assert values(urls.ensure_scheme, [" a.com ", "HTTP://a.com", "https://a.com", "", None]) == [
        "https://a.com", "https://HTTP://a.com", "https://a.com", "", "",
    ]
    cases = {
        "HTTPS://Ex.COM/Path?Q=1#f": "https://ex.com/Path?Q=1",
        "https://ex.com/p?": "https://ex.com/p",
        "https://ex.com?a?": "https://ex.com?a?",
        "/Rel/X#y": "/Rel/X",
        "MAILTO:Me@X.com": "mailto:Me@X.com",
        "//Host/P": "//host/P",
        "Plain": "Plain",
        " \t\x01HTTP://X.com/a\nb c ": "http://x.com/ab c ",
        "": "",
    }
    assert values(urls.normalize_url, list(cases)) == list(cases.values())
    resolved = {"/x": "https://ex.com/x", "//h/x": "https://h/x", "x": "x", "#a": "#a"}
    base = "https://ex.com/a/b?c#d"
    assert values(lambda c: urls.resolve(urls.F.lit(base), c), list(resolved)) == list(resolved.values())


def test_page_url(values):
    cases = {
        "http://a.com/l?page=1&x=2": "http://a.com/l?page=7&x=2",
        "http://a.com/l?x=2&p=1": "http://a.com/l?x=2&p=7",
        "http://a.com/l?p=1&page=3": "http://a.com/l?p=1&page=7",
        "http://a.com/l?xp=1": "http://a.com/l?xp=1/page/7/",
        "http://a.com/l/": "http://a.com/l/page/7/",
        "http://a.com/l#top": "http://a.com/l#top/page/7/",
        "http://a.com/page/2": None,
        "http://a.com/l?page=": None,
    }
    assert values(lambda c: urls.page_url(c, 7), list(cases)) == list(cases.values())
    pages = values(lambda c: urls.page_urls(c, 20), ["http://a.com/"])[0]
    assert [p["page"] for p in pages] == list(range(2, 21))


def test_agent_links(spark):
    rows = [
        ("/agents/1", "", True), ("/x", "Meet us", True), ("/x", "Home", False),
        ("/AGENT/Login", "", False), ("/team/", None, True), ("/x", "BIO", True),
    ]
    df = spark.createDataFrame(rows, "h string, t string, want boolean")
    assert df.filter(urls.is_agent_link("h", "t") != df["want"]).count() == 0


def test_dot_segments(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    hrefs = ["/p/../q", "/./a/./b", "/../../x", "/a/b/..", "/a/.", "/a//b/../c?x=/../y#/../z", "//h.com/p/../q", "//h.com", "/..a/.b", "/"]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(hrefs)], "i int, h string")
    got = rows.select("i", urls.resolve(F.lit("https://x.com/a"), "h").alias("u")).orderBy("i").collect()
    assert [r.u for r in got] == [urljoin("https://x.com/a", h) for h in hrefs]


def test_repeated_page_parameters(values):
    cases = {
        "http://a.com/l?page=1&page=2": "http://a.com/l?page=3",
        "http://a.com/l?x=1&page=1&y&page=&z=&page=9#page=4": "http://a.com/l?x=1&page=3&y&z=#page=4",
        "http://a.com/l?pages=1&p=2": "http://a.com/l?pages=1&p=3",
    }
    assert values(lambda c: urls.page_url(c, 3), list(cases)) == list(cases.values())
