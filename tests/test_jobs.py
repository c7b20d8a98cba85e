import random

import pytest

from cardfile.functions import selectors as sel
from cardfile.plans import jobs
from cardfile.streaming import incremental as inc
from cardfile.streaming.seen import FirstRows


def test_clean_leads(spark):
    rows = [
        (1, "Ann", "5 years of trust", "(305) 555-0001"),
        (2, "Bob", "Undefined", "305.555.0001"),  # the same phone
        (3, "Cid", "Fine Homes", "555"),
        (4, "", "compass", "13055550002"),
        (5, "Eve", " fine   HOMES", "3055550003"),
        (6, "Fay", "Fine Homes", "3055550004"),
    ]
    df = spark.createDataFrame(rows, "`ord` int, `Agent Name` string, `Business Name` string, `Phone` string")
    out = jobs.clean_leads(df, "ord", text_column="Business Name")
    got = {k: [tuple(r) for r in v.orderBy("ord").collect()] for k, v in out.items()}
    assert got["clean"] == [
        (1, "Ann", "Ann", "+13055550001"),
        # "Business Name" is the last column with "name" in it, so the bad name is its own stand-in
        (4, "", "compass Realtors", "+13055550002"),
        (5, "Eve", "fine   HOMES", "+13055550003"),
        (6, "Fay", "Fine Homes", "+13055550004"),
    ]
    assert [r[0] for r in got["unique"]] == [1, 4, 5] and [r[0] for r in got["duplicates"]] == [6]
    assert out["unique"].columns == df.columns
    with pytest.raises(ValueError):
        jobs.clean_leads(df.drop("Agent Name"), "ord")


def test_names_without_agent_column(spark):
    df = spark.createDataFrame([("compass",), ("x" * 50,)], "Company string")
    assert [r[0] for r in jobs.fix_business_names(df).collect()] == ["", "x" * 40]
    with pytest.raises(ValueError):
        jobs.fix_business_names(df.withColumnRenamed("Company", "c"))


def test_match_deliverable(spark):
    leads = spark.createDataFrame(
        [(1, "b@x.com; a@x.com"), (2, "c@x.com"), (3, None), (4, "A@X.com,b@x.com")], "ord int, Emails string"
    )
    status = spark.createDataFrame(
        [("A@x.com ", "DELIVERABLE"), ("b@x.com", "Undeliverable"), ("c@x.com", None)],
        "`Email address` string, `Validation Status` string",
    )
    assert sorted(tuple(r) for r in jobs.match_deliverable(leads, status, "ord").collect()) == [
        (1, "a@x.com"), (4, "a@x.com"),
    ]
    bad = jobs.match_deliverable(leads, status, "ord", status="undeliverable")
    assert sorted(tuple(r) for r in bad.collect()) == [(1, "b@x.com"), (4, "b@x.com")]


def test_flags(spark):
    df = spark.createDataFrame([(1, " Ann "), (2, None), (3, "bob"), (4, "Ann")], "ord int, `Business` string")
    known = spark.createDataFrame([("Ann",), ("Ann",), (None,), (" BOB",)], "n string")
    exact = jobs.flag_known_businesses(df, known, "ord").collect()
    assert [(r.ord, r.Matched) for r in exact] == [(4, True), (1, False), (2, False), (3, False)]
    loose = jobs.flag_known_businesses(df.select("Business", "ord"), known, "ord", exact=False).collect()
    assert [(r.ord, r.Status) for r in loose] == [(1, True), (2, True), (3, True), (4, True)]


def test_extract_profiles(spark):
    queue = spark.createDataFrame(
        [("a.com/1", ""), ("", "a.com/1"), ("", "a.com/2"), (" ", "a.com/3"), ("", "a.com/9")],
        "url string, link string",
    )
    pages = spark.createDataFrame(
        [(2, "https://a.com/1", "<h1>new"), (1, "https://a.com/1", "<h1>old"), (3, "https://a.com/3", "<h1>x"),
         (4, "https://a.com/9", "<h1>done")],
        "page_id int, url string, html string",
    )
    done = spark.createDataFrame([("https://a.com/9",)], "url string")
    got = jobs.extract_profiles(queue, pages, done, {"Name": sel.one("h1")}).select("url", "name", "status").collect()
    assert sorted(tuple(r) for r in got) == [
        ("https://a.com/1", "old", "Completed"), ("https://a.com/1", "old", "Completed"),
        ("https://a.com/2", "", "Failed"),
    ]


def first_places(sites, known):
    """Where each new target comes first; ``sites`` is a list of {page: [target, ...]}."""
    seen, found = set(known), []
    for site, pages in enumerate(sites):
        for page in sorted(pages):
            new = [t for t in dict.fromkeys(pages[page]) if t not in seen]
            seen.update(new)
            found += [(site, page, t) for t in new]
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_discover_agents(spark, seed):
    """All captured pages give links, each where it comes first."""
    rng = random.Random(seed)
    sites = [
        {p: [f"agent{rng.randrange(70)}" for _ in range(rng.randrange(3))] for p in range(1, rng.randrange(3, 25))}
        for _ in range(25)
    ]
    known = ["agent1", "agent2"]
    rows = [
        (f"https://s{s}.com", p, "".join(f'<a href="https://x.com/{t}#z">{t}</a>' for t in targets))
        for s, pages in enumerate(sites) for p, targets in pages.items()
    ]
    pages = spark.createDataFrame(rows, "website_url string, page int, html string")
    listed = spark.createDataFrame(
        [(i, f"s{i}.com") for i in range(25)] + [(99, " "), (98, "nothing"), (97, "s3.com")], "ord int, website_url string"
    )
    nothing = spark.createDataFrame([], "website_url string")
    old = spark.createDataFrame([(f"HTTPS://X.com/{k}",) for k in known], "agent_url string")
    out = jobs.discover_agents(listed, pages, nothing, old, "ord")
    got = sorted(
        (int(r.website_url[9:-4]), r.page_number, r.normalized_url[14:]) for r in out["links"].collect()
    )
    assert got == first_places(sites, known)
    assert [(r.ord, r.value) for r in jobs.usable_sites(listed)[1].collect()] == [(98, "https://nothing")]
    assert jobs.failed_sites(listed, pages, nothing, "ord").count() == 0
    near = jobs.discover_agents(listed, pages, nothing, old, "ord", max_pages=1)["links"]
    assert {r.page_number for r in near.collect()} == {1}
    total = out["counts"].filter("level = 3").first()
    assert total.links == len(got)
    nowhere = jobs.failed_sites(listed, pages.filter("website_url = 'https://s0.com'"), nothing, "ord")
    assert sorted(r.website_url for r in nowhere.collect()) == sorted(f"https://s{i}.com" for i in range(1, 25))
    finished = pages.select("website_url").distinct()
    assert jobs.discover_agents(listed, pages, finished, old, "ord")["links"].count() == 0


def test_runs_over_new_pages_give_what_one_run_gives(spark, tmp_path, monkeypatch):
    """Pages arrive in any order, a run is stopped before its ledger row, and a site comes back with earlier pages."""
    rng = random.Random(5)
    page = lambda links: "".join(f'<a href="https://x.com/{t}">{t}</a>' for t in links)
    rows = [
        (f"https://s{s}.com", p, page(f"agent{rng.randrange(12)}" for _ in range(rng.randrange(4))))
        for s in range(5) for p in range(1, 5)
    ] + [("https://unlisted.com", 1, page(["agent99"])), ("https://s1.com", None, page(["agent77"])), ("https://s2.com", 9, None)]
    rng.shuffle(rows)
    kind = "website_url string, page int, html string"
    listed = spark.createDataFrame([(i, f"s{i}.com") for i in range(5)], "ord int, website_url string")
    done = spark.createDataFrame([("https://s4.com",)], "website_url string")
    known = spark.createDataFrame([("https://X.com/agent1#a",), (None,)], "agent_url string")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = inc.file_stream(spark, source, spark.createDataFrame([], kind).schema)
        jobs.discover_incrementally(listed, stream, done, known, "ord", out, str(tmp_path / "check"))

    def found(links):
        return sorted((r.agent_url, r.website_url, r.page_number or 0, r.agent_name) for r in links.collect())

    assert jobs.discovered(spark, out)["links"].count() == 0
    half = len(rows) // 2
    spark.createDataFrame(rows[:half], kind).coalesce(1).write.mode("append").parquet(source)
    run()
    before = found(jobs.discovered(spark, out)["links"])
    spark.createDataFrame(rows[half:], kind).coalesce(1).write.mode("append").parquet(source)
    with monkeypatch.context() as m:
        m.setattr(FirstRows, "merge", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()
    assert found(jobs.discovered(spark, out)["links"]) == before
    for _ in range(2):
        run()
    now = jobs.discovered(spark, out)
    whole = jobs.discover_agents(listed, spark.createDataFrame(rows, kind), done, known, "ord")
    assert found(now["links"]) == found(whole["links"])
    assert sorted(map(str, now["counts"].collect())) == sorted(map(str, whole["counts"].collect()))
    assert set(before) - set(found(now["links"]))  # a later run did bring earlier places
