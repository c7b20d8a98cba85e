"""A third of all rows share one key; results against plain Python, and what the plans do about it."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardfile.functions.text import dedup_key
from cardfile.operators import crawl, dedup, matching
from cardfile.session import bucketed

N = 6000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(N):
        hot = rng.random() < 0.34
        email = "hot@x.com" if hot else f"e{rng.randrange(4000)}@x.com"
        other = rng.choice(["", f"o{rng.randrange(3000)}@y.org", "hot@x.com", "junk"])
        out.append((i, " Hot  name" if hot else f"Name {rng.randrange(3000)}", f"{email}; {other}"))
    return out


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    df = spark.createDataFrame(rows, "ord long, name string, emails string")
    df.withColumn("pad", F.repeat(F.lit("x"), 300)).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def ids(df):
    return sorted(r[0] for r in df.select("ord").collect())


def test_split_first(table, rows):
    seen, first, rest = set(), [], []
    for i, name, _ in rows:
        key = " ".join(name.split()).lower()
        (rest if key in seen else first).append(i)
        seen.add(key)
    unique, duplicates = dedup.dedup_text(table, "name", "ord")
    assert ids(unique) == first and ids(duplicates) == rest
    assert ids(dedup.keep_first(table, dedup_key("name"), "ord")) == first
    assert unique.columns == table.columns


def addresses(cell):
    return [p for p in cell.replace(";", " ").split() if "@" in p]


def test_all_unique(table, rows):
    counts = Counter(a for _, _, cell in rows for a in addresses(cell))
    want = [i for i, _, cell in rows if all(counts[a] == 1 for a in addresses(cell))]
    assert ids(matching.all_unique(table, "emails", "ord")) == want
    got = {r.email: r.n for r in matching.email_counts(table, "emails").collect()}
    assert got == dict(counts)


def test_match_first(spark, table, rows):
    listed = {"hot@x.com", *(f"e{i}@x.com" for i in range(0, 4000, 3)), "junk"}
    emails = spark.createDataFrame([(f" {e.upper()}",) for e in listed] * 2 + [(None,)], "email string")
    want = {}
    for i, _, cell in rows:
        hits = [p.strip() for p in cell.split(";") if p.strip() in listed]
        if hits:
            want[i] = hits[0]
    got = matching.match_first(table, emails, "emails", "email", "ord")
    assert {r.ord: r.emails for r in got.collect()} == want
    assert got.columns == table.columns


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    rdd = qe.toRdd()
    rdd.count()
    return qe.executedPlan().toString()


@pytest.fixture
def small_limits(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")


def lookups(spark, table):
    known = spark.range(4000).select(F.concat(F.lit("Name "), "id").alias("name"))
    hot = spark.createDataFrame([(" Hot  name",)] * 50, "name string")
    listed = spark.createDataFrame([("hot@x.com",)] * 50 + [(f"e{i}@x.com",) for i in range(3000)], "email string")
    return {
        "resume": matching.resume(table, known, "name"),
        "flag": matching.flag_exact(table, "name", known.unionByName(hot)),
        "flag_nulls": matching.flag_normalized(table.select("name", "ord", "pad"), known),
        "match": matching.match_first(table, listed, "emails", "email", "ord"),
        "new": matching.new_only(table, known, "name"),
    }


@pytest.mark.parametrize("name", ["resume", "flag", "flag_nulls", "match", "new"])
def test_hot_keys_are_split(spark, table, small_limits, name):
    assert "skew=true" in final_plan(lookups(spark, table)[name])


def test_small_lists_are_broadcast_without_a_shuffle(spark, table):
    known = spark.createDataFrame([(" Hot  name",)] * 1000, "name string")
    plan = matching.resume(table, known, "name")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_keep_first_limits_groups_before_the_shuffle(table):
    plan = dedup.keep_first(table, F.col("name"), "ord")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize("span, limit", [(1, 2), (5, 3), (60, 10)])
def test_quota_audit(spark, span, limit):
    rng = random.Random(span)
    times = [(rng.choice(["hot", "hot", None, "k1", "k2"]), rng.randrange(-10**8, 400 * 10**6, 50_000)) for _ in range(3000)]
    df = spark.createDataFrame(times, "key string, us long").select("key", F.timestamp_micros("us").alias("ts"))
    got = crawl.quota_audit(df, "key", "ts", limit=limit, window_s=span).collect()
    by_key = {}
    for key, us in times:
        by_key.setdefault(key, []).append(us)
    assert len(got) == len(set(times))
    for r in got:
        old = [u for u in by_key[r.key] if r.at_us - span * 10**6 < u < r.at_us]
        now = by_key[r.key].count(r.at_us)
        assert (r.requests, r.in_window) == (now, len(old))
        assert r.remaining == max(0, limit - len(old) - now)
        wait = span * 10**6 - (r.at_us - min(old)) + 10**6 if len(old) >= limit else 0
        assert r.wait_us == wait


def test_audit_reads_both_timestamp_types(spark):
    df = spark.sql("select 'a' key, timestamp'2024-05-01 10:00:00.25' ts, timestamp_ntz'2024-05-01 10:00:00.25' ntz")
    a, b = (crawl.quota_audit(df, "key", c, limit=1).first() for c in ("ts", "ntz"))
    assert a.at_us == b.at_us


def crawl_by_hand(attempts, max_pages=20, max_failures=2):
    """Walk through the attempts of a site in order and stop as a crawler would."""
    kept, row = [], 0
    for page, attempt, found in sorted(attempts):
        if row >= max_failures or page > max_pages:
            break
        kept.append((page, attempt))
        row = row + 1 if found is None or (found == 0 and page > 1) else 0
    return kept


def test_crawl_cutoff(spark):
    rng = random.Random(11)
    rows = []
    for site in range(200):
        for page in range(1, 41 if site == 0 else rng.randrange(2, 26)):
            attempt = 0
            while True:
                found = rng.choice([None, 0, 0, 1, 2, 3])
                rows.append((site, page, attempt, found))
                attempt += 1
                if found is not None or attempt > 5:
                    break
    df = spark.createDataFrame(rows, "site int, page int, attempt int, found int")
    got = {}
    for r in crawl.crawl_cutoff(df, "site", "page", "found", "attempt", max_pages=20).collect():
        got.setdefault(r.site, []).append((r.page, r.attempt))
    want = {s: crawl_by_hand([r[1:] for r in rows if r[0] == s]) for s in range(200)}
    assert {s: sorted(v) for s, v in got.items()} == want


def test_frontier_on_a_cycle(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("hub", "x")]
    links += [("a", None), (None, "z")] + [(f"p{i}", "hub") for i in range(500)] + [("d", f"p{i}") for i in range(500)]
    df = spark.createDataFrame(links, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    got = {r.url: r.hop for r in crawl.crawl_frontier(seeds, df, 5).collect()}
    want = {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, **{f"p{i}": 4 for i in range(500)}, "hub": 5}
    assert got == want
    assert len(crawl.crawl_frontier(seeds, df.filter("src = 'a'"), 50).collect()) == 2


def test_hops_shuffle_neither_links_nor_visited(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = bucketed(spark.range(5000).selectExpr("'u' || id as src", "0 as part", "'u' || (id + 1) as dst"), "links", n, "src", "part")
    seen = [bucketed(spark.range(k, k + 1).selectExpr("'u' || id as url"), "seen", n, "url") for k in (0, 1)]
    hubs = spark.createDataFrame([], "url string, parts int")
    hop = crawl._next_hop(links, hubs, seen[1], seen)
    assert [r.url for r in hop.collect()] == ["u2"]
    plan = hop._jdf.queryExecution().executedPlan().toString()
    # The list of hubs, then the frontier on its way to the links, then what it reaches, to be made distinct.
    assert sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == ["src", "url", "url"] and plan.count("Exchange") == 3


def test_links_are_neither_repeated_nor_sorted_by_a_hop(spark, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    held, hop = [], crawl._next_hop

    def kept(links, *rest):
        out = hop(links, *rest)
        plan = out._jdf.queryExecution().executedPlan().toString()
        held.append((links.count(), re.findall(r"Sort \[(\w+)#", plan)))
        return out

    monkeypatch.setattr(crawl, "_next_hop", kept)
    links = spark.range(3000).selectExpr("'u' || id % 30 as src", "'u' || (id % 30 + 1) as dst")
    got = crawl.crawl_frontier(spark.createDataFrame([("u0",)], "url string"), links, 3)
    assert {r.url: r.hop for r in got.collect()} == {f"u{i}": i for i in range(4)}
    # The frontier is sorted to meet the hubs, then what it asks for to meet the links, then what it reaches.
    assert [n for n, _ in held] == [30] * 3 and all(s.count("src") == 1 for _, s in held)


def test_long_chains_merge_their_rounds(spark, monkeypatch):
    """Each hop starts from a few tables; nothing of a crawl stays in the catalog."""
    monkeypatch.setattr(crawl, "MERGE", 3)
    monkeypatch.setattr(crawl, "SPLIT", 4)
    held = []
    hop = crawl._next_hop
    monkeypatch.setattr(crawl, "_next_hop", lambda *a: (held.append(len(a[3])), hop(*a))[1])
    links = [(f"u{i}", f"u{i + 1}") for i in range(12)] + [("u3", f"leaf{i}") for i in range(30)] + [("u3", "u4")]
    before = {t.name for t in spark.catalog.listTables()}
    got = crawl.crawl_frontier(spark.createDataFrame([("u0",)], "url string"), spark.createDataFrame(links, "src string, dst string"))
    want = {f"u{i}": i for i in range(13)} | {f"leaf{i}": 4 for i in range(30)}
    assert {r.url: r.hop for r in got.collect()} == want and got.count() == len(want)
    assert max(held) == 3 and {t.name for t in spark.catalog.listTables()} == before


def test_events_without_a_time_stay_in_the_audit(spark):
    df = spark.sql("select * from values ('a', null), ('a', null), ('a', timestamp'2024-01-01'), (null, null) as t(key, ts)")
    got = crawl.quota_audit(df, "key", "ts").collect()
    assert sorted((r.key or "", r.at_us is None, r.requests) for r in got) == [("", True, 1), ("a", False, 1), ("a", True, 2)]
    assert [r.in_window for r in got if r.at_us is None] == [None, None]
