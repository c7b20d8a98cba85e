import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import streams
from cardfile.functions import selectors as sel
from cardfile.functions.shred import with_nodes
from cardfile.operators.links import profile_fields
from cardfile.operators.matching import resume
from cardfile.streaming import incremental as inc
from cardfile.streaming.seen import FirstRows, SeenKeys, committed

SCHEMA = "ord long, k string"


def add(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def test_keep_first_over_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        stream = inc.file_stream(spark, source, schema(SCHEMA), files_per_batch=1)
        inc.stream_keep_first(stream, F.lower("k"), "ord", out, check)
        return sorted((r.ord, r.k) for r in spark.read.parquet(out).select("ord", "k").collect())

    add(spark, source, [(5, "A"), (3, "a"), (4, "b")])
    assert run() == [(3, "a"), (4, "b")]
    assert run() == [(3, "a"), (4, "b")]
    add(spark, source, [(1, "a"), (9, "c"), (8, "C")])
    assert run() == [(3, "a"), (4, "b"), (8, "C")]
    add(spark, source, [(2, "c"), (7, "d")])
    assert run() == [(3, "a"), (4, "b"), (7, "d"), (8, "C")]


@pytest.mark.parametrize("rows", [400, 5, 0])
def test_batches_of_several_files(spark, tmp_path, monkeypatch, rows):
    """A batch is written by as many tasks as its rows come from, and is one batch still, however few rows it has."""
    monkeypatch.setattr(streams, "fresh_path", lambda *_: str(tmp_path / "in"))
    made = spark.range(rows).repartition(4, "id").select("id", F.when(F.col("id") < 300, 0).otherwise(2).alias("batch"))
    stream, seen = streams.in_batches(spark, made, F.col("batch")), []
    inc.run_available(stream, str(tmp_path / "check"), each=lambda b, n: seen.append(sorted(r.batch for r in b.collect())))
    assert [x for x in seen if x] == [x for x in ([0] * min(rows, 300), [2] * (rows - 300)) if x]
    files = len(list((tmp_path / "in").glob("*.parquet")))
    assert files % 3 == 0 and (files == 12 or rows < 400)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    """A batch that was written but not committed is written again to the same place."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, source, [(1, "a"), (2, "b"), (3, "a")])
    for check in ("c1", "c2"):  # a lost checkpoint replays batch 0
        stream = inc.file_stream(spark, source, schema(SCHEMA))
        inc.stream_keep_first(stream, F.col("k"), "ord", out, str(tmp_path / check))
    assert spark.read.parquet(out).count() == 2


def test_extract_resumes(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    ddl = "page_id long, url string, html string"
    page = "<h1>{}</h1><a href='tel:{}'>x</a>"

    def run(done):
        stream = inc.file_stream(spark, source, schema(ddl))
        table = spark.createDataFrame([(u,) for u in done], "url string")
        inc.incremental_extract(stream, table, {"Name": sel.one("h1")}, out, check)
        return sorted((r.url, r.name, r.phone, r.status) for r in committed(spark, out).collect())

    add(spark, source, [(1, "a.com/1", page.format("A", 1)), (2, "a.com/2", page.format("B", 2))], ddl)
    one = ("https://a.com/1", "A", "1", "Completed")
    assert run(["https://a.com/2 "]) == [one]
    assert run(["https://a.com/2 "]) == [one]
    add(spark, source, [(3, "a.com/3", None)], ddl)
    assert run([]) == [one, ("https://a.com/3", "", "", "Failed")]
    add(spark, source, [(4, "a.com/3", page.format("C", 3)), (5, "a.com/4", page.format("D", 4)), (6, "a.com/4", None)], ddl)
    assert run([]) == [one, ("https://a.com/3", "", "", "Failed"), ("https://a.com/4", "D", "4", "Completed")]
    ledger = spark.read.parquet(f"{out}/ledger").orderBy("batch_id").collect()
    assert [(r.batch_id, r.completed, r.failed) for r in ledger] == [(0, 1, 0), (1, 0, 1), (2, 1, 0)]


def test_killed_extract_adds_nothing(spark, tmp_path, monkeypatch):
    """A batch that stops before its ledger row is not read; run again it leaves its rows once."""
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    ddl = "page_id long, url string, html string"
    add(spark, source, [(n, f"https://a.com/{n}", f"<h1>{n}</h1>") for n in range(4)], ddl)

    def run():
        stream = inc.file_stream(spark, source, schema(ddl))
        inc.incremental_extract(stream, spark.createDataFrame([], "url string"), {"Name": sel.one("h1")}, out, check)

    with monkeypatch.context() as m:
        m.setattr(SeenKeys, "add", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()
    assert spark.read.parquet(f"{out}/rows").count() == 4
    with pytest.raises(ValueError, match="committed"):
        committed(spark, out)
    for _ in range(2):
        run()
        assert sorted(r.name for r in committed(spark, out).collect()) == ["0", "1", "2", "3"]


def test_seen_keys_reads_its_own_buckets(spark, tmp_path):
    keys = SeenKeys(str(tmp_path / "keys"), buckets=8, merge_every=3)
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    for n, k in enumerate("abcdefgh"):
        assert keys.unseen(rows(k, None if n else "z"), "k", n).count() == (2 if n < 2 else 1)
        keys.add(rows(k, *([None] if n == 1 else [])), "k", n)
    assert sorted(r.k for r in keys.unseen(rows("a", "h", "x", None), "k", 8).collect()) == ["x"]
    assert sorted(r.k for r in keys.unseen(rows("a", "h", None), "k", 1).collect() if r.k) == ["h"]  # a replay of batch 1
    folders, single = keys._folders(spark, 8)
    assert folders[0].endswith("merged-6") and single == 2
    plan = keys.unseen(rows("a"), "k", 8)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_finished_pages_are_not_parsed(spark):
    pages = spark.createDataFrame([("u", "<h1>x")], "url string, html string")
    todo = resume(pages, pages.select("url"), "url")
    plan = profile_fields(with_nodes(todo), {}, "url")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("LeftAnti")  # the join is below the parser


def test_routes_per_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "business_name string, phone string"
    add(spark, source, [("a", "1"), ("", "1"), ("b", None)], ddl)
    stream = inc.file_stream(spark, source, schema(ddl), files_per_batch=1)
    inc.batched_route(stream, "business_name", "phone", out, str(tmp_path / "check"))
    add(spark, source, [("c", "1")], ddl)
    inc.batched_route(stream, "business_name", "phone", out, str(tmp_path / "check"))
    report = spark.read.parquet(f"{out}/report").orderBy("batch").collect()
    assert [(r.batch, r.clean, r.missing) for r in report] == [(0, 1, 2), (1, 1, 0)]
    rows = spark.read.parquet(f"{out}/rows").groupBy("route").count().collect()
    assert {r["route"]: r["count"] for r in rows} == {"clean": 2, "missing": 2}


@pytest.mark.parametrize("event_time", [None, "ts"])
def test_state_store_dedup(spark, tmp_path, event_time):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "k string, ts timestamp"
    spark.sql("select * from values ('a', timestamp'2024-01-01'), ('a', timestamp'2024-01-01'), ('b', timestamp'2024-01-02') as t(k, ts)").write.parquet(source)
    stream = inc.stream_dedup(inc.file_stream(spark, source, schema(ddl)), ["k"], event_time, event_time and "1 day")
    inc.run_available(stream, str(tmp_path / "check"), out)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_state_store_dedup_over_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for batch in ([("a",), ("b",)], [("a",), ("c",)], [("a",), ("a",)]):
        spark.createDataFrame(batch * 20, "k string").repartition(4).write.mode("append").parquet(source)
        stream = inc.file_stream(spark, source, schema("k string"))
        inc.run_available(inc.stream_dedup(stream, ["k"]), check, out)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_failures_get_blank_rows(spark):
    tried = spark.createDataFrame([("a",), ("b",), ("b",)], "url string")
    found = spark.createDataFrame([("a", "Ann")], "url string, name string")
    got = sorted(tuple(r) for r in inc.failure_rows(tried, found).collect())
    assert got == [("a", "Ann", "Completed"), ("b", "", "Failed"), ("b", "", "Failed")]


def test_hot_key_is_cut_before_the_state(spark, tmp_path):
    """One state row per key, and few of the rows of a hot key reach it; nulls are a key, the latest row stays."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [("hot", n) for n in range(5000)] + [("cold", 1), (None, 2), (None, 3)]
    spark.createDataFrame(rows, "k string, n long").selectExpr("k", "timestamp_seconds(n) as ts").coalesce(1).write.parquet(source)
    stream = inc.stream_dedup(inc.file_stream(spark, source, schema("k string, ts timestamp")), ["k"], "ts", "1 day")
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
    query = query.format("parquet").start(out)
    query.awaitTermination()
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in state) == 3
    got = {r.k: r.n for r in spark.read.parquet(out).selectExpr("k", "unix_timestamp(ts) as n").collect()}
    assert got == {"hot": 4999, "cold": 1, None: 3}


def test_first_rows_take_the_place_of_later_ones(spark, tmp_path):
    firsts = FirstRows(str(tmp_path / "firsts"), schema("k string, a long, b long"), "k", "a", "b", buckets=4, merge_every=2)
    batches = [
        [("x", 5, 1), ("x", 4, 9), ("y", 1, 1), (None, 3, 3)],
        [("x", 4, 8), ("y", 1, 1), ("z", 2, None), (None, 3, 4)],
        [],
        [("z", 2, 0), ("y", 0, 7), ("x", 9, 9), (None, None, 1)],
        [("w", 1, 1), ("x", 4, 7)],
    ]
    nulls_first = lambda row: tuple((v is not None, v) if v is not None else (False, 0) for v in row[1:])
    for n, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, "k string, a long, b long")
        for _ in range(2):  # a replay changes nothing
            firsts.merge(rows, n)
        whole = [r for b in batches[: n + 1] for r in b]
        want = {r[0]: min((o for o in whole if o[0] == r[0]), key=nulls_first) for r in whole}
        got = [tuple(r) for r in firsts.read(spark, n + 1).collect()]
        assert sorted(got, key=str) == sorted(want.values(), key=str)
    assert firsts.read(spark, 0).count() == 0


def test_first_rows_write_only_what_comes_before(spark, tmp_path):
    folder = str(tmp_path / "firsts")
    firsts = FirstRows(folder, schema("k string, a long"), "k", "a")
    firsts.merge(spark.range(1000).selectExpr("cast(id as string) k", "id a"), 0)
    firsts.merge(spark.range(1000).selectExpr("cast(id as string) k", "if(id = 7, -1, id + 1) a"), 1)
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{folder}/batch-1").select("k", "a").collect()] == [("7", -1)]
