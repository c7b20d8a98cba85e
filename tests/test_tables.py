import random

import pytest
from pyspark.sql import functions as F

from cardfile.operators import columns, routing
from cardfile.sources import tables as t


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_csv_cells(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        'Business Name,text-[#1],Phone.no\n"A\nB","say ""hi"", ok",007\n,"",\n" x ",é,1.50\n',
    )
    df = t.read_contacts(spark, path)
    assert df.columns == ["Business Name", "text-[#1]", "Phone.no"]
    assert [tuple(r) for r in df.collect()] == [
        ("A\nB", 'say "hi", ok', "007"), ("", "", ""), (" x ", "é", "1.50"),
    ]
    assert df.select(columns.quoted(columns.find_first(df, "PHONE"))).first()[0] == "007"


def test_csv_without_rows_or_header(spark, tmp_path):
    empty = t.read_contacts(spark, write(tmp_path / "e.csv", "Name,URL\n"))
    assert empty.columns == ["Name", "URL"] and empty.count() == 0
    bare = t.read_contacts(spark, write(tmp_path / "b.csv", "x,1\ny,2"), ["a", "b"], header=False)
    assert [tuple(r) for r in bare.collect()] == [("x", "1"), ("y", "2")]


def test_headers_that_differ_by_case(spark, tmp_path, conf):
    path = write(tmp_path / "c.csv", "url,URL,link\n,B ,c\n  ,b,c\n,,c\n,,\n")
    with pytest.raises(ValueError, match="caseSensitive"):
        t.read_contacts(spark, path)
    conf("spark.sql.caseSensitive", "true")
    df = t.read_contacts(spark, path)
    assert [r[0] for r in df.select(columns.coalesce_columns(df)).collect()] == ["B", "", "c", ""]


def test_csv_round_trip_quotes_all(spark, tmp_path):
    rows = [('a"b', "x\ny"), ("", " s "), ("\\", "c,d")]
    df = spark.createDataFrame(rows, "k string, v string").coalesce(1)
    for quote_all in (True, False):
        path = str(tmp_path / f"out{quote_all}")
        t.write_csv(df, path, quote_all=quote_all)
        if quote_all:
            assert [tuple(r) for r in t.read_contacts(spark, path).collect()] == rows
    text = "".join(p.read_text() for p in (tmp_path / "outTrue").glob("*.csv"))
    assert text.startswith('"k","v"')


@pytest.mark.parametrize("seed, end", [(0, "\r\n"), (1, "\n")])
def test_csv_in_pieces(spark, tmp_path, conf, seed, end):
    """Pieces that start and end inside quotes, hold no start of a record, or no line, give the rows of whole files."""
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for name in "abc"[: 1 + seed]:
        rows = [["k", "v `x`", "Phone.no"]]
        for i in range(25):
            parts = ["x", " ", ",", '"', "\n", "\r\n", "é", '"\n"', "long " * 9, "\n" * 40]
            rows.append([f"{name}{i}", "".join(rng.choices(parts, k=rng.randrange(12))), rng.choice(["", "1", "a\nb"])])
        cell = lambda c: '"' + c.replace('"', '""') + '"' if rng.random() < 0.3 or set(c) & set(',"\r\n') else c
        text = end.join(",".join(map(cell, r)) for r in rows) + rng.choice(["", end, end + end])
        (folder / f"{name}.csv").write_bytes((rng.choice(["", "\ufeff"]) + text).encode())
    whole = t.read_contacts(spark, str(folder))
    want = sorted(tuple(r) for r in whole.collect())
    conf("spark.sql.files.maxPartitionBytes", "400")
    conf("spark.sql.files.openCostInBytes", "0")
    df = t.read_contacts(spark, str(folder), in_pieces=True)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 4
    assert df.columns == whole.columns
    assert sorted(tuple(r) for r in df.collect()) == want
    bare = t.read_contacts(spark, str(folder), ["a", "b", "c"], header=False, in_pieces=True)
    assert bare.count() == len(want) + 1 + seed


def test_csv_in_pieces_without_rows(spark, tmp_path):
    one = t.read_contacts(spark, write(tmp_path / "e.csv", "Name,URL\n"), in_pieces=True)
    assert one.columns == ["Name", "URL"] and one.count() == 0
    short = t.read_contacts(spark, write(tmp_path / "s.csv", 'a,b\n1\n\n2,3,4\n"",\n'), in_pieces=True)
    assert sorted(tuple(r) for r in short.collect()) == [("", ""), ("1", ""), ("2", "3")]
    folder = tmp_path / "two"
    folder.mkdir()
    write(folder / "a.csv", "a,b\n1,2\n")
    write(folder / "b.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers"):
        t.read_contacts(spark, str(folder), in_pieces=True)


def test_append_makes_header_once(spark, tmp_path):
    path, schema = str(tmp_path / "r"), t.string_schema("a", "b")
    for i in range(2):
        t.append_results(spark.createDataFrame([(i, "x")], "b int, a string"), path, schema)
    assert sorted(tuple(r) for r in t.read_table(spark, path).collect()) == [("x", "0"), ("x", "1")]


def test_replace_reads_its_own_table(spark, tmp_path):
    store = t.TableFolder(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        store.read("leads")
    store.replace("leads", spark.range(10))
    old = store.read("leads")
    store.replace("leads", store.read("leads").filter("id > 4"))
    t.update_table(store, "leads", "id", F.col("id") == 9, F.col("id") * 10)
    assert sorted(r.id for r in store.read("leads").collect()) == [5, 6, 7, 8, 90]
    assert old.count() == 10 and store.version("leads") == 3


def test_failed_replace_keeps_the_table(spark, tmp_path):
    store = t.TableFolder(spark, str(tmp_path / "store"))
    store.replace("leads", spark.range(3))
    with pytest.raises(Exception):
        store.replace("leads", spark.range(3).select(F.raise_error(F.lit("no")).alias("id")))
    assert store.read("leads").count() == 3


def test_column_search(spark):
    df = spark.createDataFrame([("", "", "", "")], "`Agent Name` string, `Business Name` string, `E-mail` string, `Email 2` string")
    assert columns.find_first(df, "EMAIL") == "Email 2"
    assert columns.find_last_any(df, ["agent", "name", "contact"]) == "Business Name"
    assert columns.find_last_any(df, ["phone"]) is None
    with pytest.raises(ValueError):
        columns.find_first(df, "phone")
    with pytest.raises(ValueError):
        columns.require(df, "Agent Name", "Status")


def test_routes_cover_all_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, x string")
    sides = routing.route(df, {"a": F.col("x") == "a"}, rest="rest")
    assert [sorted(r.i for r in sides[k].collect()) for k in ("a", "rest")] == [[1], [2, 3]]
    path = str(tmp_path / "routes")
    routing.write_routed(df, {"a": F.col("x") == "a", "b": F.col("x") > ""}, path)
    got = {r.i: r.route for r in spark.read.parquet(path).collect()}
    assert got == {1: "a", 2: "rest", 3: "b"}


def test_blank_fields_count_as_present(spark):
    df = spark.createDataFrame([("a", "1"), ("", "1"), ("a", None), (" ", "1")], "business_name string, phone string")
    sides = routing.split_complete(df)
    assert (sides["clean"].count(), sides["missing"].count()) == (2, 2)


def test_columns_go_by_their_header(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    for folder, name, text in ((one, "a.csv", "name,url\nAnn,u1\n"), (two, "b.csv", "url,name,note\nu2,Bob,n\n")):
        folder.mkdir()
        (folder / name).write_text(text)
    both = t.read_contacts(spark, [str(one), str(two)])
    assert both.columns == ["name", "url", "note"]
    assert sorted(tuple(r) for r in both.collect()) == [("Ann", "u1", ""), ("Bob", "u2", "n")]
    assert [tuple(r) for r in t.read_contacts(spark, str(two), ["name", "url"]).collect()] == [("Bob", "u2")]
    with pytest.raises(ValueError):
        t.read_contacts(spark, str(one), ["note"])
    (one / "c.csv").write_text("url,name\nu3,Cid\n")
    with pytest.raises(Exception, match="header"):
        t.read_contacts(spark, str(one)).collect()


def test_update_rewrites_the_files_it_touches(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    store = t.TableFolder(spark, str(tmp_path / "a b"))
    store.replace("x", spark.range(8000).selectExpr("id", "'old' as v", "cast(id as int) as n"), "id")
    before = store.files("x")
    assert len(before) > 2
    got = t.update_table(store, "x", "v", F.col("id") == 5, F.lit("new"))
    after = store.files("x")
    assert len({*before} & {*after}) == len(before) - 1 and len(after) == len(before) and store.version("x") == 2
    assert {(r.v, r["count"]) for r in got.groupBy("v").count().collect()} == {("new", 1), ("old", 7999)}
    assert store.read("x", 1).filter("v = 'new'").count() == 0  # the old version is still there
    t.update_table(store, "x", "v", F.col("id") == -1, F.lit("new"))
    assert store.version("x") == 2  # nothing to change, no version
    twice = t.update_table(store, "x", "n", F.col("v") == "new", F.col("n") + 0.5)
    assert twice.schema["n"].dataType.simpleString() == "int" and twice.count() == 8000
    assert store.replace("empty", spark.range(0)).count() == 0
