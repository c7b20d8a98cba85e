import random

from pyspark.sql import functions as F

from cardfile.operators import ordering, reports


def test_ordinals_are_gapless(spark):
    rng = random.Random(4)
    keys = rng.sample(range(10**9), 5000)
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string").repartition(7)
    got = ordering.with_ordinal(df, "k", partitions=9, start=2).orderBy("k").collect()
    assert [(r.k, r.ord) for r in got] == list(zip(sorted(keys), range(2, 5002)))
    assert [c for c in ordering.with_ordinal(df, "k").columns] == ["k", "v", "ord"]


def test_ordinal_of_two_columns_and_of_nothing(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "x string, y int")
    got = ordering.with_ordinal(df, "x", "y").orderBy("ord").collect()
    assert [(r.x, r.y, r.ord) for r in got] == [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)]
    assert ordering.with_ordinal(df.filter("y > 9"), "x", "y").count() == 0


def test_batches(spark):
    df = spark.range(1, 251).withColumnRenamed("id", "ord")
    sizes = ordering.assign_batches(df).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(r) for r in sizes] == [(1, 100), (2, 100), (3, 50)]
    assert ordering.take_batch(df.select(F.col("ord").alias("k")), 3, "k").collect()[-1].k == 3


def test_running_total_over_chunks(spark):
    rows = [(n, n % 7) for n in random.Random(1).sample(range(10_000), 3000)]
    df = spark.createDataFrame(rows, "n long, v long")
    got = ordering.running_total(df, "n", {"t": "v"}, {"all": "v"}, width=64).orderBy("n").collect()
    total = 0
    for r, (n, v) in zip(got, sorted(rows)):
        total += v
        assert (r.n, r.t) == (n, total)
    assert {r["all"] for r in got} == {total}


def test_running_total_over_sparse_numbers(spark, monkeypatch):
    """Numbers far apart fill whole chunks, and chunk totals are summed in levels of at most ``width`` rows."""
    written, write = [], ordering.materialize

    def spy(df, label):
        out = write(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(ordering, "materialize", spy)
    rows = [(n * 1_000_003, n % 7) for n in range(300)]
    df = spark.createDataFrame(rows, "n long, v long")
    got = ordering.running_total(df, "n", {"t": "v"}, {"all": "v"}, width=8).orderBy("n").collect()
    assert [(r.n, r.t, r["all"]) for r in got] == [(n, sum(v for _, v in rows[: i + 1]), sum(v for _, v in rows)) for i, (n, _) in enumerate(rows)]
    assert [n for label, n in written if label == "chunks"] == [38, 5]
    assert ordering.running_total(df.where("n < 0"), "n", {"t": "v"}, {"all": "v"}).count() == 0


def test_throughput_without_time(spark):
    df = spark.createDataFrame([(1, 10, 0), (2, 30, 60)], "batch long, rows long, seconds long")
    a, b = reports.throughput(df).orderBy("batch").collect()
    assert (a.rows_per_min, a.overall_per_min, a.remaining, a.eta_minutes) == (0.0, 0.0, 30, None)
    assert (b.rows_per_min, b.overall_per_min, b.remaining, b.eta_minutes) == (30.0, 40.0, 0, 0.0)


def test_matched_first(spark):
    df = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "ord int, m boolean")
    assert [r.ord for r in ordering.matched_first(df, "m", "ord").collect()] == [2, 4, 1, 3]
