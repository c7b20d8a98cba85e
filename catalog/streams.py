"""Incremental jobs over the tables as file streams; each runs to the end of the input."""

from pyspark.sql import functions as F

from cardfile.functions.shred import with_nodes
from cardfile.operators import links
from cardfile.session import fresh_path
from cardfile.streaming import incremental as inc
from cardfile.streaming.seen import committed

from .inputs import made_pages
from .pages import PROFILE, PROFILE_SQL, profile_pages
from .registry import query, table


def stream(spark, sf, name):
    """The table's file, or its folder, as a stream: the pattern fits both."""
    return inc.file_stream(spark, f"{sf}/{name}.parque[t]", table(spark, sf, name).schema)


def in_batches(spark, rows, batch):
    """Rows as a stream of three micro-batches, those with the lowest ``batch`` (0 to 2) first."""
    folder, files = fresh_path(spark, "batches"), None
    for n in range(3):  # a batch takes the oldest files, as many as the first one has
        part = rows.where(batch == n)
        (part.coalesce(files) if files else part).write.mode("append").parquet(folder)
        written = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
        files = files or written
        for _ in range(files * (n + 1) - written):  # tasks without rows write no file
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(folder)
    return inc.file_stream(spark, folder, rows.schema, files_per_batch=files)


@query(
    "stream_extract",
    f"""SELECT * EXCLUDE (c_custkey), 'Completed' AS status FROM {PROFILE_SQL} WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def stream_extract(spark, sf):
    out = fresh_path(spark, "profiles")
    pages = made_pages(stream(spark, sf, "customer"), "c_custkey", PROFILE)
    done = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("https://agents.example.com/"), "o_custkey").alias("url")
    )
    for _ in range(2):  # the second run finds nothing new
        inc.incremental_extract(pages, done, links.OVERVIEW_PROFILE, out, f"{out}-checkpoint")
    return committed(spark, out).drop("batch_id")


@query(
    "stream_keep_first",
    """SELECT event_id, user_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def stream_keep_first(spark, sf):
    out = fresh_path(spark, "firsts")
    events = stream(spark, sf, "events").select("event_id", "user_id", "event_type")
    key = F.concat_ws("|", "user_id", "event_type")
    for _ in range(2):
        inc.stream_keep_first(events, key, "event_id", out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_dedup", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def stream_dedup(spark, sf):
    out = fresh_path(spark, "keys")
    keys = stream(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    inc.run_available(
        inc.stream_dedup(keys, ["o_custkey", "o_orderpriority"]), f"{out}-checkpoint", out
    )
    return spark.read.parquet(out)


@query(
    "stream_routes",
    """SELECT CAST(0 AS BIGINT) AS batch, count(*) FILTER (event_type <> 'error' AND user_id > 20) AS clean,
        count(*) FILTER (NOT (event_type <> 'error' AND user_id > 20)) AS missing FROM events""",
)
def stream_routes(spark, sf):
    out = fresh_path(spark, "routes")
    rows = stream(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("business_name"),
        F.when(F.col("user_id") > 20, F.col("user_id").cast("string")).otherwise("").alias("phone"),
    )
    inc.batched_route(rows, "business_name", "phone", out, f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/report").select(F.col("batch").cast("bigint"), "clean", "missing")


@query(
    "failure_rows",
    f"""SELECT 'https://agents.example.com/' || a.o_custkey AS url, coalesce(business_name, '') AS business_name,
        coalesce(name, '') AS name, CASE WHEN url IS NULL THEN 'Failed' ELSE 'Completed' END AS status
        FROM (SELECT DISTINCT o_custkey FROM orders) a LEFT JOIN (
            SELECT * FROM {PROFILE_SQL} WHERE phone <> '') p ON p.c_custkey = a.o_custkey""",
)
def failure_rows(spark, sf):
    attempted = table(spark, sf, "orders").select(
        F.concat(F.lit("https://agents.example.com/"), "o_custkey").alias("url")
    ).distinct()
    extracted = links.profile_fields(
        with_nodes(profile_pages(spark, sf)), links.OVERVIEW_PROFILE, "url"
    ).filter("phone <> ''").select("url", "business_name", "name")
    return inc.failure_rows(attempted, extracted)


@query(
    "stream_extract_batches",
    f"""SELECT * EXCLUDE (c_custkey) REPLACE (
            CASE WHEN c_custkey % 5 = 0 THEN '' ELSE business_name END AS business_name,
            CASE WHEN c_custkey % 5 = 0 THEN '' ELSE name END AS name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE phone END AS phone,
            CASE WHEN c_custkey % 5 = 0 THEN '' ELSE address END AS address,
            CASE WHEN c_custkey % 5 = 0 THEN '' ELSE website END AS website),
        CASE WHEN c_custkey % 5 = 0 THEN 'Failed' ELSE 'Completed' END AS status FROM {PROFILE_SQL}""",
)
def stream_extract_batches(spark, sf):
    """Pages in three batches, each page again in the next one; every fifth cannot be read."""
    out = fresh_path(spark, "profiles")
    pages = made_pages(table(spark, sf, "customer"), "c_custkey", PROFILE)
    pages = pages.withColumn("html", F.when(F.regexp_extract("url", r"([0-9]+)$", 1).cast("bigint") % 5 != 0, F.col("html")))
    third = F.pmod(F.xxhash64("url"), F.lit(3))
    twice = pages.withColumn("batch", third).unionByName(pages.withColumn("batch", F.least(third + 1, F.lit(2))))
    done = spark.createDataFrame([], "url string")
    stream = in_batches(spark, twice, F.col("batch"))
    for _ in range(2):  # the second run finds nothing new
        inc.incremental_extract(stream, done, links.OVERVIEW_PROFILE, out, f"{out}-checkpoint")
    return committed(spark, out).drop("batch_id")


@query(
    "stream_keep_first_batches",
    """SELECT event_id, user_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, event_id) AS rn
        FROM events) WHERE rn = 1""",
)
def stream_keep_first_batches(spark, sf):
    out = fresh_path(spark, "firsts")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    stream = in_batches(spark, events, F.col("event_id") % 3)
    inc.stream_keep_first(stream, F.concat_ws("|", "user_id", "event_type"), "event_id", out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("stream_dedup_batches", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def stream_dedup_batches(spark, sf):
    out = fresh_path(spark, "keys")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    keys = inc.stream_dedup(in_batches(spark, orders, F.col("o_orderkey") % 3), ["o_custkey", "o_orderpriority"])
    inc.run_available(keys, f"{out}-checkpoint", out)
    return spark.read.parquet(out).select("o_custkey", "o_orderpriority")


@query("stream_dedup_event_time", "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events")
def stream_dedup_event_time(spark, sf):
    """One row per user and day; batches follow time, so a key may go a day after its row."""
    out = fresh_path(spark, "days")
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    events = events.withColumn("day", F.to_date("ts"))
    low, high = events.agg(F.unix_date(F.min("day")), F.unix_date(F.max("day")) + 1).first()
    third = F.floor((F.unix_date("day") - low) * 3 / (high - low))
    days = inc.stream_dedup(in_batches(spark, events, third), ["user_id", "day"], "ts", "1 day")
    inc.run_available(days, f"{out}-checkpoint", out)
    return spark.read.parquet(out).select("user_id", "day")
