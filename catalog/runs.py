"""Order, batches, crawl tables and audits."""

from pyspark.sql import functions as F

from cardfile.functions.urls import site_of
from cardfile.operators import columns, crawl, links, ordering, reports, routing

from .registry import query, table

_NUMBERED = "(SELECT *, row_number() OVER (ORDER BY o_orderkey) AS ord FROM orders)"


@query(
    "order_batches",
    f"SELECT o_orderkey, o_orderdate, ord, CAST((ord - 1) // 100 + 1 AS BIGINT) AS batch FROM {_NUMBERED}",
)
def order_batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordering.assign_batches(ordering.with_ordinal(orders, "o_orderkey"))


@query("next_batch", "SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 100")
def next_batch(spark, sf):
    return ordering.take_batch(table(spark, sf, "documents").select("doc_id", "source"), 100, "source", "doc_id")


@query(
    "batch_report",
    f"""SELECT CAST((ord - 1) // 100 + 1 AS BIGINT) AS batch,
        count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW') AS clean,
        count(*) FILTER (NOT (o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW')) AS missing
        FROM {_NUMBERED} GROUP BY 1""",
)
def batch_report(spark, sf):
    rows = ordering.with_ordinal(
        table(spark, sf, "orders").select(
            "o_orderkey",
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("business"),
            F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("x").alias("phone"),
        ),
        "o_orderkey",
    )
    return reports.batch_split_counts(ordering.assign_batches(rows), "batch", "business", "phone")


@query(
    "throughput",
    """WITH b AS (
        SELECT event_id // 100 + 1 AS batch, count(*) AS rows,
            (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds FROM events GROUP BY 1),
       t AS (SELECT *, sum(rows) OVER w AS total_rows, sum(seconds) OVER w AS total_seconds,
            sum(rows) OVER () AS all_rows FROM b WINDOW w AS (ORDER BY batch)),
       o AS (SELECT *, CASE WHEN total_seconds > 0 THEN total_rows / (total_seconds / 60) ELSE 0 END AS overall FROM t)
       SELECT batch, rows, CAST(seconds AS BIGINT) AS seconds,
        round(CASE WHEN seconds > 0 THEN rows / (seconds / 60) ELSE 0 END, 6) AS rows_per_min,
        CAST(total_rows AS BIGINT) AS total_rows, round(overall, 6) AS overall_per_min,
        CAST(all_rows - total_rows AS BIGINT) AS remaining,
        CASE WHEN overall > 0 THEN round((all_rows - total_rows) / overall, 3) END AS eta_minutes FROM o""",
)
def throughput(spark, sf):
    events = table(spark, sf, "events")
    at = crawl.micros(events, "ts")
    batches = (
        events.select(ordering.batch_of("event_id", start=0).alias("batch"), at.alias("at"))
        .groupBy("batch")
        .agg(
            F.count("*").alias("rows"),
            F.floor((F.max("at") - F.min("at")) / 1_000_000).alias("seconds"),
        )
    )
    return (
        reports.throughput(batches)
        .withColumn("rows_per_min", F.round("rows_per_min", 6))
        .withColumn("overall_per_min", F.round("overall_per_min", 6))
        .withColumn("eta_minutes", F.round("eta_minutes", 3))
    )


_ATTEMPTS = """(SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END AS found
    FROM events)"""


@query(
    "crawl_cutoff",
    f"""WITH f AS (SELECT *, found IS NULL OR (found = 0 AND page > 1) AS failed FROM {_ATTEMPTS} WHERE page <= 20),
        e AS (SELECT *, failed AND lag(failed, 1, false) OVER (PARTITION BY user_id ORDER BY page) AS ends FROM f),
        c AS (SELECT *, coalesce(bool_or(ends) OVER (PARTITION BY user_id ORDER BY page
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended FROM e)
        SELECT user_id, event_id, CAST(page AS INTEGER) AS page, CAST(found AS INTEGER) AS found FROM c WHERE NOT ended""",
)
def crawl_cutoff(spark, sf):
    kind = F.col("event_type")
    events = table(spark, sf, "events").select(
        "user_id", "event_id",
        F.when(kind.isin("click", "view"), 0).when(kind != "error", 1).alias("found"),
    )
    pages = links.numbered_pages(events, "user_id", "event_id", limit=20)
    return crawl.crawl_cutoff(pages, "user_id", "page", "found", max_pages=20)


_US = "epoch_us(ts)"


@query(
    "quota_audit",
    f"""WITH r AS (SELECT event_type, {_US} AS at_us, count(*) AS requests FROM events GROUP BY ALL),
        w AS (SELECT *, coalesce(sum(requests) OVER s, 0) AS in_window, min(at_us) OVER s AS oldest FROM r
            WINDOW s AS (PARTITION BY event_type ORDER BY at_us RANGE BETWEEN 3599999999 PRECEDING AND 1 PRECEDING))
        SELECT event_type, at_us, requests, CAST(in_window AS BIGINT) AS in_window,
        CAST(greatest(0, 4 - in_window - requests) AS BIGINT) AS remaining,
        CAST(CASE WHEN in_window >= 4 THEN 3600000000 - (at_us - oldest) + 1000000 ELSE 0 END AS BIGINT) AS wait_us FROM w""",
)
def quota_audit(spark, sf):
    return crawl.quota_audit(table(spark, sf, "events"), "event_type", "ts", limit=4, window_s=3600)


# A link graph: customers link to their orders, orders to parts, parts to suppliers and back.
_EDGES = """(
    SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders
    UNION ALL SELECT 'o' || l_orderkey, 'p' || l_partkey FROM lineitem
    UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
    UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem)"""
_SEEDS = "(SELECT 'c' || c_custkey AS url FROM customer WHERE c_acctbal < -900)"


@query(
    "crawl_frontier",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM {_EDGES}),
        r(url, hop) AS (SELECT url, 0 FROM {_SEEDS} UNION
            SELECT e.dst, r.hop + 1 FROM r JOIN e ON e.src = r.url WHERE r.hop < 64 AND NOT EXISTS (
                SELECT 1 FROM recurring.r AS seen WHERE seen.url = e.dst))
        SELECT url, min(hop) AS hop FROM r GROUP BY url""",
)
def crawl_frontier(spark, sf):
    def node(kind, key):
        return F.concat(F.lit(kind), F.col(key))

    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    edges = orders.select(node("c", "o_custkey").alias("src"), node("o", "o_orderkey").alias("dst"))
    for a, b in (("o", "p"), ("p", "s"), ("s", "p")):
        key = {"o": "l_orderkey", "p": "l_partkey", "s": "l_suppkey"}
        edges = edges.unionByName(lines.select(node(a, key[a]).alias("src"), node(b, key[b]).alias("dst")))
    seeds = table(spark, sf, "customer").filter("c_acctbal < -900").select(node("c", "c_custkey").alias("url"))
    return crawl.crawl_frontier(seeds, edges)


@query(
    "quarantined_rows",
    """SELECT "row", page_id, url AS value, 'not https' AS reason FROM (
        SELECT *, row_number() OVER (ORDER BY page_id) + 1 AS "row" FROM pages) WHERE url NOT LIKE 'https://%'""",
)
def quarantined_rows(spark, sf):
    sheet = ordering.with_ordinal(
        table(spark, sf, "pages").select("page_id", "url"), "page_id", name="row", start=2
    )
    _, bad = routing.quarantine(sheet, F.col("url").startswith("https://"), F.col("url"), "not https")
    return bad.select("row", "page_id", "value", "reason")


@query(
    "constant_columns",
    """SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') AS website_url, 1 AS page_number,
        '' AS address, url AS name, url AS business_name FROM pages""",
)
def constant_columns(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        site_of("url").alias("website_url"),
        F.lit(1).alias("page_number"),
        F.lit("").alias("address"),
        columns.quoted("url").alias("name"),
        columns.quoted("url").alias("business_name"),
    )
