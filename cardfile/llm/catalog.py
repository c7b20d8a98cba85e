"""Registered queries of the operators, and the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfile.session import materialize

from . import anchor_lists, chat, mixing, passages, phrases, pii, quality, simhash, site_templates, tiling, url_lists, voronoi, warc
from .words import whole_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query()
def op1_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return site_templates.extract(_table(spark, sf, "pages"))


@_query(r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
runs AS (
  SELECT rid, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: struct_pack(p := i, w := ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS r FROM d WHERE len(ws) >= 3),
again AS (SELECT rid, r.p AS p, count(*) OVER (PARTITION BY rid, r.w) AS n FROM runs),
covered AS (
  SELECT rid, count(DISTINCT p + o) AS n FROM again, (VALUES (0), (1), (2)) AS x(o) WHERE n > 1 GROUP BY rid),
lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
base AS (
  SELECT d.rid, doc_id, t, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_capitals
  FROM d JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR 2 * n_letters < word_chars OR 2 * n_capitals > n_letters) AS kept
FROM judged
""")
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    order = [x["rule"] for x in quality.measure(docs, quality.RULES)]
    judged = quality.with_base(docs)
    known = ("n_words", "word_chars", "n_symbols", "n_dup_lines")
    facts = quality.Facts(whole_text("text"), **{c: F.col(c) for c in known})
    passes = quality.rejected_by(facts, order).isNull()
    return judged.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(passes)).drop("text")


_ESCAPED = "replace(replace(replace({}, '\\', '\\b'), '<', '\\l'), '>', '\\g')"


@_query(rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn ' || {_ESCAPED.format("role")} || '>' || {_ESCAPED.format("text")} || '</turn>' || chr(10)))::BIGINT
    AS formatted_chars
FROM turns GROUP BY conv_id
""")
def op3_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    turns = chat.collect_turns(rows.unionByName(extra), "conv_id", "turn")
    written = materialize(chat.format_turns(turns).select("conv_id", "segments", "formatted"), "chat")
    back = written.select(
        "conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"),
    )
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


#: Pages have no time of capture and there is no dated list: both are derived from the pages by hashes.
_YEAR, _START = 31_536_000, 1_704_067_200


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _sql_number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def captures(spark: SparkSession, sf: str) -> DataFrame:
    at = F.lit(_START) + _number(F.concat(F.lit("f"), F.col("page_id").cast("string"))) % _YEAR
    return _table(spark, sf, "pages").select("page_id", "url", F.timestamp_seconds(at).alias("fetched_at"))


def dated_lists(taken: DataFrame) -> DataFrame:
    """Three entries for every third host, twelve for the domain above it, one for every seventh address."""
    host = url_lists.host_of(F.col("url"))
    hosts = taken.where("url is not null").select(host.alias("name")).distinct()
    domains = hosts.select(F.substring_index("name", ".", -2).alias("name")).distinct()

    def listed(names: DataFrame, times: int) -> DataFrame:
        each = names.select("name", F.explode(F.sequence(F.lit(1), F.lit(times)).cast("array<string>")).alias("n"))
        return each.select(
            F.concat(F.lit("host:"), "name").alias("pattern"),
            F.when(_number(F.concat("name", F.lit("a"), "n")) % 2 == 0, "block").otherwise("allow").alias("action"),
            F.timestamp_seconds(F.lit(_START) + _number(F.concat("name", F.lit("#"), "n")) % _YEAR).alias("listed_on"),
        )

    some = taken.where("url is not null and page_id % 7 = 0")
    shift = F.when(F.col("page_id") % 2 == 0, 1000).otherwise(-1000)
    addresses = some.select(
        F.concat(F.lit("url:"), url_lists.normal_url(F.col("url"))).alias("pattern"),
        F.when(F.col("page_id") % 3 == 0, "allow").otherwise("block").alias("action"),
        F.timestamp_seconds(F.unix_timestamp("fetched_at") + shift).alias("listed_on"),
    )
    return listed(hosts.where(_number(F.col("name")) % 3 == 0), 3).union(listed(domains, 12)).union(addresses)


_CASED = r"regexp_replace(regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', ''), '/+$', '')"
_BARE = f"lower(regexp_extract({_CASED}, '^[^/?]*')) || regexp_replace({_CASED}, '^[^/?]*', '')"


@_query(rf"""
WITH c AS (
  SELECT page_id, url, {_START} + {_sql_number("'f' || page_id")} % {_YEAR} AS t,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host, {_BARE} AS bare
  FROM pages),
names AS (
  SELECT DISTINCT host AS name, 3 AS times FROM c WHERE {_sql_number("host")} % 3 = 0
  UNION ALL
  SELECT DISTINCT array_to_string(string_split(host, '.')[-2:], '.'), 12 FROM c),
numbered AS (SELECT name, unnest(range(1, times + 1)) AS n FROM names),
entries AS (
  SELECT 'host:' || name AS pattern,
         CASE WHEN {_sql_number("name || 'a' || n")} % 2 = 0 THEN 'block' ELSE 'allow' END AS action,
         {_START} + {_sql_number("name || '#' || n")} % {_YEAR} AS since FROM numbered
  UNION ALL
  SELECT 'url:' || bare, CASE WHEN page_id % 3 = 0 THEN 'allow' ELSE 'block' END,
         t + CASE WHEN page_id % 2 = 0 THEN 1000 ELSE -1000 END FROM c WHERE page_id % 7 = 0),
keys AS (
  SELECT page_id, t, 'url:' || bare AS pattern, 0 AS place FROM c
  UNION ALL
  SELECT page_id, t, 'host:' || array_to_string(string_split(host, '.')[i:], '.'), i
  FROM c, range(1, 20) AS r(i) WHERE i <= len(string_split(host, '.'))),
met AS (
  SELECT page_id, place, keys.pattern, action, since,
         row_number() OVER (PARTITION BY page_id ORDER BY place, since DESC, action DESC) AS nth
  FROM keys JOIN entries ON keys.pattern = entries.pattern AND since <= t)
SELECT c.page_id, url, t AS fetched_s, action AS list_action, pattern AS list_pattern, since AS listed_s
FROM c LEFT JOIN met ON c.page_id = met.page_id AND nth = 1
""")
def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    taken = captures(spark, sf)
    judged = url_lists.judge(taken, dated_lists(taken))
    return judged.select(
        "page_id", "url", F.unix_timestamp("fetched_at").alias("fetched_s"), "list_action", "list_pattern",
        F.unix_timestamp("listed_on").alias("listed_s"),
    )


@_query()
def op5_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    entries = mixing.mixed(_table(spark, sf, "documents"))
    rows = entries.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
    return rows.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@_query()
def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_spans(_table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select("doc_id", "spans", base.alias("base")).select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.digest_text(F.col("base")), 256).alias("base_sha256"),
        pii.digest_text(F.col("spans")).alias("spans"),
    )


@_query()
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"), k=3, max_bits=2)
    return found.select("doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


@_query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
five AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first,
         list_transform(range(0, 8), lambda j: ('0x' || substr(hex, 5 * j + 1, 5))::BIGINT) AS groups FROM p)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  array_to_string(list_transform(groups, lambda v: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v >> s) & 31) + 1)::INT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM five
""")
def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    read = warc.read_captures(spark, warc.write_archives(_table(spark, sf, "pages"), least_bytes=0))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem").drop("problem")


@_query()
def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.shared_passages(_table(spark, sf, "documents"), every=True)


@_query()
def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@_query("""
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND NOT (q.vec_id = c.vec_id AND q.v = c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM met)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op11_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    return voronoi.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


@_query("""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND NOT (a.vec_id = c.vec_id AND a.v = c.v AND a.label = c.label)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives p JOIN met ON met.anchor_id = p.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
""")
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return anchor_lists.hard_negatives(_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label)


@_query(r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
ws AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
each AS (SELECT lang, piece, unnest(w) AS w, unnest(range(len(w))) AS i FROM ws),
runs AS (
  SELECT lang, w AS g1, w || ' ' || lead(w, 1) OVER p AS g2, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS g3,
         w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p AS g4
  FROM each WINDOW p AS (PARTITION BY piece ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, g1 AS g FROM runs UNION ALL SELECT lang, 2, g2 FROM runs WHERE g2 IS NOT NULL
  UNION ALL SELECT lang, 3, g3 FROM runs WHERE g3 IS NOT NULL UNION ALL SELECT lang, 4, g4 FROM runs WHERE g4 IS NOT NULL),
f AS (SELECT lang, k, g, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
longer AS (SELECT lang, k, n, string_split(g, ' ') AS w FROM f WHERE k > 2),
subs AS (
  SELECT lang, n, unnest(list_transform(range(1, longer.k - s.k + 2), lambda i: array_to_string(w[i:i + s.k - 1], ' '))) AS g
  FROM longer JOIN range(2, 4) AS s(k) ON s.k < longer.k),
most AS (SELECT lang, g, max(n) AS most FROM subs GROUP BY ALL),
kept AS (
  SELECT f.lang, f.g, f.n AS a, string_split(f.g, ' ') AS w, f.k FROM f LEFT JOIN most USING (lang, g)
  WHERE f.k > 1 AND (most IS NULL OR 100 * most < 80 * f.n)),
cuts AS (
  SELECT kept.lang, kept.g, a, c AS cut, l.n AS l, r.n AS r, ((2000000::HUGEINT * a) // (l.n + r.n))::BIGINT AS score
  FROM kept JOIN range(1, 4) AS x(c) ON c < kept.k
  JOIN f l ON l.lang = kept.lang AND l.g = array_to_string(w[1:c], ' ')
  JOIN f r ON r.lang = kept.lang AND r.g = array_to_string(w[c + 1:], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM low)
SELECT ranked.lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""")
def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.phrases(_table(spark, sf, "documents"), longest=4, least=30, share=80, first=2_000)
