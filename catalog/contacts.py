"""Names, phones and text keys."""

from pyspark.sql import functions as F

from cardfile.functions import names, phones, predicates, text
from cardfile.operators import columns, dedup, reports, routing

from .inputs import (
    LEADS_SQL, bad_sql, digits_sql, invalid_sql, key_sql, leads, phone_sql, realtors_sql,
    short_sql, strip_sql,
)
from .registry import query, table

_DOCS_RANKED = f"""SELECT *, row_number() OVER (PARTITION BY {key_sql('text')} ORDER BY doc_id) AS rn
    FROM documents"""


@query("dedup_documents", f"SELECT * EXCLUDE (rn) FROM ({_DOCS_RANKED}) WHERE rn = 1")
def dedup_documents(spark, sf):
    return dedup.dedup_text(table(spark, sf, "documents"), "text", "doc_id", long_text=True)[0]


@query("duplicate_documents", f"SELECT * EXCLUDE (rn) FROM ({_DOCS_RANKED}) WHERE rn > 1")
def duplicate_documents(spark, sf):
    return dedup.dedup_text(table(spark, sf, "documents"), "text", "doc_id", long_text=True)[1]


@query(
    "document_text_rules",
    f"""SELECT doc_id, {strip_sql('text')} AS stripped, {strip_sql('lower(text)')} AS folded,
        {key_sql('text')} AS cleaned, {short_sql('text')} AS shortened,
        coalesce(nullif(lang, ''), 'Unknown') AS lang, {strip_sql('text')} <> '' AS filled
        FROM documents""",
)
def document_text_rules(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        text.strip("text").alias("stripped"),
        text.strip_lower("text").alias("folded"),
        text.dedup_key("text").alias("cleaned"),
        text.trim_words("text").alias("shortened"),
        text.blank_default("lang", "Unknown").alias("lang"),
        text.not_blank("text").alias("filled"),
    )


@query(
    "document_titles",
    f"""SELECT doc_id, {invalid_sql('text')} AS invalid, {bad_sql('text')} AS bad_phrase,
        CASE WHEN {invalid_sql('text')} AND {strip_sql('source')} <> ''
             THEN {strip_sql('source')} ELSE text END AS title,
        {realtors_sql('text', 'source')} AS short_title
        FROM documents""",
)
def document_titles(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        names.is_invalid_business("text").alias("invalid"),
        names.has_bad_phrase("text").alias("bad_phrase"),
        names.business_or_agent("text", "source").alias("title"),
        names.business_or_realtors("text", "source").alias("short_title"),
    )


@query(
    "business_or_agent",
    f"""SELECT ord, {invalid_sql('"Business Name"')} AS invalid,
        CASE WHEN {strip_sql('"Agent Name"')} <> '' AND {invalid_sql('"Business Name"')}
             THEN {strip_sql('"Agent Name"')} ELSE "Business Name" END AS business
        FROM {LEADS_SQL}""",
)
def business_or_agent(spark, sf):
    return leads(spark, sf).select(
        "ord",
        names.is_invalid_business("Business Name").alias("invalid"),
        names.business_or_agent("Business Name", "Agent Name").alias("business"),
    )


@query(
    "clean_phones",
    f"""SELECT ord, {digits_sql('"Phone"')} AS digits, {phone_sql('"Phone"')} AS cleaned,
        length({digits_sql(phone_sql('"Phone"'))}) >= 11 AS usable,
        CASE WHEN regexp_matches({strip_sql('"Phone"')}, '^[0-9]') THEN '+' || {strip_sql('"Phone"')}
             ELSE {strip_sql('"Phone"')} END AS plus
        FROM {LEADS_SQL}""",
)
def clean_phones(spark, sf):
    cleaned = phones.clean_phone("Phone")
    return leads(spark, sf).select(
        "ord",
        phones.digits("Phone").alias("digits"),
        cleaned.alias("cleaned"),
        phones.phone_ok(cleaned).alias("usable"),
        phones.add_plus("Phone").alias("plus"),
    )


DEDUP_PHONES_SQL = f"""SELECT * EXCLUDE (p, rn) REPLACE (p AS "Phone") FROM (
    SELECT *, row_number() OVER (PARTITION BY {digits_sql('p')} ORDER BY ord) AS rn
    FROM (SELECT *, {phone_sql('"Phone"')} AS p FROM {LEADS_SQL})
    WHERE length({digits_sql('p')}) >= 11) WHERE rn = 1"""


@query("dedup_phones", DEDUP_PHONES_SQL)
def dedup_phones(spark, sf):
    return dedup.dedup_phone(leads(spark, sf), "Phone", "ord")


@query(
    "phone_report",
    f"""SELECT count(DISTINCT d) FILTER (length(d) >= 11) AS valid_unique,
        count(*) FILTER (length(d) < 11) AS invalid,
        count(*) FILTER (length(d) >= 11) - count(DISTINCT d) FILTER (length(d) >= 11) AS duplicates
        FROM (SELECT {digits_sql(phone_sql('"Phone"'))} AS d FROM {LEADS_SQL})""",
)
def phone_report(spark, sf):
    return reports.phone_report(leads(spark, sf), "Phone")


@query(
    "name_report",
    f"""SELECT count(*) AS processed, count(*) FILTER (bad AND person) AS replaced,
        count(*) FILTER (bad AND NOT person) AS emptied FROM (
        SELECT {strip_sql('"Business Name"')} = '' OR {bad_sql('"Business Name"')} AS bad,
        {strip_sql('"Agent Name"')} <> '' AS person FROM {LEADS_SQL})""",
)
def name_report(spark, sf):
    return reports.name_report(leads(spark, sf), "Business Name", "Agent Name")


@query(
    "status_filter",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderstatus <> 'F' AS pending
       FROM orders WHERE lower(o_orderpriority) = '1-urgent'""",
)
def status_filter(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter(predicates.status_is("o_orderpriority", "1-Urgent")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        predicates.pending("o_orderstatus", "F").alias("pending"),
    )


_SHAPED = """(SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS business_name,
    CASE WHEN value < 5 THEN '' WHEN value < 8 THEN NULL ELSE CAST(user_id AS STRING) END AS phone
    FROM events)"""


def _shaped(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", "").otherwise(kind).alias("business_name"),
        F.when(value < 5, "").when(value >= 8, F.col("user_id").cast("string")).alias("phone"),
    )


@query(
    "complete_split",
    f"""SELECT event_id, business_name, phone,
        CASE WHEN business_name <> '' AND coalesce(phone, '') <> '' THEN 'clean' ELSE 'missing' END AS route
        FROM {_SHAPED}""",
)
def complete_split(spark, sf):
    sides = routing.split_complete(_shaped(spark, sf))
    return sides["clean"].withColumn("route", F.lit("clean")).unionByName(
        sides["missing"].withColumn("route", F.lit("missing"))
    )


@query(
    "phones_present",
    f"SELECT event_id, phone FROM {_SHAPED} WHERE phone IS NOT NULL",
)
def phones_present(spark, sf):
    return _shaped(spark, sf).filter(predicates.has_value("phone")).select("event_id", "phone")


@query(
    "found_columns",
    f"""SELECT ord, "Phone" AS first_phone, "Business Name" AS last_business,
        "Business Name" AS last_agent, "Agent Name" AS second FROM {LEADS_SQL}""",
)
def found_columns(spark, sf):
    df = columns.require(leads(spark, sf), "Business Name", "Agent Name")
    return df.select(
        "ord",
        columns.quoted(columns.find_first(df, "phone")).alias("first_phone"),
        columns.quoted(columns.find_last_any(df, ["business", "company"])).alias("last_business"),
        columns.quoted(columns.find_last_any(df, ["agent", "name", "contact"])).alias("last_agent"),
        columns.col_at(df, 1).alias("second"),
    )


@query(
    "updated_cells",
    f"""SELECT ord, "Agent Name",
        CASE WHEN {invalid_sql('"Business Name"')} THEN upper("Segment") ELSE "Business Name" END
        AS "Business Name", 'n/a' AS "Segment" FROM {LEADS_SQL}""",
)
def updated_cells(spark, sf):
    df = leads(spark, sf).drop("Phone", "Emails")
    bad = names.is_invalid_business("Business Name")
    df = columns.update_cells(df, "Business Name", bad, F.upper("Segment"))
    return columns.replace_col(df, "Segment", F.lit("n/a"))


@query(
    "coalesced_columns",
    f"""SELECT p_partkey, {strip_sql('''coalesce(nullif(a, ''), nullif(b, ''), nullif(c, ''), '')''')} AS url FROM (
        SELECT p_partkey, CASE WHEN p_size > 30 THEN '' WHEN p_size > 25 THEN '  ' ELSE p_name END AS a,
        CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE ' ' || p_brand END AS b, p_type AS c FROM part)""",
)
def coalesced_columns(spark, sf):
    size = F.col("p_size")
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.when(size > 30, "").when(size > 25, "  ").otherwise(F.col("p_name")).alias("agent_profiles"),
        F.when(F.col("p_brand") != "Brand#1", F.concat(F.lit(" "), "p_brand")).alias("url"),
        F.col("p_type").alias("website"),
    )
    return df.select("p_partkey", columns.coalesce_columns(df).alias("url"))
