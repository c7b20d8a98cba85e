"""Multi-address cells and lookups against lists."""

from pyspark.sql import functions as F

from cardfile.functions import emails as cells
from cardfile.operators import matching, ordering, reports

from .inputs import LEADS_SQL, leads, strip_sql
from .registry import query, table

_LISTED = "[lower(trim(x)) for x in regexp_split_to_array({0}, '[;,]') if trim(x) <> '']"
_AT = "[lower(trim(x)) for x in regexp_split_to_array({0}, '[;, ]+') if contains(x, '@')]"
_CELLS = _LISTED.format('"Emails"')
_AT_CELLS = _AT.format('"Emails"')
# Fixed value: an address in running text as one pattern.
_EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"


@query(
    "split_emails",
    f"""SELECT ord, array_to_string({_CELLS}, '|') AS listed, array_to_string({_AT_CELLS}, '|') AS addresses
        FROM {LEADS_SQL}""",
)
def split_emails(spark, sf):
    return leads(spark, sf).select(
        "ord",
        F.array_join(cells.split_emails_list("Emails"), "|").alias("listed"),
        F.array_join(cells.split_emails_at("Emails"), "|").alias("addresses"),
    )


@query(
    "document_emails",
    f"SELECT doc_id, unnest(regexp_extract_all(text, '{_EMAIL}')) AS email FROM documents",
)
def document_emails(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.explode(cells.extract_emails("text")).alias("email")
    )


_COUNTED = f"SELECT email, count(*) AS n FROM (SELECT unnest({_AT_CELLS}) AS email FROM {LEADS_SQL}) GROUP BY email"
UNIQUE_EMAIL_SQL = f"""SELECT l.* FROM {LEADS_SQL} l WHERE ord NOT IN (
    SELECT ord FROM (SELECT ord, unnest({_AT_CELLS}) AS email FROM {LEADS_SQL})
    WHERE email IN (SELECT email FROM ({_COUNTED}) WHERE n > 1))"""


@query("email_counts", _COUNTED)
def email_counts(spark, sf):
    return matching.email_counts(leads(spark, sf), "Emails")


@query(
    "unique_email_report",
    f"""SELECT (SELECT count(*) FROM customer) AS rows, count(*) AS kept,
        (SELECT count(*) FROM customer) - count(*) AS removed FROM ({UNIQUE_EMAIL_SQL})""",
)
def unique_email_report(spark, sf):
    df = leads(spark, sf)
    return reports.before_after(df, matching.all_unique(df, "Emails", "ord"))


MATCH_SQL = f"""SELECT l.* REPLACE (list_extract({_CELLS}, m.pos) AS "Emails") FROM {LEADS_SQL} l
    JOIN (SELECT ord, min(pos) AS pos FROM (
        SELECT ord, unnest({_CELLS}) AS e, generate_subscripts({_CELLS}, 1) AS pos FROM {LEADS_SQL})
        WHERE e IN (SELECT lower(trim(a)) FROM {{listed}}) GROUP BY ord) m ON l.ord = m.ord"""
_LIST = """(SELECT concat(' Agent', o_custkey, '@EXAMPLE.com ') AS a FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT concat('office', n_nationkey, '@example.org') FROM nation)"""


@query("match_first_email", MATCH_SQL.format(listed=_LIST))
def match_first_email(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    listed = orders.select(
        F.concat(F.lit(" Agent"), "o_custkey", F.lit("@EXAMPLE.com ")).alias("email")
    ).unionByName(
        table(spark, sf, "nation").select(
            F.concat(F.lit("office"), "n_nationkey", F.lit("@example.org")).alias("email")
        )
    )
    return matching.match_first(leads(spark, sf), listed, "Emails", "email", "ord")


@query(
    "rows_without_bad_emails",
    f"""SELECT ord, "Emails" FROM {LEADS_SQL} WHERE ord NOT IN (
        SELECT ord FROM (SELECT ord, unnest({_AT_CELLS}) AS e FROM {LEADS_SQL}) WHERE e LIKE '%.org')""",
)
def rows_without_bad_emails(spark, sf):
    df = leads(spark, sf).select("ord", "Emails")
    bad = df.filter(F.exists(cells.split_emails_at("Emails"), lambda e: e.endswith(".org")))
    return matching.drop_rows_with(df, bad, "ord")


# Fixed value: an inline list of names to look up.
_NAMES = ["small ring", "red widget", "hot gear", "Blue Bolt", "green gizmo"]
_NAMES_SQL = ", ".join(f"'{n}'" for n in _NAMES)


@query("flag_parts_inline", f"SELECT p_partkey, p_name, p_name IN ({_NAMES_SQL}) AS \"Matched\" FROM part")
def flag_parts_inline(spark, sf):
    return matching.flag_in(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", _NAMES)


@query(
    "flag_parts_lookup",
    f"SELECT p_partkey, p_name, p_name IN ({_NAMES_SQL}) AS \"Matched\" FROM part ORDER BY 3 DESC, 1",
)
def flag_parts_lookup(spark, sf):
    known = matching.lookup(spark, _NAMES)
    flagged = matching.flag_exact(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", known)
    return ordering.matched_first(flagged, "Matched", "p_partkey")


@query(
    "flag_exact_names",
    """SELECT o_orderkey, status, status IS NOT NULL AND status IN (
        SELECT upper(substring(s_name, 1, 1)) || s_nationkey FROM supplier) AS "Matched"
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'S' || (o_custkey % 40) END AS status FROM orders)""",
)
def flag_exact_names(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("S"), F.col("o_custkey") % 40)).alias("status"),
    )
    known = table(spark, sf, "supplier").select(
        F.concat(F.upper(F.substring("s_name", 1, 1)), F.col("s_nationkey")).alias("name")
    )
    return matching.flag_exact(rows, "status", known)


_NORM = """(SELECT CASE WHEN {size} > 45 THEN NULL WHEN {size} > 20 THEN upper(p_name) ELSE concat(' ', p_name, '  ') END AS name,
    p_partkey, p_size FROM part)"""


@query(
    "flag_names_normalized",
    f"""SELECT name, p_partkey, coalesce(k.hit, false) AS "Status"
        FROM {_NORM.format(size='p_size')} r LEFT JOIN (
            SELECT DISTINCT {strip_sql('lower(name)')} AS n, true AS hit FROM (
                SELECT CASE WHEN p_size > 48 THEN NULL ELSE p_name END AS name FROM part
                WHERE p_type = 'ECONOMY' AND p_retailprice < 950)) k
        ON {strip_sql('lower(r.name)')} IS NOT DISTINCT FROM k.n""",
)
def flag_names_normalized(spark, sf):
    part, size = table(spark, sf, "part"), F.col("p_size")
    rows = part.select(
        F.when(size > 20, F.when(size <= 45, F.upper("p_name")))
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit("  "))).alias("name"),
        "p_partkey",
    )
    known = part.filter("p_type = 'ECONOMY' AND p_retailprice < 950").select(
        F.when(size <= 48, F.col("p_name")).alias("name")
    )
    return matching.flag_normalized(rows, known)
