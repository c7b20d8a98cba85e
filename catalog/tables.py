"""Reading and writing tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfile.operators import routing
from cardfile.session import fresh_path
from cardfile.sources import tables as t

from .inputs import LEADS_SQL, leads
from .registry import query, table


@query(
    "csv_round_trip",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS "Body Text", coalesce(lang, '') AS lang
       FROM documents""",
)
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string"), F.col("text").alias("Body Text"), "lang"
    )
    t.write_csv(docs, path, quote_all=True)
    return t.read_contacts(spark, path)


_BROKEN = """concat(coalesce(text, ''), chr(10), '"', coalesce(lang, ''), '",', chr(10), chr(10), doc_id)"""


@query(
    "csv_in_pieces",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_BROKEN} AS "Body Text", coalesce(lang, '') AS lang FROM documents""",
)
def csv_in_pieces(spark, sf):
    """Cells with line breaks, quotes and commas, from files that several tasks share."""
    path = fresh_path(spark, "csv")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string"), F.expr(_BROKEN.replace("chr(10)", "char(10)")).alias("Body Text"), "lang")
    t.write_csv(docs, path, quote_all=True)
    return t.read_contacts(spark, path, in_pieces=True)


@query(
    "headerless_csv",
    f"""SELECT "Business Name" AS "Business_Name", "Phone" AS "Phone", "Emails" FROM {LEADS_SQL}""",
)
def headerless_csv(spark, sf):
    path = fresh_path(spark, "csv")
    rows = leads(spark, sf).select("Business Name", "Phone", "Emails")
    t.write_csv(rows, path, header=False)
    return t.read_contacts(spark, path, ["Business_Name", "Phone", "Emails"], header=False)


@query(
    "csv_layouts",
    """SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, '' AS site FROM customer
       UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR), 'https://s' || s_suppkey || '.example.com' FROM supplier""",
)
def csv_layouts(spark, sf):
    customers, suppliers = fresh_path(spark, "csv"), fresh_path(spark, "csv")
    t.write_csv(table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")), customers)
    site = F.concat(F.lit("https://s"), "s_suppkey", F.lit(".example.com")).alias("site")
    t.write_csv(
        table(spark, sf, "supplier").select(site, F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")), suppliers
    )
    return t.read_contacts(spark, [customers, suppliers], ["name", "nation", "site"])


_RESULT = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType())]
)


@query(
    "appended_results",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def appended_results(spark, sf):
    path = fresh_path(spark, "results")
    for name, prefix in (("customer", "c"), ("supplier", "s")):
        rows = table(spark, sf, name).select(
            F.col(f"{prefix}_nationkey").cast("bigint").alias("nation"), F.col(f"{prefix}_name").alias("name")
        )
        t.append_results(rows, path, _RESULT)
    return t.read_table(spark, path)


@query(
    "replaced_table",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN upper(p_name) ELSE p_name END AS p_name, p_size
       FROM part WHERE p_size > 10""",
)
def replaced_table(spark, sf):
    store = t.TableFolder(spark, fresh_path(spark, "tables"))
    store.replace("part", table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))
    store.replace("part", store.read("part").filter("p_size > 10"))
    return t.update_table(store, "part", "p_name", F.col("p_size") > 40, F.upper("p_name"))


@query(
    "updated_table",
    """SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 100 AND 200 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def updated_table(spark, sf):
    """Orders in files by key; only the files with the keys asked for are written again."""
    store = t.TableFolder(spark, fresh_path(spark, "tables"))
    store.replace("orders", table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    return t.update_table(store, "orders", "o_orderstatus", F.col("o_orderkey").between(100, 200), F.lit("X"))


@query(
    "routed_orders",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent'
       WHEN o_totalprice > 400000 THEN 'large' ELSE 'rest' END AS route FROM orders""",
)
def routed_orders(spark, sf):
    path = fresh_path(spark, "routes")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    tests = {"urgent": F.col("o_orderpriority") == "1-URGENT", "large": F.col("o_totalprice") > 400000}
    routing.write_routed(orders, tests, path)
    return t.read_table(spark, path).select("o_orderkey", "route")
