"""Contact-shaped tables derived from the given ones.

The expressions are plain SQL that both engines read, so a query and its check start from the same
derived rows; everything after that is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

LEAD = {
    "ord": "c_custkey",
    "Agent Name": "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE concat(' ', c_name, ' ') END",
    "Business Name": """CASE c_custkey % 9
        WHEN 0 THEN ''
        WHEN 1 THEN concat('15 Years with ', c_mktsegment)
        WHEN 2 THEN 'COMPASS Florida'
        WHEN 3 THEN concat(c_mktsegment, ' International Realty and Property Management, nation ', c_nationkey)
        WHEN 4 THEN 'Undefined'
        WHEN 5 THEN concat('  ', c_mktsegment, '   Homes  ')
        WHEN 6 THEN 'Yearling Business'
        WHEN 7 THEN concat('The-quite-long-name-without-any-gap-', c_mktsegment, '-', c_nationkey)
        ELSE concat(c_mktsegment, ' Realty ', c_nationkey) END""",
    "Phone": """CASE c_custkey % 7
        WHEN 0 THEN concat('(305) 555-', lpad(CAST(c_custkey % 700 AS STRING), 4, '0'))
        WHEN 1 THEN concat('1.305.555.', lpad(CAST(c_custkey % 900 AS STRING), 4, '0'))
        WHEN 2 THEN concat('0044 20 7946 ', lpad(CAST(c_custkey % 800 AS STRING), 4, '0'))
        WHEN 3 THEN concat('555-', lpad(CAST(c_custkey % 1000 AS STRING), 4, '0'))
        WHEN 4 THEN 'no phone'
        WHEN 5 THEN concat(' 786 555 ', lpad(CAST(c_custkey % 600 AS STRING), 4, '0'), ' / 305 555 0000')
        ELSE concat('+1 (786) 555-', lpad(CAST(c_custkey % 500 AS STRING), 4, '0')) END""",
    "Emails": """CASE c_custkey % 5
        WHEN 0 THEN concat('Agent', c_custkey, '@Example.com; office', c_nationkey, '@example.org')
        WHEN 1 THEN concat('agent', c_custkey, '@example.com')
        WHEN 2 THEN concat('none , AGENT', c_custkey - 1, '@example.com,', c_mktsegment, '@example.net')
        WHEN 3 THEN concat('a', c_custkey, '@example.com, a', c_custkey, '@example.com')
        ELSE '' END""",
    "Segment": "c_mktsegment",
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())


LEADS_SQL = f"(SELECT {select_list(LEAD)} FROM customer)"


def leads(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select(*[F.expr(e).alias(n) for n, e in LEAD.items()])


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def made_pages(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """HTML pages made from short rows, spread over all tasks before they grow.

    A split of short rows would otherwise become one task with far more HTML than a split of pages.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return derived(df.repartition(tasks, key), columns)


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def key_sql(x: str) -> str:
    one_space = rf"regexp_replace({strip_sql(x)}, '\s+', ' ', 'g')"
    return rf"lower(regexp_replace({one_space}, '[\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g'))"


def digits_sql(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def phone_sql(x: str) -> str:
    d = digits_sql(x)
    return f"""CASE WHEN {d} = '' THEN '' WHEN length({d}) = 10 THEN '+1' || {d}
        WHEN length({d}) > 11 AND {d}[1:2] = '00' THEN '+' || {d}[3:] ELSE '+' || {d} END"""


def short_sql(x: str, limit: int = 40) -> str:
    s = strip_sql(x)
    cut = strip_sql(f"regexp_replace({s}[1:{limit}], ' [^ ]*$', '')")
    return f"CASE WHEN length({s}) <= {limit} THEN {s} ELSE {cut} END"


def invalid_sql(x: str) -> str:
    low = f"lower({x})"
    words = " OR ".join(
        f"contains({low}, '{w}')" for w in ("experience", "business", "undefined", "compass")
    )
    return rf"({strip_sql(x)} = '' OR regexp_matches({low}, '\byears?\b') OR {words})"


def bad_sql(x: str) -> str:
    low = f"lower({x})"
    return f"(contains({low}, 'compass') OR contains({low}, 'undefined') OR contains({low}, 'experience'))"


def realtors_sql(business: str, agent: str) -> str:
    b, a = strip_sql(business), strip_sql(agent)
    return f"""CASE WHEN {b} = '' OR {bad_sql(business)}
        THEN CASE WHEN {a} = '' THEN '' ELSE {a} || ' Realtors' END
        ELSE {short_sql(business)} END"""
