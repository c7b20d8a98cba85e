"""Run a query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and not math.isnan(v):
        return round(v, 9)
    return str(v) if hasattr(v, "isoformat") else v


def _sorted(rows):
    return sorted((tuple(_cell(v) for v in row) for row in rows), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted(df.select(*[f"`{n}`" for n in names]).collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cursor.fetchall()
    return [names[i] for i in order], _sorted([[r[i] for i in order] for r in rows])


def difference(left, right) -> str:
    (names_a, a), (names_b, b) = left, right
    if names_a != names_b:
        return f"columns {names_a} and {names_b}"
    if a == b:
        return ""
    only_a = [r for r, s in zip(a, b) if r != s][:2]
    only_b = [s for r, s in zip(a, b) if r != s][:2]
    return f"{len(a)} and {len(b)} rows\n  spark {only_a or a[len(b):][:2]}\n  sql   {only_b or b[len(a):][:2]}"
