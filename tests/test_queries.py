"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry_points
import compare
from catalog import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows = compare.spark_rows(QUERIES[name](spark, SF))
    assert not compare.difference(rows, compare.sql_rows(con, SQL[name]))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_points_hold_the_catalogue():
    assert set(QUERIES) <= set(entry_points.queries())
    assert {k: entry_points.oracle_sql()[k] for k in SQL} == SQL
