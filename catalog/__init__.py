"""Registered queries with the SQL that must give the same rows."""

from . import contacts, emails, jobs, pages, runs, streams, tables, urls  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
