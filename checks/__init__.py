"""Queries over the test tables and the SQL they are checked against."""
from . import joins, outputs, profiles, records, stored, tables
from .registry import QUERIES, SQL


def all_queries() -> dict:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
