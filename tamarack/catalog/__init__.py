"""Registered queries: each operator on the given tables, with its SQL equivalent where one exists."""

from tamarack.catalog import files, learn, profiles, scores, texts, vectors  # noqa: F401
from tamarack.catalog.learn import LONG
from tamarack.catalog.registry import QUERIES, SQL

__all__ = ["LONG", "QUERIES", "SQL"]
