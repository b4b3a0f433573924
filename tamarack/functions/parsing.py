"""Durations, list literals and list cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(text: Column, pattern: str) -> Column:
    """First group as a number, null without a match."""
    return F.regexp_extract(text, pattern, 1).try_cast("int")


def duration_strict(column: str | Column) -> Column:
    """Minutes of text that starts like '2h 30min'; 0 for anything else, null included."""
    text = F.col(column) if isinstance(column, str) else column
    minutes = _number(text, r"^(\d+)h \d+min") * 60 + _number(text, r"^\d+h (\d+)min")
    return F.coalesce(minutes, F.lit(0))


def duration_lenient(column: str | Column) -> Column:
    """Minutes from hours and minutes found independently; null stays null."""
    text = F.col(column) if isinstance(column, str) else column
    hours = F.coalesce(_number(text, r"(\d+)h"), F.lit(0))
    minutes = F.coalesce(_number(text, r"(\d+)m"), F.lit(0))
    return F.when(text.isNotNull(), hours * 60 + minutes)


def parse_list(column: str | Column) -> Column:
    """A list literal with either kind of quotes as array<string>; null when malformed."""
    return F.from_json(column, "array<string>")
