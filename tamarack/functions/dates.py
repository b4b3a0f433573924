"""Date parsing and date parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.constants import DATE_FORMATS, LAG_BINS


def parse_date(column: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that fits; null when none does."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.try_to_date(column, f) for f in formats])


def with_date_parts(df: DataFrame, column: str, prefix: str = "review") -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_year": F.year(column),
            f"{prefix}_month": F.month(column),
            f"{prefix}_day": F.day(column),
        }
    )


def day_name(column: str | Column) -> Column:
    return F.date_format(column, "EEEE")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(later, earlier)


def lag_bin(days: str | Column) -> Column:
    """Right-closed release-lag bin; anything at or below the first border is null."""
    days = F.col(days) if isinstance(days, str) else days
    chain = None
    for low, high, label in LAG_BINS:
        inside = days > low if high is None else (days > low) & (days <= high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain
