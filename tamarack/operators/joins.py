"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.session import cut_lineage, shuffle_width

SMALL_ROWS = 100_000
SMALL_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """True when the frame is proven to stay within both bounds; reads at most one row more."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    return row["n"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def hot_keys(df: DataFrame, on: Sequence[str], parts: int | None = None) -> DataFrame:
    """Keys holding more than 1/parts of all rows, and the pieces each should be cut into.

    Fewer than ``parts`` such keys can exist, so the result is safe to broadcast whatever the
    size of ``df``.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_from_counts(counts, on, "_rows", parts, df.agg(F.count(F.lit(1))).scalar())


def hot_from_counts(
    counts: DataFrame, on: Sequence[str], rows: str, parts: int | None = None, total: Column | None = None
) -> DataFrame:
    """The same from a table of row counts per key that is at hand already."""
    parts = parts or shuffle_width(counts.sparkSession)
    total = counts.agg(F.sum(rows)).scalar() if total is None else total
    return (
        counts.select(*on, (F.col(rows) * F.lit(parts) / total).alias("_share"))
        .where(F.col("_share") > 1)
        .select(*on, F.ceil("_share").cast("int").alias("_pieces"))
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join whose hot keys are split over several tasks.

    ``left`` may hold any number of rows per key; ``right`` rows are copied once per piece of
    their key, and keys are cut into as many pieces as their share of the rows asks for, so
    the copies add at most two rows per shuffle partition and right row of a hot key. ``salt_by`` names
    columns of ``left`` that differ between rows of one key. ``how`` is inner, left or
    left_semi.
    """
    on = list(on)
    parts = shuffle_width(left.sparkSession)
    hot = F.broadcast(hot if hot is not None else hot_keys(left, on, parts))
    spread_hash = F.xxhash64(*salt_by)
    keyless = F.lit(False)
    for key in on:
        keyless = keyless | F.col(key).isNull()
    salted_left = (
        left.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.when(keyless, F.pmod(spread_hash, F.lit(parts)))
            .otherwise(F.pmod(spread_hash, F.coalesce("_pieces", F.lit(1))))
            .cast("int"),
        )
        .drop("_pieces")
    )
    salted_right = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_pieces")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    max_rows: int = SMALL_ROWS,
    right_is_bounded: bool = False,
) -> DataFrame:
    """Broadcast ``right`` when it is proven small, else fall back on :func:`skew_join`.

    ``right_is_bounded`` says that the caller built ``right`` with a fixed row bound (a top-n
    vocabulary, one row per feature), which saves the counting job.
    """
    if not right_is_bounded:
        right = cut_lineage(right)  # it is counted and joined: compute it once
    if right_is_bounded or fits(right, max_rows):
        return left.join(F.broadcast(right), list(on), how)
    return skew_join(left, right, on, salt_by, how)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null meets null; the columns of ``left``, then those of ``right`` without the keys."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    condition = F.lit(True)
    for k in on:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(named, condition, how).drop(*[f"_right_{k}" for k in on])
