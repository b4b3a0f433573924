"""Profiles from mergeable sketches: one scan of the data, kept per part, merged later without reading the data again.

Each part of the data (a day, a load, a source) gets one short row per column: exact counts, sums and extremes, a sketch of its
distinct values and a sketch of its ranks. Rows of several parts merge into those of their union, in any order. Sketches are
Spark's own aggregates; a row has a few kilobytes however large the part is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of the rank sketches; a rank read from one is off by at most RANK_ERROR of the rows with 99 % certainty.
RANKS, RANK_ERROR = 800, 0.0045
#: Size of the distinct sketches as a power of two, and three times their relative standard error of 1.04 / sqrt(2 ** DISTINCT).
DISTINCT, DISTINCT_ERROR = 14, 0.025

_COUNTED = ("rows", "present", "total", "low", "high", "distinct", "ranks")


def sketch_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, rows, present, total, low, high, distinct, ranks): one row per part and numeric column.

    ``rows`` counts all rows, ``present`` those that are neither null nor NaN; nulls and NaN are in no other statistic. A part whose
    values are all missing has empty sketches and null sums and extremes; an empty table without ``by`` has rows of zero.
    """
    by = list(by)
    values = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_v{k}") for k, c in enumerate(columns)])
    parts = []
    for k, name in enumerate(columns):
        v = F.col(f"_v{k}")
        statistics = [
            F.count(F.lit(1)),
            F.count(v),
            F.sum(v),
            F.min(v),
            F.max(v),
            F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), F.lit(DISTINCT)),
            F.kll_sketch_agg_double(v, F.lit(RANKS)),
        ]
        parts.append(F.struct(F.lit(name).alias("feature"), *[s.alias(n) for n, s in zip(_COUNTED, statistics)]))
    gathered = values.groupBy(*by).agg(F.array(*parts).alias("_parts"))
    return gathered.select(*by, F.inline("_parts"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of several parts as those of their union, per value of ``by``: the same columns, nothing but the sketches is read."""
    return sketches.groupBy(*by, "feature").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )


def read_sketches(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """(others..., feature, rows, missing, mean, low, high, distinct, and one column per quantile by name).

    Quantiles are values of the data whose rank is right within ``RANK_ERROR``, distinct counts are right within
    ``DISTINCT_ERROR``; both are exact for few values. Parts without values have null quantiles and no distinct values.
    """
    others = [c for c in sketches.columns if c not in ("feature", *_COUNTED)]
    found = F.when(F.col("present") > 0, F.kll_sketch_get_quantile_double("ranks", F.array(*[F.lit(float(q)) for q in quantiles.values()])))
    return sketches.withColumn("_q", found).select(
        *others,
        "feature",
        "rows",
        (F.col("rows") - F.col("present")).alias("missing"),
        F.try_divide("total", "present").alias("mean"),
        "low",
        "high",
        F.hll_sketch_estimate("distinct").alias("distinct"),
        *[F.col("_q")[k].alias(name) for k, name in enumerate(quantiles)],
    )
