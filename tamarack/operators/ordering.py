"""Running totals, codes, row numbers and exact picks without sorting a whole table, or a whole group, in one task.

Quantiles and ranks are in :mod:`tamarack.operators.selection`. All here rest on :func:`running_totals`: the rows are first reduced to one row per distinct
value, values are cut into ranges, range totals are summed over the (few) ranges, and only the
rows of one range of one group are ever sorted together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.operators.joins import fits, hot_from_counts, null_safe_join, skew_join
from tamarack.session import cut_lineage, shuffle_width

def _with_range(df: DataFrame, order: str, keys: Sequence[str], ranges: int) -> DataFrame:
    """Add the range number of every value; the borders are a uniform sample of the distinct values.

    Borders only balance the work: results do not depend on them. Numbers are looked up by binary search, null below all. Any other
    value is compared with every n-th border first and then with the n after the last one below it, n the root of their number.
    """
    sample = df.select(order, F.xxhash64(*keys, order).alias("_pick")).orderBy("_pick", order).limit(ranges)
    if isinstance(df.schema[order].dataType, T.NumericType):
        number = F.col(order).cast("double") + 0.0  # 0.0 for -0.0
        picked = sample.agg(F.collect_set(number)).first()[0]
        borders = sorted(b for b in picked if math.isfinite(b))
        if not borders:
            return df.withColumn("_range", F.when(F.isnan(number), 1).otherwise(0))
        search = Bucketizer(splits=[-math.inf, *borders, math.inf], inputCol="_number", outputCol="_at", handleInvalid="keep")
        found = search.transform(df.withColumn("_number", number))  # NaN above all
        return found.withColumn("_range", F.when(F.col("_number").isNull(), 0).otherwise(F.col("_at").cast("int"))).drop("_number", "_at")
    step = max(1, math.isqrt(ranges))
    borders = sample.agg(F.array_sort(F.collect_set(order)).alias("all"))
    borders = borders.select(
        F.struct("all", F.filter("all", lambda b, i: F.pmod(i + 1, F.lit(step)) == 0).alias("tops"))
    ).scalar()
    above = F.size(F.filter("_borders.tops", lambda b: b < F.col(order))) * step  # whole steps of borders below the value
    near = F.filter(F.slice("_borders.all", F.col("_above") + 1, F.lit(step)), lambda b: b < F.col(order))
    found = df.withColumn("_borders", borders).withColumn("_above", above)
    return found.withColumn("_range", F.col("_above") + F.size(near)).drop("_borders", "_above")


def running_totals(
    distinct: DataFrame,
    keys: Sequence[str],
    order: str,
    weights: Sequence[str],
    ranges: int | None = None,
) -> DataFrame:
    """Add ``<weight>_before`` and ``<weight>_total`` to a frame with one row per (keys, order).

    ``_before`` sums the weight over smaller values of the same group, ``_total`` over the
    whole group.
    """
    keys = list(keys)
    ranges = ranges or 4 * shuffle_width(distinct.sparkSession)
    ranged = _with_range(distinct, order, keys, ranges)
    group = W.partitionBy(*keys) if keys else W.partitionBy()
    ahead = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(*[F.sum(w).alias(f"_sum_{w}") for w in weights])
    offsets = offsets.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{w}").over(ahead), F.lit(0)).alias(f"_base_{w}") for w in weights],
        *[F.sum(f"_sum_{w}").over(group).alias(f"{w}_total") for w in weights],
    )
    inside = (
        W.partitionBy(*keys, "_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    )
    ranged = ranged.withColumns(
        {f"_inner_{w}": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    )
    joined = null_safe_join(ranged, offsets, [*keys, "_range"])
    joined = joined.withColumns(
        {f"{w}_before": F.col(f"_inner_{w}") + F.col(f"_base_{w}") for w in weights}
    )
    return joined.drop(
        "_range", *[f"_inner_{w}" for w in weights], *[f"_base_{w}" for w in weights]
    )


def written_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The value counts as a written table: the order statistics read them several times."""
    return cut_lineage(value_counts_by(df, keys, value))


def value_counts_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, value) with its row count ``n``; null values are left out."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dense_codes(df: DataFrame, value: str, output: str, salt_by: Sequence[str]) -> DataFrame:
    """Code every value by its place among the sorted distinct values; null gets -1."""
    counts = written_counts(df, [], value)
    codes = running_totals(counts.select(value, F.lit(1).cast("long").alias("n")), [], value, ["n"]).select(
        value, F.col("n_before").cast("int").alias(output)
    )
    joined = skew_join(df, codes, [value], salt_by, "left", hot_from_counts(counts, [value], "n"))
    return joined.withColumn(output, F.coalesce(output, F.lit(-1)))


def row_index(df: DataFrame, key: str, output: str = "row_index") -> DataFrame:
    """Dense 0-based index by the order of a unique key, computed range by range."""
    indexed = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [], key, ["_one"])
    return indexed.withColumnRenamed("_one_before", output).drop("_one", "_one_total")


def pick_by_hash(
    df: DataFrame,
    strata: Sequence[str],
    quotas: DataFrame,
    id_col: str,
    seed: int,
    slots: int = 65_536,
) -> DataFrame:
    """Mark exactly ``quota`` rows per stratum, those with the smallest hash of (seed, id).

    ``quotas`` has one row per stratum, null being one: the strata columns and
    ``quota``, at most the rows of the stratum. Returns ``df`` with a
    boolean ``picked``. The hash histogram finds the one slot per stratum in which the quota
    ends; only the rows of that slot are ordered, and the big table is read without a shuffle.
    """
    strata = list(strata)
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), id_col)).withColumn(
        "_slot", F.floor((F.col("_hash").cast("double") / F.lit(2.0**63) + 1.0) * F.lit(slots / 2)).cast("int")
    )
    ahead = W.partitionBy(*strata).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    histogram = hashed.groupBy(*strata, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    quotas_side = F.broadcast(quotas) if fits(quotas) else quotas
    edges = histogram.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    edges = (
        null_safe_join(edges, quotas_side, strata)
        .where((F.col("_before") < F.col("quota")) & (F.col("quota") <= F.col("_before") + F.col("_n")))
        .select(*strata, F.col("_slot").alias("_edge"), (F.col("quota") - F.col("_before")).alias("_left"))
    )
    edges = cut_lineage(edges)  # one row per stratum
    few = fits(edges)
    in_edge = null_safe_join(hashed.select(*strata, id_col, "_hash", "_slot"), F.broadcast(edges) if few else edges, strata)
    place = W.partitionBy(*strata).orderBy("_hash", id_col)
    last = (
        in_edge.where(F.col("_slot") == F.col("_edge"))
        .withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") == F.col("_left"))
        .select(*strata, F.col("_hash").alias("_last_hash"), F.col(id_col).alias("_last_id"))
    )
    below = (F.col("_hash") < F.col("_last_hash")) | (
        (F.col("_hash") == F.col("_last_hash")) & (F.col(id_col) <= F.col("_last_id"))
    )
    return (
        null_safe_join(hashed, F.broadcast(last) if few else last, strata, "left")
        .withColumn("picked", F.coalesce(below, F.lit(False)))
        .drop("_hash", "_slot", "_last_hash", "_last_id")
    )
