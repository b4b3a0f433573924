"""Exact quantiles and percentile ranks by keyed radix selection.

Quantiles. Groups of up to ``FEW`` rows go to Spark's exact aggregate. In larger groups every wanted rank is pinned down in rounds: rows are
counted per group and bin, the bin that holds the rank becomes the next interval, with the least and largest value in it as its
ends, until it holds one value or few rows. The first bins are parts of powers of two, the next ones of equal width, so that the
rounds work through sign, exponent and mantissa and cannot be more than ``ROUNDS``. Nothing is sorted but the few rows left.

Ranks. Rows of large groups are dealt to the same bins, and bins of many rows to finer ones. Where all rows of a bin are equal, the counts
give the rank, so that a value held by a third of all rows is never gathered; all other rows are ranked within their bin or small group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.operators.joins import fits, null_safe_join
from tamarack.session import cut_lineage, shuffle_width

#: Rows of a group or an interval that one task may hold.
FEW = 65_536

#: Rows of a large group that one task ranks, about; more rows are more tasks.
TASK_ROWS = 1 << 20

#: Bins per power of two in the first round, bins of equal width in the others, and rounds until no two doubles share a bin.
PER_OCTAVE, BINS, ROUNDS = 32, 1024, 8


#: Stands for the whole table where there are no keys.
WHOLE = "_whole"


def large_groups(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame | None:
    """(keys, _n) of the groups with more than ``FEW`` non-null values; None if there are none."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(counts.where(F.col("_n") > FEW))
    return large if large.limit(1).count() else None


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df) else df


def _first_bin(value: Column) -> Column:
    """Sign and part of a power of two; grows with the value. Logarithms in the JVM never fall where their argument rises."""
    x = value.cast("double")
    place = F.rint((F.log2(F.abs(x)) + 1100) * PER_OCTAVE)
    return F.when(F.isnan(x), F.lit(float("nan"))).when(x > 0, place).when(x < 0, -place).otherwise(F.lit(0.0))


def _next_bin(value: Column, low: Column, high: Column, bins: Column) -> Column:
    return F.least(F.floor((value - low).cast("double") / (high - low).cast("double") * bins), bins - 1).cast("double")


def _narrowed(histogram: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The bin of each wanted rank: its ends, its rows and the rank within it."""
    on = [c for c in (*keys, "slot") if c in histogram.columns]
    run = W.partitionBy(*on).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    steps = histogram.withColumn("_before", F.coalesce(F.sum("n").over(run), F.lit(0)))
    found = null_safe_join(steps, _hinted(wanted.select(*keys, "slot", "rank")), on)
    found = found.where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("n")))
    return found.select(*keys, "slot", (F.col("rank") - F.col("_before")).alias("rank"), "low", "high", "n")


def _inside(rows: DataFrame, open_: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows once for each open interval that they lie in."""
    intervals = open_.groupBy(*keys).agg(F.collect_list(F.struct("slot", "low", "high")).alias("_open"))  # two per quantile
    joined = null_safe_join(rows, _hinted(intervals), keys)
    within = F.filter("_open", lambda i: (i["low"] <= F.col(value)) & (F.col(value) <= i["high"]))
    return joined.select(*keys, value, F.inline(within))


def selected(rows: DataFrame, keys: Sequence[str], value: str, wanted: DataFrame) -> DataFrame:
    """(keys, slot, value) for ``wanted`` ranks (keys, slot, rank; ranks from 0) among the non-null values of large groups."""
    keys = list(keys)
    ends = [F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")]
    done: list[DataFrame] = []
    histogram = rows.groupBy(*keys, _first_bin(F.col(value)).alias("bin")).agg(*ends)
    state = cut_lineage(_narrowed(histogram, wanted, keys))
    for _ in range(ROUNDS):
        closed = (F.col("low") == F.col("high")) | (F.col("n") <= FEW)
        done.append(state.where(closed))
        state = state.where(~closed)
        if not state.limit(1).count():
            break
        dealt = _inside(rows, state, keys, value)
        histogram = dealt.groupBy(*keys, "slot", _next_bin(F.col(value), F.col("low"), F.col("high"), F.lit(BINS)).alias("bin")).agg(*ends)
        state = cut_lineage(_narrowed(histogram, state, keys))
    ended = done[0]
    for more in done[1:]:
        ended = ended.unionByName(more)
    ended = cut_lineage(ended)
    single = ended.where("low = high").select(*keys, "slot", F.col("low").alias(value))
    few = ended.where("low <> high")
    if not few.limit(1).count():
        return single
    gathered = _inside(rows, few, keys, value).groupBy(*keys, "slot").agg(F.sort_array(F.collect_list(value)).alias("_all"))
    places = null_safe_join(gathered, _hinted(few.select(*keys, "slot", "rank")), [*keys, "slot"])
    return single.unionByName(places.select(*keys, "slot", F.element_at("_all", F.col("rank").cast("int") + 1).alias(value)))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, one column per entry of ``quantiles``.

    Nulls are left out; a group of nulls only, and an empty table with ``keys``, give no row (without ``keys``: one row of nulls). Null
    is a key like any other. A group may hold any number of rows: no more than ``FEW`` of them are ever gathered.
    """
    shares = F.array(*[F.lit(float(q)) for q in quantiles.values()])
    columns = [F.get("_q", F.lit(k)).alias(name) for k, name in enumerate(quantiles)]
    by = list(keys) or [WHOLE]
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, *([] if keys else [F.lit(0).alias(WHOLE)]))
    large = large_groups(rows, by, value)
    if large is None:
        return rows.groupBy(*keys).agg(F.percentile(value, shares).alias("_q")).select(*keys, *columns)
    marked = null_safe_join(rows, _hinted(large), by, "left")
    big = marked.where(F.col("_n").isNotNull()).drop("_n")
    spots = [(F.col("_n") - 1) * F.lit(float(q)) for q in quantiles.values()]
    ranks = [
        F.struct(F.lit(2 * k + up).alias("slot"), end(spot).cast("bigint").alias("rank"))
        for k, spot in enumerate(spots) for up, end in ((0, F.floor), (1, F.ceil))
    ]
    found = selected(big, by, value, large.select(*by, F.inline(F.array(*ranks))))
    picks = [F.max(F.when(F.col("slot") == s, F.col(value))).cast("double").alias(f"_{s}") for s in range(2 * len(quantiles))]
    out = null_safe_join(found.groupBy(*by).agg(*picks), _hinted(large), by)
    parts = []
    for k, (name, spot) in enumerate(zip(quantiles, spots)):
        low, high = F.col(f"_{2 * k}"), F.col(f"_{2 * k + 1}")
        parts.append(F.when(low == high, low).otherwise(low + (high - low) * (spot - F.floor(spot))).alias(name))
    out = out.select(*keys, *parts)
    if not keys:
        return out
    rest = marked.where(F.col("_n").isNull()).groupBy(*keys).agg(F.percentile(value, shares).alias("_q"))
    return out.unionByName(rest.select(*keys, *columns))


def percentile_rank(df: DataFrame, keys: Sequence[str], value: str, output: str, salt_by: Sequence[str]) -> DataFrame:
    """Average rank divided by the number of non-null values, within each group; null for null values.

    ``salt_by`` names columns that differ between rows; they spread rows that need no order. Null is a key like any other. A group may
    hold any number of rows, and a value as well.
    """
    by = list(keys) or [WHOLE]
    df = df if keys else df.withColumn(WHOLE, F.lit(0))
    large = large_groups(df, by, value)
    cells = ["_c0"]
    if large is None:
        none = F.lit(None).cast("bigint")
        marked = df.withColumns({"_c0": F.lit(0.0), "_n": none, "_base": none, "_same": none, "_one": F.lit(False)})
    else:
        rows = null_safe_join(df, _hinted(large), by, "left")
        wanted = F.col("_n").isNotNull() & F.col(value).isNotNull()
        rows = rows.withColumn("_c0", F.when(wanted, _first_bin(F.col(value))).otherwise(0.0))
        for depth in range(1, 2 * ROUNDS + 1):
            counts = rows.where(wanted).groupBy(*by, *cells).agg(F.count(F.lit(1)).alias("_same"), F.min(value).alias("_low"), F.max(value).alias("_high"))
            run = W.partitionBy(*by).orderBy(*cells).rowsBetween(W.unboundedPreceding, -1)  # as many rows as bins
            offsets = counts.withColumns({"_base": F.coalesce(F.sum("_same").over(run), F.lit(0)), "_one": F.col("_low") == F.col("_high")})
            offsets = cut_lineage(offsets)
            heavy = offsets.where((F.col("_same") > FEW) & ~F.col("_one"))
            heavy = heavy.select(*by, *cells, "_low", "_high", F.col("_same").alias("_rows"))
            if depth == 2 * ROUNDS or not heavy.limit(1).count():
                break
            enough = F.least(F.lit(BINS), 16 * F.ceil(F.col("_rows") / FEW))
            finer = _next_bin(F.col(value), F.col("_low"), F.col("_high"), enough)
            rows = null_safe_join(rows, _hinted(heavy), [*by, *cells], "left")
            rows = rows.withColumn(f"_c{depth}", F.when(wanted & F.col("_low").isNotNull(), finer).otherwise(0.0)).drop("_low", "_high", "_rows")
            cells.append(f"_c{depth}")
        marked = null_safe_join(rows, _hinted(offsets.drop("_low", "_high")), [*by, *cells], "left")
    alone = F.coalesce("_one", F.lit(False))  # equal values: counted, not ordered
    spread = F.pmod(F.xxhash64(*salt_by), F.lit(4 * shuffle_width(df.sparkSession))) + 1
    salt = F.when(F.col(value).isNull() | alone, spread).otherwise(F.lit(0))
    marked = marked.withColumn("_salt", salt)
    numbered = {
        c: F.when(F.isnan(c), F.lit(1 << 62)).when(F.abs(c) == math.inf, F.lit(1 << 61) * F.signum(c).cast("int")).otherwise(F.col(c).cast("bigint"))
        for c in cells
    }
    marked = marked.withColumns(numbered)  # windows see whole numbers, so that they keep the partitions given here
    if large is not None:  # tasks as the rows ask for, so that one never sorts more the larger the table is
        tasks = -(-int(large.agg(F.sum("_n")).first()[0]) // TASK_ROWS)
        if tasks > shuffle_width(df.sparkSession):
            marked = marked.repartition(tasks, *keys, *cells, "_salt")
    place = W.partitionBy(*by, *cells, "_salt")
    rank = F.rank().over(place.orderBy(value))
    peers = F.count(F.lit(1)).over(place.orderBy(value).rangeBetween(W.currentRow, W.currentRow))  # in the order of the ranks: one sort
    size = F.coalesce("_n", F.count(value).over(place))
    mean = F.when(alone, F.col("_base") + (F.col("_same") + 1) / 2).otherwise(F.coalesce("_base", F.lit(0)) + F.col("_rank") + (F.col("_peers") - 1) / 2)
    out = marked.withColumns({"_rank": rank, "_peers": peers, "_size": size})
    out = out.withColumn(output, F.when(F.col(value).isNotNull(), mean / F.col("_size")))
    return out.drop(WHOLE, *cells, "_n", "_base", "_same", "_one", "_salt", "_rank", "_peers", "_size")
