"""Column, group, time and distribution profiles: the tables behind every exploration chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.functions.constants import LAG_BINS, WEEKDAYS
from tamarack.functions.dates import day_name, lag_bin
from tamarack.operators.joins import lookup_join
from tamarack.operators.ordering import running_totals, value_counts_by
from tamarack.operators.selection import exact_quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "double") -> DataFrame:
    """(keep..., feature, value) with one row per column and non-null cell, in one scan."""
    typed = df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in columns])
    return typed.unpivot(list(keep), list(columns), "feature", "value").where(F.col("value").isNotNull())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return value_counts_by(df, [], column)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    counts = value_counts(df, column)
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, column: str, limit: int) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(limit)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Class counts, imbalance ratio (negative per positive) and the smaller count, in one row."""
    y = F.col(label).cast("int")
    counts = df.agg(
        F.count(F.when(y == 0, 1)).alias("negatives"),
        F.count(F.when(y == 1, 1)).alias("positives"),
    )
    return counts.select(
        "negatives",
        "positives",
        F.try_divide("negatives", "positives").alias("imbalance_ratio"),
        F.least("negatives", "positives").alias("minority"),
    )


def rate_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Percentage of positive labels and row count per key; null keys are left out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            (F.avg(F.col(label).cast("int")) * 100).alias("rate"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def _numbered(df: DataFrame, names: Sequence[str], number: str, name: str) -> DataFrame:
    """A short fixed list of names as a frame, with their places from 0."""
    place = F.col("id").cast("int")
    texts = F.array(*[F.lit(n) for n in names])
    return df.sparkSession.range(len(names)).select(place.alias(number), F.get(texts, place).alias(name))


def lag_bin_rate(df: DataFrame, days: str, label: str) -> DataFrame:
    """Rate and count per release-lag bin, empty bins included, in calendar order."""
    found = rate_by(df.withColumn("lag_bin", lag_bin(days)), "lag_bin", label)
    every = _numbered(df, [name for _, _, name in LAG_BINS], "bin_order", "lag_bin")
    return every.join(found, "lag_bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def mean_and_count(df: DataFrame, key: str, value: str, min_count: int = 1, scale: float = 1.0) -> DataFrame:
    """Mean and non-null count per key, keys below ``min_count`` filtered after the aggregate."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg((F.avg(F.col(value).cast("double")) * scale).alias("mean"), F.count(value).alias("count"))
        .where(F.col("count") >= min_count)
    )


def exploded(df: DataFrame, list_column: str, keep: Sequence[str]) -> DataFrame:
    """One row per list element; an empty or null list gives one null row."""
    return df.select(F.explode_outer(list_column).alias(list_column), *keep)


def group_stats(df: DataFrame, keys: Sequence[str], value: str, prefix: str) -> DataFrame:
    """Mean, exact median and sample standard deviation per group (null for single rows)."""
    keys = list(keys)
    moments = (
        df.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys)
        .agg(F.avg(value).alias(f"{prefix}_mean"), F.stddev_samp(value).alias(f"{prefix}_std"))
    )
    medians = exact_quantiles(df, keys, value, {f"{prefix}_median": 0.5})
    return moments.join(medians, keys, "left").select(
        *keys, f"{prefix}_mean", f"{prefix}_median", f"{prefix}_std"
    )


def family_means(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Mean of every column per class, transposed to (feature, class, mean)."""
    means = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    return means.unpivot([label], list(columns), "feature", "mean")


def column_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    sums = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    return sums.unpivot([], list(columns), "feature", "total").orderBy(F.desc("total"), "feature")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, missing_only: bool = False) -> DataFrame:
    """Missing count and percentage per column, most missing first."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns],
    )
    long = counts.unpivot(["_rows"], columns, "column_name", "missing")
    out = long.select(
        "column_name",
        "missing",
        F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("_rows")), F.lit(0.0)).alias("missing_percent"),
    )
    if missing_only:
        out = out.where(F.col("missing") > 0)
    return out.orderBy(F.desc("missing"), "column_name")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max: one row per column."""
    long = long_form(df, columns)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    found = moments.join(exact_quantiles(long, ["feature"], "value", QUARTILES), "feature")
    return _with_empty(found, columns)


def _with_empty(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: columns without a single value get a count of 0 and nulls."""
    names = found.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = names.join(found, "feature", "left")
    return out.withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def describe_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency: one row per column."""
    counts = value_counts_by(long_form(df, columns, cast="string"), ["feature"], "value")
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("_best")
    summary = counts.groupBy("feature").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best
    )
    found = summary.select(
        "feature", "count", "unique", F.col("_best.value").alias("top"), (-F.col("_best.rank")).alias("freq")
    )
    return _with_empty(found, columns).withColumn("unique", F.coalesce("unique", F.lit(0).cast("bigint")))


def describe_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, min, quartiles and max of date columns, as dates (quartiles rounded down)."""
    days = df.select(*[F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).alias(c) for c in columns])
    numbers = describe_numeric(days, columns)
    as_date = {
        c: F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c).cast("int"))
        for c in ("mean", "min", "q25", "q50", "q75", "max")
    }
    return numbers.withColumns(as_date).drop("std")


def describe(df: DataFrame) -> DataFrame:
    """All columns in one table; statistics that do not apply are null. Lists, maps and structs count as their JSON text."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    df = df.withColumns({c: F.to_json(c) for c in nested})
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    dates = [f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    texts = [f.name for f in df.schema if f.name not in (*numeric, *dates)]
    parts = []
    if numeric:
        parts.append(describe_numeric(df, numeric))
    if texts:
        parts.append(describe_string(df, texts))
    if dates:
        parts.append(
            describe_dates(df, dates).select(
                "feature", "count", *[F.col(c).alias(f"date_{c}") for c in ("mean", "min", "q25", "q50", "q75", "max")]
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def monthly_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows per month end from the first to the last month, empty months as 0."""
    monthly = (
        df.where(F.col(date).isNotNull())
        .groupBy(F.last_day(date).alias("month_end"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    span = monthly.agg(F.trunc(F.min("month_end"), "MM").alias("a"), F.trunc(F.max("month_end"), "MM").alias("b"))
    starts = span.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start")
    )
    months = starts.select(F.last_day("month_start").alias("month_end"))
    return months.join(monthly, "month_end", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def weekday_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows per day of week, Monday first, days without rows as 0."""
    counts = df.groupBy(day_name(date).alias("day_of_week")).agg(F.count(F.lit(1)).alias("n"))
    week = _numbered(df, WEEKDAYS, "day_order", "day_of_week")
    return week.join(counts, "day_of_week", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _bounds(long: DataFrame, bins: int | None) -> DataFrame:
    """Per feature: range and bin count. ``bins=None`` takes the finer of Sturges and Freedman-Diaconis."""
    stats = long.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("rows")
    )
    if bins is not None:
        stats = stats.withColumn("bins", F.lit(bins))
    else:
        quartiles = exact_quantiles(long, ["feature"], "value", {"q25": 0.25, "q75": 0.75})
        span = F.col("hi") - F.col("lo")
        sturges = span / (F.log2(F.col("rows").cast("double")) + 1)
        diaconis = 2 * (F.col("q75") - F.col("q25")) / F.cbrt(F.col("rows").cast("double"))
        width = F.when(diaconis > 0, F.least(sturges, diaconis)).otherwise(sturges)
        stats = stats.join(quartiles, "feature").withColumn(
            "bins", F.greatest(F.lit(1), F.coalesce(F.ceil(F.try_divide(span, width)), F.lit(1))).cast("int")
        )
    flat = F.col("lo") == F.col("hi")
    return stats.select(
        "feature",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "bins",
    )


def bin_number(value: str | Column, lo: str, hi: str, bins: str) -> Column:
    """1-based equal-width bin; the largest value belongs to the last bin."""
    value = F.col(value) if isinstance(value, str) else value
    place = F.floor((value - F.col(lo)) / (F.col(hi) - F.col(lo)) * F.col(bins)) + 1
    return F.least(place, F.col(bins)).cast("int")


def histograms(df: DataFrame, columns: Sequence[str], bins: int | None = None, by: str | None = None) -> DataFrame:
    """Equal-width histograms of many columns in one pass, optionally per class; empty bins are 0."""
    keep = [by] if by else []
    long = long_form(df, columns, keep)
    bounds = _bounds(long, bins)
    counts = (
        long.join(F.broadcast(bounds), "feature")
        .withColumn("bin", bin_number("value", "lo", "hi", "bins"))
        .groupBy("feature", *keep, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.col("bins"))))
    if by:
        grid = grid.join(counts.select("feature", by).distinct(), "feature")
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    return grid.join(counts, ["feature", *keep, "bin"], "left").select(
        "feature",
        *keep,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_low"),
        (F.col("lo") + F.col("bin") * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid over the value range.

    Values are counted first, so the kernel is evaluated once per distinct value and point, and
    partial sums leave the mapper: ``points`` rows per task.
    """
    counts = value_counts_by(df.select(F.col(column).cast("double").alias("value")), [], "value")
    stats = (
        df.select(F.col(column).cast("double").alias("v"))
        .agg(
            F.struct(
                F.min("v").alias("lo"),
                F.max("v").alias("hi"),
                F.count("v").alias("rows"),
                F.stddev_samp("v").alias("sd"),
            )
        )
        .scalar()
    )
    ready = counts.withColumn("s", stats).select(
        "value",
        "n",
        F.col("s.lo").alias("lo"),
        ((F.col("s.hi") - F.col("s.lo")) / (points - 1)).alias("step"),
        F.col("s.rows").alias("rows"),
        (F.col("s.sd") * F.pow(F.col("s.rows").cast("double"), F.lit(-0.2))).alias("width"),
    )
    on_grid = ready.where(F.col("width") > 0).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    x = F.col("lo") + F.col("point") * F.col("step")
    z = (x - F.col("value")) / F.col("width")
    weight = F.col("n") * F.exp(-0.5 * z * z) / (F.col("rows") * F.col("width") * F.sqrt(F.lit(2.0) * F.pi()))
    return (
        on_grid.withColumns({"x": x, "_w": weight})
        .groupBy("point", "x")
        .agg(F.sum("_w").alias("density"))
    )


def binned_density(df: DataFrame, column: str, points: int = 200, cells: int = 4096) -> DataFrame:
    """:func:`density` from ``cells`` + 1 binned weights instead of every distinct value: (point, x, density).

    Each value shares its weight between the two grid lines around it; tasks send at most cells + 1 sums, and only those
    meet the points. With d the distance of the lines and h the bandwidth, no point is off by more than
    d * d / (8 * sqrt(2 * pi) * h ** 3). Nulls are left out; no values, one value or equal values give no rows.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    stats = values.agg(
        F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("rows"), F.stddev_samp("v").alias("sd"))
    ).scalar()
    gap = (F.col("s.hi") - F.col("s.lo")) / cells
    place = (F.col("v") - F.col("s.lo")) / gap
    line = F.least(F.floor(place), F.lit(cells - 1)).cast("int")
    sides = F.array(
        F.struct(line.alias("line"), (1 - (place - line)).alias("w")), F.struct((line + 1).alias("line"), (place - line).alias("w"))
    )
    placed = values.withColumn("s", stats).where(F.col("s.hi") > F.col("s.lo")).select(F.inline(sides))
    weights = placed.groupBy("line").agg(F.sum("w").alias("w"))
    grid = weights.withColumn("s", stats).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("s.lo") + F.col("point") * ((F.col("s.hi") - F.col("s.lo")) / (points - 1))
    width = F.col("s.sd") * F.pow(F.col("s.rows").cast("double"), F.lit(-0.2))
    z = (x - (F.col("s.lo") + F.col("line") * gap)) / width
    kernel = F.exp(-0.5 * z * z) / (F.col("s.rows") * width * F.sqrt(F.lit(2.0) * F.pi()))
    return grid.withColumn("x", x).groupBy("point", "x").agg(F.sum(F.col("w") * kernel).alias("density"))


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 inter-quartile ranges, and the number of points outside."""
    keys = list(keys)
    quartiles = exact_quantiles(df, keys, value, QUARTILES)
    counts = value_counts_by(df, keys, value)
    joined = lookup_join(counts, quartiles, keys, [value])
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (F.col(value) >= F.col("q25") - reach) & (F.col(value) <= F.col("q75") + reach)
    return joined.groupBy(*keys).agg(
        F.first("q25").alias("q25"),
        F.first("q50").alias("q50"),
        F.first("q75").alias("q75"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
    )


def clip_to_quantile(df: DataFrame, column: str, q: float = 0.95) -> DataFrame:
    """Rows within 0 and the exact q-quantile of the column."""
    top = exact_quantiles(df, [], column, {"top": q}).scalar()
    return df.where((F.col(column) >= 0) & (F.col(column) <= top))


def activity_counts(df: DataFrame, user: str) -> DataFrame:
    """Rows per user."""
    return value_counts(df, user)


def activity_distribution(df: DataFrame, user: str, bins: int = 50) -> DataFrame:
    """Histogram of rows per user."""
    return histograms(activity_counts(df, user), ["n"], bins)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """Counts on a bins-by-bins grid over the non-null pairs, optionally per class."""
    keep = [by] if by else []
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *keep).dropna(
        subset=["x", "y"]
    )
    stats = pairs.agg(
        F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    ).scalar()
    ready = pairs.withColumn("s", stats).select(
        "x", "y", *keep, F.col("s.x0"), F.col("s.x1"), F.col("s.y0"), F.col("s.y1"), F.lit(bins).alias("bins")
    )
    return (
        ready.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
        .withColumns({"bin_x": bin_number("x", "x0", "x1", "bins"), "bin_y": bin_number("y", "y0", "y1", "bins")})
        .groupBy("bin_x", "bin_y", *keep)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hash_sample(df: DataFrame, id_col: str, rows: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of a fixed size: the rows with the smallest hash of (seed, id)."""
    order = F.xxhash64(F.lit(seed), id_col)
    return df.withColumn("_order", order).orderBy("_order", id_col).limit(rows).drop("_order")


def cumulative_share(df: DataFrame, order: str, value: str, threshold: float = 0.95) -> DataFrame:
    """Running share of the total over a unique order column, and the first row that reaches the threshold."""
    run = running_totals(df.select(order, value), [], order, [value])
    before = F.col(f"{value}_before") / F.col(f"{value}_total")
    after = (F.col(f"{value}_before") + F.col(value)) / F.col(f"{value}_total")
    return run.select(
        order,
        value,
        after.alias("cumulative"),
        ((after >= threshold) & (before < threshold)).alias("is_cut"),
    )
