"""What one task takes on does not grow with the table."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tamarack.operators import blocks, factors, selection


def test_ranks_of_more_rows_are_more_tasks_and_one_sort(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 200)
    monkeypatch.setattr(selection, "TASK_ROWS", 500)
    rows = spark.range(6000).select("id", F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(900)) / 8.0).alias("v"))
    rows = rows.withColumn("v", F.when(F.col("id") == 1, float("nan")).when(F.col("id") == 2, float("inf")).when(F.col("id") == 3, -0.0).otherwise(F.col("v")))
    ranked = selection.percentile_rank(rows, [], "v", "pct", ["id"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    ranking = plan[plan.index("Window [") :]
    assert "REPARTITION_BY_NUM" in ranking and "ENSURE_REQUIREMENTS" not in ranking[: ranking.index("REPARTITION_BY_NUM")]
    assert ranking[: ranking.index("REPARTITION_BY_NUM")].count("Sort [") == 1
    got = ranked.orderBy("id").toPandas()
    value = rows.orderBy("id").toPandas()["v"]
    known = spark.range(6000).count() - rows.where("v is null").count()
    plain = rows.select(F.col("v").isNull().alias("n")).toPandas()["n"]
    order = pd.Series(np.where(value.isna(), np.inf, value)).where(~plain | (got["id"] == 1))
    want = order.copy()
    want[1] = 1e9  # not a number comes after infinity
    want[2] = 1e8
    want = want.replace(0.0, 0.0).rank(method="average") / known
    assert np.allclose(got["pct"], want, equal_nan=True)


def test_large_blocks_are_added_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MERGE_BYTES", 64)
    calls, real = [], type(spark.range(1).groupBy("id")).applyInPandas

    def seen(self, *args, **kwargs):
        calls.append(1)
        return real(self, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "applyInPandas", seen)
    part = np.arange(4.0)
    rows = spark.range(0, 9, 1, 9).select(F.lit(part.tobytes()).alias("m"))
    assert blocks.sum_blocks(rows, 9, (4,)).tolist() == (9 * part).tolist()
    assert len(calls) == 3  # 9, 5, 3, 2: two blocks of 32 bytes a task


def test_svd_reads_its_rows_from_a_written_table(spark, monkeypatch):
    written, cut = [], factors.cut_lineage
    monkeypatch.setattr(factors, "cut_lineage", lambda df: written.append(1) or cut(df))
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(i, Vectors.sparse(3, [i % 3], [1.0 + i % 2])) for i in range(12)], ["id", "v"])
    fitted = factors.fit_svd(rows, "v", 3, 2)
    assert written and np.allclose(fitted.singular_values, np.sqrt([10.0, 10.0]))
