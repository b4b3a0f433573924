"""Adding up one small matrix per input split."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 32

#: Bytes that one adding task should read; large blocks are added fewer at a time.
MERGE_BYTES = 32 * 2**20


def sum_blocks(partials: DataFrame, count: int, shape: tuple[int, ...]) -> np.ndarray:
    """Sum ``count`` rows of ``m binary`` (float64 arrays of one shape).

    Tasks add up to ``FAN_IN`` of them at a time, or as many as ``MERGE_BYTES`` hold, level by level; the driver adds the last few.
    """
    fan_in = min(FAN_IN, max(2, MERGE_BYTES // (8 * int(np.prod(shape)))))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(shape)
        for raw in pdf["m"]:
            total += np.frombuffer(raw).reshape(shape)
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0])], "m": [total.tobytes()]})

    level = partials.select(F.spark_partition_id().alias("slot"), "m")
    while count > fan_in:
        count = -(-count // fan_in)
        level = (
            level.withColumn("slot", F.pmod("slot", F.lit(count)))
            .groupBy("slot")
            .applyInPandas(merge, "slot int, m binary")
        )
    total = np.zeros(shape)
    for row in level.select("m").collect():
        total += np.frombuffer(row.m).reshape(shape)
    return total
