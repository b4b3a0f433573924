"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts differ in length by orders of magnitude: batches are bounded by bytes, so that Python workers stay small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def ship_code() -> None:
    """Send this package's functions to the Python workers inside the tasks.

    Executors then need no copy of the package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules["tamarack"])


def get_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tamarack")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TAMARACK_DRIVER_MEMORY", "12g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    ship_code()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    ship_code()
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a private one only for a local master without any."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tamarack-checkpoints-")
    sc.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession) -> str:
    """A new folder name below the shared one."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tamarack-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back.

    Lost executors then cost no recompute, and later readers decode only the columns they use.
    """
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_by_bytes(table: DataFrame, each: int = 16 * 2**20) -> int:
    """Partitions that a written table deserves by its bytes."""
    return max(1, -(-int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // each))


def _bytes(value: str) -> int:
    """A size setting such as 128MB or 16m in bytes."""
    number = value.strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if unit else number) << unit


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by ``keys`` only when the input has fewer splits than the cluster has slots.

    Text work is CPU bound: a file that arrives as one split would keep one core busy. The splits
    are estimated from the plan's size; nothing is executed.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    split = _bytes(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df if size >= slots * split else df.repartition(slots, *keys)
