"""Pipeline stages that are saved with the tables, models and arrays they hold."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _kind(part: Any) -> str:
    if isinstance(part, DataFrame):
        return "table"
    return "array" if isinstance(part, np.ndarray) else "stage"


def save_part(spark: SparkSession, part: Any, path: str, folders: Sequence[str] = ()) -> None:
    """A table as Parquet (one folder per value of ``folders``), a matrix as one Parquet row per matrix row, the rest by its own writer."""
    if isinstance(part, DataFrame):
        rows = part.repartition(*folders) if folders else part
        rows.write.partitionBy(*folders).parquet(path)
    elif isinstance(part, np.ndarray):
        rows = pd.DataFrame({"i": range(len(part)), "x": [np.ravel(r).tolist() for r in part]})
        spark.createDataFrame(rows, "i long, x array<double>").coalesce(1).write.parquet(path)
    else:
        part.write().save(path)


def load_part(spark: SparkSession, kind: str, path: str) -> Any:
    if kind == "table":
        return spark.read.parquet(path)
    if kind == "array":
        rows = spark.read.schema("i long, x array<double>").parquet(path).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("r")).first()["r"]
        return np.array([r["x"] for r in rows])
    return DefaultParamsReader.loadParamsInstance(path, spark)


class PartsWriter(MLWriter):
    """Params as metadata, and each part in a folder of its own beside it."""

    def __init__(self, stage: Any) -> None:
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        parts = self.stage.parts
        kinds = {name: _kind(part) for name, part in parts.items()}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, {"parts": kinds})
        for name, part in parts.items():
            save_part(self.sparkSession, part, f"{path}/part_{name}", self.stage.partitioned.get(name, ()))


class PartsReader(MLReader):
    def __init__(self, kind: type) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> Any:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.parts = {n: load_part(self.sparkSession, kind, f"{path}/part_{n}") for n, kind in metadata["parts"].items()}
        return stage


class Persisted(MLReadable, MLWritable):
    """Mixin for a stage whose state is its Params and ``parts``: tables, fitted stages and matrices by name.

    A loaded stage reads its tables from the folder it was loaded from. Matrices pass through the driver, so they
    must be bounded by parameters (features x components). ``partitioned`` names the columns a table is kept in folders by. The class is made without arguments when it is loaded.
    """

    parts: dict[str, Any] = {}
    partitioned: dict[str, list[str]] = {}

    def write(self) -> MLWriter:
        return PartsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return PartsReader(cls)
