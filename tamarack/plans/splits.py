"""From engineered features to scaled, split, rebalanced and reduced training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.functions.constants import NON_FEATURES
from tamarack.operators.clean import encode_strings, fill_missing, label_to_int
from tamarack.operators.factors import ReducedModel, fit_pca
from tamarack.operators.profile import value_counts
from tamarack.operators.resample import smote
from tamarack.operators.scaling import Scaler, assemble, fit_scaler
from tamarack.operators.splitting import with_split
from tamarack.session import cut_lineage
from tamarack.sources.writers import run_metadata, write_split


@dataclass
class Prepared:
    """(row_id, label, features, split) per variant, and what was fitted on the way."""

    variants: dict[str, tuple[DataFrame, DataFrame]]
    scaler: Scaler
    pca: ReducedModel
    feature_names: list[str]
    metadata: DataFrame = field(repr=False, default=None)


def feature_table(final: DataFrame, id_col: str, label: str = "is_spoiler") -> tuple[DataFrame, list[str]]:
    """(row_id, label, numeric features): texts and identifiers dropped, strings and lists coded."""
    present = set(final.columns)
    blanks = {c: "" for c in ("review_summary", "plot_synopsis", "plot_summary") if c in present}
    table = fill_missing(label_to_int(final, label), blanks)
    if "genre" in present:
        genre = F.col("genre")
        if isinstance(final.schema["genre"].dataType, T.ArrayType):
            genre = F.to_json(genre)
        table = table.withColumn("genre", F.coalesce(genre, F.lit("Unknown")))
    drop = [c for c in NON_FEATURES if c != label]
    table = table.drop(*drop).withColumnRenamed(id_col, "row_id").withColumnRenamed(label, "label")
    strings = [f.name for f in table.schema if isinstance(f.dataType, T.StringType)]
    table = encode_strings(table, "row_id", strings) if strings else table
    names = [c for c in table.columns if c not in ("row_id", "label")]
    return table.select("row_id", "label", *names), names


def prepare(
    final: DataFrame,
    id_col: str = "review_id",
    label: str = "is_spoiler",
    test_share: float = 0.2,
    fit_on: str = "train",
    neighbours: int = 4,
    seed: int = 42,
) -> Prepared:
    """Base, smote and smote_pca variants. ``final`` should be a written table: it is read several times.

    ``fit_on='train'`` keeps the test rows out of the scaler; ``'all'`` fits it on every row.
    """
    table, names = feature_table(final, id_col, label)
    raw = cut_lineage(assemble(table, names, "_raw").select("row_id", "label", "_raw"))
    marked = cut_lineage(with_split(raw, "label", "row_id", test_share, seed))
    scaler = fit_scaler(marked if fit_on == "all" else marked.where("split = 'train'"), "_raw")
    scaled = scaler.transform(marked, "_raw", "features").select("row_id", "label", "features", "split")
    train = scaled.where("split = 'train'").drop("split")
    test = scaled.where("split = 'test'").drop("split")

    arrays = train.withColumn("features", vector_to_array("features"))
    grown = cut_lineage(
        smote(arrays, "row_id", "features", "label", neighbours, seed).withColumn(
            "features", array_to_vector("features")
        ).drop("is_synthetic")
    )
    pca = fit_pca(grown, "features", "_reduced")

    def reduce(df: DataFrame) -> DataFrame:
        return pca.transform(df).select("row_id", "label", F.col("_reduced").alias("features"))

    prepared = Prepared(
        {"base": (train, test), "smote": (grown, test), "smote_pca": (reduce(grown), reduce(test))}, scaler, pca, names
    )
    prepared.metadata = run_metadata(
        (raw.count(), len(final.columns)),
        names,
        pca.components,
        float(np.cumsum(pca.ratios)[pca.components - 1]),
        {
            "original": value_counts(raw, "label"),
            "train": value_counts(train, "label"),
            "train_smote": value_counts(grown, "label"),
            "test": value_counts(test, "label"),
        },
        "label",
    )
    return prepared


def write_variants(prepared: Prepared, path: str) -> None:
    """One dataset partitioned by variant and split."""
    for variant, (train, test) in prepared.variants.items():
        write_split(train, path, variant, "train")
        write_split(test, path, variant, "test")
