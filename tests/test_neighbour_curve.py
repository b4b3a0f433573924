"""The learning curve of nearest neighbours from shared distances against one model per share and fold."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tamarack.operators import neighbours, tuning
from tamarack.session import cut_lineage


@pytest.mark.parametrize("k, weighting, metric", [(3, "distance", "euclidean"), (4, "uniform", "manhattan"), (6, "distance", "chebyshev")])
def test_shared_distances_give_the_curve_of_single_models(spark, monkeypatch, k, weighting, metric):
    rng = np.random.default_rng(k)
    points = np.round(rng.normal(size=(160, 3)), 1)
    points[100:130] = points[:30]  # copies: ties, and distances of 0
    rows = [(int(i * 7 % 160), int(rng.random() < 0.3 + 0.4 * (p[0] > 0)), p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "row_id bigint, label int, x array<double>")
    frame = cut_lineage(frame.select("row_id", "label", array_to_vector("x").alias("features")))
    fit = tuning.Neighbours(k, weighting, metric)
    monkeypatch.setattr(neighbours, "CURVE_VALUES", 1000)
    want = tuning.learning_curve(lambda f: fit(f), frame, shares=(0.03, 0.4, 1.0), folds=2).collect()
    monkeypatch.setattr(tuning, "nearest_neighbours", None)  # no model is built
    got = tuning.learning_curve(fit, frame, shares=(0.03, 0.4, 1.0), folds=2).collect()
    assert [list(r) for r in got] == [pytest.approx(list(r)) for r in want]
