import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.operators import knn


def test_predictions_are_made_within_blocks(spark, monkeypatch):
    rng = random.Random(5)
    # many queries below one leaf, and ties
    spot = lambda i: (2.0, 3.0) if i % 3 == 0 else (float(rng.randrange(12)), float(rng.randrange(9)))
    rows = [(i, *spot(i), rng.random(), i % 4) for i in range(500)]
    train = spark.createDataFrame(rows, "id long, a double, b double, y double, fold int")
    asked = [(i, 2 + rng.random() / 9, 3 + rng.random() / 9) if i % 2 else (i, *spot(i)) for i in range(300)]
    queries = spark.createDataFrame([*asked, (900, None, 1.0)], "id long, a double, b double").withColumn("f", (F.col("id") % 4).cast("int"))
    for name, value in (("BLOCK_ROWS", 32), ("BLOCK_BITS", 3), ("PLACED_ROWS", 50), ("TOGETHER_CELLS", 1 << 8)):
        monkeypatch.setattr(knn, name, value)
    model = knn.fit_knn(train, ["a", "b"], "y", row_id="id", k_max=40, fold="fold")
    for fold in (None, "f"):
        predicted = knn.knn_predict(model, queries, query_id="id", ks=[1, 7, 40], fold=fold)
        # no window over stored pairs of query and neighbour
        assert "Window" not in predicted._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.id, r.k, r.weights): r.prediction for r in predicted.collect()}
        assert len(got) == 301 * 6 and got[900, 7, "uniform"] is None
        values = np.array(rows)
        # the same scaling to the last bit, as ties go by the id
        x = (values[:, 1:3] - np.array(model.means)) / np.array(model.deviations)
        for i, a, b in asked:
            own = (np.array([a, b]) - np.array(model.means)) / np.array(model.deviations)
            usable = np.flatnonzero(values[:, 4] != i % 4) if fold else np.arange(500)
            distance = np.sqrt(((x[usable] - own) ** 2).sum(axis=1))
            for k in (1, 7, 40):
                near = np.lexsort((usable, distance))[:k]
                d, y = distance[near], values[usable[near], 3]
                w = (d == 0).astype(float) if d[0] == 0 else 1 / d
                assert got[i, k, "uniform"] == pytest.approx(y.mean())
                assert got[i, k, "distance"] == pytest.approx((w * y).sum() / w.sum())
