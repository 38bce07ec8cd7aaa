import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.operators import knn, models


def brute(x, y, fold, left_out, asked, k, scheme):
    """Squared errors of the asked rows, from all rows outside the fold left out."""
    rows = np.flatnonzero(fold != left_out)
    out = []
    for q in asked:
        distance = np.sqrt(((x[rows] - x[q]) ** 2).sum(axis=1))
        near = np.lexsort((rows, distance))[:k]
        d, v = distance[near], y[rows][near]
        w = np.ones(k) if scheme == "uniform" else (d == 0).astype(float) if d[0] == 0 else 1 / d
        out.append((y[q] - (w * v).sum() / w.sum()) ** 2)
    return np.mean(out)


def test_train_scores_equal_brute_force_and_store_no_pairs(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        # a grid gives ties and equal vectors within and between folds; a third stands in one place
        a, b = (2.0, 3.0) if i % 3 == 0 else (float(rng.randrange(12)), float(rng.randrange(9)))
        rows.append((i, a, b, rng.random(), i % 5))
    train = spark.createDataFrame(rows, "id long, a double, b double, y double, fold int")
    errors, fitted = [], []
    whole = knn.knn_fold_errors

    def kept(model, *args, **options):
        fitted.append(model)
        errors.append(whole(model, *args, **options))
        return errors[-1]

    monkeypatch.setattr(knn, "knn_fold_errors", kept)
    monkeypatch.setattr(knn, "TOGETHER_CELLS", 1 << 12)
    ks = [1, 4, 90]
    found = models.grid_search_knn(train, "y", row_id="id", fold="fold", ks=ks, features=("a", "b"), train_scores=True)
    got = {(r.k, r.weights): (r.val_mse, r.train_mse) for r in found.collect()}
    values = np.array(rows)
    # the same scaling to the last bit, as ties go by the id
    x = (values[:, 1:3] - np.array(fitted[0].means)) / np.array(fitted[0].deviations)
    y, fold = values[:, 3], values[:, 4]
    assert set(got) == {(k, w) for k in ks for w in knn.WEIGHTS}
    for (k, scheme), scores in got.items():
        for score, of_fold in zip(scores, (np.equal, np.not_equal)):
            want = np.mean([brute(x, y, fold, f, np.flatnonzero(of_fold(fold, f)), k, scheme) for f in range(5)])
            assert score == pytest.approx(want, rel=1e-9)
    # ranking happens within the blocks: no window over stored pairs of query and neighbour
    assert len(errors) == 1 and "Window" not in errors[0]._jdf.queryExecution().optimizedPlan().toString()
    assert errors[0].where(F.col("held")).agg(F.sum("n")).first()[0] == 600 * len(ks) * 2


def test_a_search_stores_no_pairs_and_asks_each_row_of_an_id_for_each_label(spark, monkeypatch):
    rng = random.Random(6)
    # five rows share the id 1000, three have none
    keys = [1000 if i % 60 == 1 else None if i % 90 == 2 else i for i in range(300)]
    rows = [(key, float(rng.randrange(12)), float(rng.randrange(9)), rng.random(), (key or i) % 5) for i, key in enumerate(keys)]
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    train = spark.createDataFrame(rows, "id long, a double, b double, y double, fold int")
    plans, fitted, whole = [], [], knn.knn_fold_errors

    def kept(model, *args, **options):
        fitted.append(model)
        plans.append(whole(model, *args, **options))
        return plans[-1]

    monkeypatch.setattr(knn, "knn_fold_errors", kept)
    found = models.grid_search_knn(train, "y", row_id="id", fold="fold", ks=[2, 31], features=("a", "b"))
    got = {(r.k, r.weights): r for r in found.collect()}
    values = np.array([(np.nan if r[0] is None else r[0], *r[1:]) for r in rows])
    x = (values[:, 1:3] - np.array(fitted[0].means)) / np.array(fitted[0].deviations)
    y, fold, pairs = values[:, 3], values[:, 4], [(i, j) for i, r in enumerate(rows) for j, s in enumerate(rows) if r[0] is not None and r[0] == s[0]]
    assert len(pairs) > len(rows)
    for (k, scheme), row in got.items():
        errors = {f: [] for f in range(5)}
        for i, j in pairs:
            usable = np.flatnonzero(fold != fold[i])
            distance = np.sqrt(((x[usable] - x[i]) ** 2).sum(axis=1))
            near = np.lexsort((usable, distance))[:k]  # by distance, then by id, none first
            d, v = distance[near], y[usable[near]]
            w = np.ones(k) if scheme == "uniform" else (d == 0).astype(float) if d[0] == 0 else 1 / d
            errors[int(fold[j])].append((y[j] - (w * v).sum() / w.sum()) ** 2)
        assert row.val_mse == pytest.approx(np.mean([np.mean(e) for e in errors.values()]), rel=1e-9) and row.train_mse is None
    assert len(got) == 4 and "Window" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()
