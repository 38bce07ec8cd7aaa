import random

import numpy as np
import pytest

from curbline.operators import ensembles

FEATURES = {"a": "a", "b": "b"}


def test_many_rows_make_small_parts(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random()) for i in range(200)]
    train = spark.createDataFrame([(i, a, b, 3 * a + b) for i, a, b in rows], "id long, a double, b double, y double")
    monkeypatch.setattr(ensembles, "PART_ROWS", 450)
    forest = ensembles.fit_forest(train, "y", FEATURES, trees=9, max_depth=4)
    assert forest.trees == (2, 2, 2, 2, 1)  # 200 rows times 2 trees
    each = [ensembles.StoredForest((p,), (n,), forest.expressions) for p, n in zip(forest.paths, forest.trees)]
    parts = [[r.prediction for r in p.transform(train).orderBy("id").collect()] for p in each]
    got = [r.prediction for r in forest.transform(train).orderBy("id").collect()]
    assert got == pytest.approx(np.average(parts, axis=0, weights=forest.trees))
    want = np.average([p.importances() for p in each], axis=0, weights=forest.trees)
    assert forest.importances() == pytest.approx(want)


def test_parts_are_as_before_on_few_rows():
    assert [ensembles.largest_part(n) for n in (0, 14_700, 88_288, 10_000_000)] == [25, 25, 4, 1]
    forest = ensembles.StoredForest(tuple("abcdefg"), (25, 25, 4, 4, 4, 4, 4), ())
    assert forest._held_together() == [[0], [1], [2, 3, 4, 5], [6]]
