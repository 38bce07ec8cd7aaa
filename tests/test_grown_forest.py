import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.operators import ensembles, grown_forest, models
from curbline.session import scratch_path

FEATURES = {c: c for c in "abcd"}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 3000
    a, b, c = rng.normal(size=n), rng.integers(0, 2, n).astype(float), rng.integers(0, 9, n).astype(float)
    y = np.round(np.sin(3 * a) + b * a + (c > 4) + rng.normal(scale=0.3, size=n), 3)
    rows = [(i, *map(float, v)) for i, v in enumerate(zip(a, b, c, np.ones(n), y))]
    rows += [(n + i, 0.5, 1.0, 3.0, 1.0, 2.0) for i in range(500)]  # many equal rows
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double")
    path = scratch_path(spark, "table")
    df.repartition(5, "id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def grown(monkeypatch):
    monkeypatch.setattr(ensembles, "GROWN_ROWS", 1000)
    for name, value in (("LOCAL_ROWS", 300), ("CHUNK_ROWS", 700), ("HELD_NODES", 900), ("SLAB_ROWS", 400), ("TABLE_ROWS", 900)):
        monkeypatch.setattr(grown_forest, name, value)


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize(("min_leaf", "max_depth"), [(5, 30), (1, 4), (40, 9)])
def test_a_tree_on_all_rows_is_that_of_spark(spark, table, grown, min_leaf, max_depth):
    options = {"trees": 1, "min_leaf": min_leaf, "max_depth": max_depth, "bootstrap": False}
    forest = ensembles.fit_forest(table, "y", FEATURES, **options)
    assert isinstance(forest, grown_forest.GrownForest)
    stored = spark.read.parquet(f"{forest.folder}/trees")
    assert stored.where("node >= 0").count()  # the top grew level by level, the rest below it
    same = models.fit_trees(table, models.random_forest("y", **options), FEATURES)
    got, want = predictions(forest, table), predictions(same, table)
    # equally good splits may differ
    assert np.mean(np.abs(got - want) > 1e-9) < 0.02
    y = np.array([r.y for r in table.orderBy("id").collect()])
    assert np.mean((got - y) ** 2) == pytest.approx(np.mean((want - y) ** 2), rel=1e-3)
    # Spark weighs the variance removed by its rows
    assert forest.importances() == pytest.approx(same.stages[-1].featureImportances.toArray(), abs=5e-3)


def test_where_trees_are_cut_makes_no_difference(table, grown, monkeypatch):
    options = {"trees": 3, "min_leaf": 3, "max_depth": 12}
    cut = ensembles.fit_forest(table, "y", FEATURES, **options)
    monkeypatch.setattr(grown_forest, "LOCAL_ROWS", 1 << 16)
    whole = ensembles.fit_forest(table.repartition(3), "y", FEATURES, **options)
    monkeypatch.setattr(grown_forest, "TABLE_ROWS", 1 << 16)
    sent = ensembles.fit_forest(table.repartition(2), "y", FEATURES, **options)
    for forest in (whole, sent):
        assert predictions(cut, table) == pytest.approx(predictions(forest, table), abs=1e-9)
        assert cut.importances() == pytest.approx(forest.importances(), abs=1e-9)


def test_a_grown_forest_is_no_worse_than_fitted_parts(spark, table, grown, monkeypatch):
    seen, held = table.where("id % 4 > 0"), table.where("id % 4 = 0")
    forest = ensembles.fit_forest(seen, "y", FEATURES, trees=30)
    parts = models.fit_trees(seen, models.random_forest("y", trees=30), FEATURES)
    y = np.array([r.y for r in held.orderBy("id").collect()])
    errors = [np.mean((predictions(f, held) - y) ** 2) for f in (forest, parts)]
    assert errors[0] == pytest.approx(errors[1], rel=0.1)
    assert forest.importances() == pytest.approx(parts.stages[-1].featureImportances.toArray(), abs=0.03)
    # stored, loaded and applied; rerun with the rows laid out otherwise
    folder = scratch_path(spark, "models")
    models.save_model(forest, folder, "random_forest", spark)
    loaded = models.load_model(folder, "random_forest", spark)
    assert predictions(loaded, held) == pytest.approx(predictions(forest, held), abs=0)
    again = ensembles.fit_forest(seen.repartition(7), "y", FEATURES, trees=30)
    assert predictions(again, held) == pytest.approx(predictions(forest, held), abs=1e-9)
    table_ = models.feature_importances(loaded, FEATURES, spark).collect()
    assert [r.feature for r in table_][0] == "a" and sum(r.importance for r in table_) == pytest.approx(1)


def test_rows_of_one_label_give_one_leaf(spark, grown):
    flat = spark.range(1500).selectExpr("id", "id * 1D as a", "0D as b", "0D as c", "0D as d", "0.3D as y")
    forest = ensembles.fit_forest(flat, "y", FEATURES, trees=2)
    assert predictions(forest, flat) == pytest.approx(0.3) and not forest.importances().any()
    assert spark.read.parquet(f"{forest.folder}/trees").agg(F.sum("nodes")).first()[0] == 2


def test_searches_score_forests_of_the_whole_grid(table, grown, monkeypatch):
    folds, grid = table.withColumn("fold", (F.col("id") % 3).cast("int")), {"trees": [10, 30], "min_leaf": [5, 60]}
    sent = ensembles.forest_scores(folds, "y", FEATURES, fold="fold", **grid)
    again = ensembles.forest_scores(folds.repartition(4), "y", FEATURES, fold="fold", **grid)
    monkeypatch.setattr(ensembles, "TABLE_ROWS", 2000)
    one_fold = {"fold": "fold", "trees": [10, 30], "min_leaf": [60]}
    spread = ensembles.forest_scores(folds, "y", FEATURES, **one_fold)
    assert set(sent) == {(t, m, f) for t in (10, 30) for m in (5, 60) for f in range(3)} and set(spread) < set(sent)
    for key, errors in spread.items():
        for held in (True, False):
            assert sent[key][held] == pytest.approx(errors[held], rel=0.05)
    assert all(again[key] == pytest.approx(sent[key]) for key in sent)
    one = models.fit_trees(folds.where("fold <> 1"), models.random_forest("y", trees=30, min_leaf=60), FEATURES)
    want = one.transform(folds.where("fold = 1")).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert sent[30, 60, 1][True] == pytest.approx(want, rel=0.05)
    assert sent[30, 5, 1][False] < sent[30, 60, 1][False]  # smaller leaves fit the rows they have seen more closely
