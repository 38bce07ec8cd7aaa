import inspect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.checks import model_queries, registry
from curbline.functions.transforms import strip_name_prefix
from curbline.operators import ensembles, knn, linear, models, sparse_linear, splits
from curbline.plans import modelling
from curbline.session import scratch_path
from curbline.sources import sinks


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        a, b, c = rng.uniform(0, 10), rng.gauss(0, 3), rng.choice([0.0, 1.0])
        rows.append((i, a, b, c, 3.0 + 2.0 * a - 1.5 * b + 0.5 * c + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    return splits.with_fold(df, "id").cache()


def arrays(df):
    rows = df.orderBy("id").collect()
    x = np.array([[r.a, r.b, r.c] for r in rows])
    return x, np.array([r.y for r in rows]), np.array([r.fold for r in rows])


def test_least_squares_recovers_coefficients(spark, table):
    fitted = models.fit_linear(table, "y", {"a": "a", "b": "b", "c": "c"})
    x, _, _ = arrays(table)
    slopes = fitted.stages[-1].coefficients.toArray() / x.std(axis=0)
    assert slopes == pytest.approx([2.0, -1.5, 0.5], abs=0.05)
    names = [r.feature for r in models.coefficient_table(fitted, {"a": "a", "b": "b", "c": "c"}, spark).collect()]
    assert names[-1] == "c"


def test_cross_validation_matches_numpy(table):
    x, y, fold = arrays(table)
    got = {r.fold: (r.mse, r.r2) for r in linear.cross_val_linear(table, ["a", "b", "c"], "y", "fold").collect()}
    for f in range(5):
        train, test = fold != f, fold == f
        w = np.linalg.lstsq(np.c_[np.ones(train.sum()), x[train]], y[train], rcond=None)[0]
        error = y[test] - np.c_[np.ones(test.sum()), x[test]] @ w
        mse = (error**2).mean()
        assert got[f] == pytest.approx((mse, 1 - mse / y[test].var()))


def test_mean_model_scores_the_variance(table):
    fitted = models.fit_mean(table, "y")
    _, y, _ = arrays(table)
    assert fitted.transform(table).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] == pytest.approx(y.var())


def test_lasso_path_meets_the_optimality_conditions(table):
    x, y, _ = arrays(table)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    for row in linear.lasso_path(table, ["a", "b", "c"], "y", "fold", [1e-6, 0.1, 1.0, 100.0]).collect():
        w = np.array([row.w_a, row.w_b, row.w_c])
        gradient = z.T @ (y - y.mean() - z @ w) / len(y)
        for g, v in zip(gradient, w):
            assert abs(g) <= row.alpha + 1e-6 if v == 0 else g == pytest.approx(math.copysign(row.alpha, v), abs=1e-6)
        assert row.train_mse == pytest.approx(((y - y.mean() - z @ w) ** 2).mean())


def brute_knn(train, queries, ks, same_fold_out=False):
    xs = np.array([r[1] for r in train])
    mean, dev = xs.mean(axis=0), xs.std(axis=0)
    dev[dev == 0] = 1.0
    result = {}
    for q, vector, fold in queries:
        near = sorted(
            (float(np.sqrt((((np.array(v) - vector) / dev) ** 2).sum())), i, y)
            for i, v, y, f in train if not (same_fold_out and f == fold)
        )
        for k in ks:
            chosen = near[:k]
            result[q, k, "uniform"] = sum(c[2] for c in chosen) / k
            exact = [c[2] for c in chosen if c[0] == 0]
            weights = sum(1 / c[0] for c in chosen) if not exact else None
            result[q, k, "distance"] = (
                sum(exact) / len(exact) if exact else sum(c[2] / c[0] for c in chosen) / weights
            )
    return result


@pytest.mark.parametrize("folds", [False, True])
def test_knn_matches_brute_force(spark, folds):
    rng = random.Random(4)
    rows = []
    for i in range(260):
        vector = [rng.gauss(0, 1), rng.gauss(5, 2), rng.expovariate(0.2)]
        if i % 4 == 0:
            vector = [1.0, 5.0, 2.0]  # many identical rows
        if i % 7 == 3:
            vector = [v + rng.random() * 1e-6 for v in (3.0, 3.0, 3.0)]  # a crowded spot
        rows.append((i, vector, rng.random(), i % 5))
    schema = "id long, a double, b double, c double, y double, fold int"
    train = spark.createDataFrame([(i, *v, y, f) for i, v, y, f in rows], schema)
    if folds:
        queries = [(i, v, f) for i, v, _, f in rows]
    else:
        queries = [(1000 + i, [rng.gauss(0, 1), rng.gauss(5, 2), rng.expovariate(0.2)], -2) for i in range(40)]
        queries += [(2000, [1.0, 5.0, 2.0], -2), (2001, [500.0, -90.0, 3000.0], -2), (2002, [3.0, 3.0, 3.0], -2)]
    asked = spark.createDataFrame([(q, *v, 0.0, f) for q, v, f in queries], schema)
    fold = "fold" if folds else None
    fitted = knn.fit_knn(train, ["a", "b", "c"], "y", row_id="id", k_max=20, fold=fold)
    ks = [1, 5, 20]
    got = knn.knn_predict(fitted, asked, query_id="id", ks=ks, fold=fold).collect()
    want = brute_knn(rows, queries, ks, folds)
    assert {(r.id, r.k, r.weights) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert r.prediction == pytest.approx(want[r.id, r.k, r.weights], rel=1e-6)


@pytest.mark.parametrize("where", ["inside", "outside", "clustered", "between clusters"])
def test_knn_compares_a_small_multiple_of_k_rows(spark, where):
    rng, k = np.random.default_rng(5), 25
    spots = np.array([[0.0, 0, 0], [1, 1, 1]])
    rows = rng.uniform(0, 1, (8000, 3))
    if where in ("clustered", "between clusters"):
        rows[400:] = spots[rng.integers(0, 2, 7600)] + rng.normal(0, 1e-4, (7600, 3))
    asked = {
        "inside": rng.uniform(0, 1, (50, 3)), "outside": rng.uniform(0, 1, (50, 3)) + [20, -20, 3],
        "clustered": rows[-50:] + 1e-5, "between clusters": rng.uniform(0.3, 0.7, (50, 3)),
    }[where]
    table = spark.createDataFrame([(i, *map(float, r), float(i % 10)) for i, r in enumerate(rows)], "id long, a double, b double, c double, y double")
    queries = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(asked)], "id long, a double, b double, c double")
    fitted = knn.fit_knn(table, ["a", "b", "c"], "y", row_id="id", k_max=k)
    vectors = queries.select(*fitted.scaled(queries)).selectExpr("*", "-2 as fold").distinct()
    counts = knn.nearby_leaves(fitted, vectors, knn._tree(fitted)).groupBy("f0", "f1", "f2").sum("n").toPandas()["sum(n)"]
    assert len(counts) == 50 and counts.min() >= k and counts.mean() < 20 * k, counts.describe()


def test_knn_keeps_queries_and_refuses_rows_with_missing_numbers(spark, table):
    fitted = knn.fit_knn(table, ["a", "b"], "y", row_id="id", k_max=5)
    asked = spark.createDataFrame([(1, 0.5, None), (2, 0.5, float("nan")), (3, 0.5, 0.5)], "id long, a double, b double")
    got = {(r.id, r.k, r.weights): r.prediction for r in knn.knn_predict(fitted, asked, query_id="id", ks=[2, 5]).collect()}
    assert len(got) == 12
    assert all((v is None) == (q != 3) for (q, _, _), v in got.items())
    holes = table.withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    with pytest.raises(ValueError, match="3 training rows|4 training rows"):
        knn.fit_knn(holes, ["a", "b"], "y", row_id="id", k_max=5)


def test_knn_refuses_too_many_neighbours(spark, table):
    with pytest.raises(ValueError):
        knn.fit_knn(table, ["a"], "y", row_id="id", k_max=330, fold="fold")
    with pytest.raises(ValueError):
        fitted = knn.fit_knn(table, ["a"], "y", row_id="id", k_max=5)
        knn.knn_predict(fitted, table, query_id="id", ks=[6])


def test_trees_searches_and_stored_models(spark, table):
    features = {"a": "a", "b": "b", "c": "c"}
    search = models.grid_search(
        table, "y", models.random_forest("y", max_depth=4), {"numTrees": [3, 6]}, fold="fold", features=features,
        train_scores=True,
    )
    rows = search.results.collect()
    assert search.best["numTrees"] == int(min(rows, key=lambda r: r.val_mse).numTrees)
    assert search.best_model.transform(table).count() == 400
    assert len(rows) == 2 and all(r.train_mse < r.val_mse * 2 for r in rows)
    folder = scratch_path(spark, "models")
    forest = models.fit_trees(table, models.boosted_trees("y", trees=3), features)
    models.save_model(forest, folder, "xgboost", spark)
    assert models.load_model(folder, "boosting", spark).transform(table).count() == 400
    near = knn.fit_knn(table, ["a", "b"], "y", row_id="id", k_max=5)
    models.save_model(near, folder, "knn", spark)
    loaded = models.load_model(folder, "knn", spark)
    a = modelling.predict(near, table, row_id="id", label="y").collect()
    b = modelling.predict(loaded, table, row_id="id", label="y").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    with pytest.raises(ValueError):
        models.load_model(folder, "svm", spark)
    importances = models.feature_importances(models.fit_trees(table, models.random_forest("y", trees=3), features), features, spark)
    assert importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_boosting_and_forest_search(spark, table):
    features = {"a": "a", "b": "b"}
    for search, grid in ((models.boosting_search, {"maxIter": [1, 4], "maxDepth": [1, 3], "stepSize": [0.5]}),
                         (models.forest_search, {"numTrees": [1, 3], "minInstancesPerNode": [5, 60]})):
        found = search(table, "y", fold="fold", grid=grid, features=features)
        rows = found.results.collect()
        assert len(rows) == 4 and all(r.train_mse > 0 for r in rows)
        best = min(rows, key=lambda r: r.val_mse)
        assert found.best == {name: best[name] for name in grid} and found.best_model.transform(table).count() == 400
    assert max(models.BOOSTING_GRID["maxIter"]) == 1000 and max(models.FOREST_GRID["numTrees"]) == 500


def test_tree_queries_fit_whole_models(spark, table, monkeypatch):
    boosted, forests = [], []
    monkeypatch.setattr(model_queries, "train_and_test", lambda *_: (table, table))
    monkeypatch.setattr(models, "fit_trees", lambda train, estimator: boosted.append(estimator))
    monkeypatch.setattr(model_queries, "fit_forest", lambda *_, **options: forests.append(options))
    monkeypatch.setattr(modelling, "predict", lambda *_, **__: table)
    for name in ("gradient_boosting", "random_forest"):
        registry.QUERIES[name](spark, "")
    defaults = inspect.signature(ensembles.fit_forest).parameters
    assert boosted[0].getMaxIter() >= 100
    assert forests[0].get("trees", defaults["trees"].default) >= 100 and defaults["max_depth"].default == 30


def test_grid_search_query_asks_for_the_whole_grid(spark, table, monkeypatch):
    asked = []

    def scores(train, label, features, *, fold, trees, min_leaf, part, parallelism=4):
        asked.append((list(trees), list(min_leaf), part))
        return {(t, m, f): {True: 1.0 * t + m, False: 1.0} for t in trees for m in min_leaf for f in range(5)}

    monkeypatch.setattr(model_queries, "model_table", lambda *_: table)
    monkeypatch.setattr(models, "forest_scores", scores)
    monkeypatch.setattr(models, "fit_forest", lambda *_, **options: options)
    found = registry.QUERIES["grid_search"](spark, "").collect()
    assert asked == [([50, 100, 500], [5, 10, 25], 50)]
    assert len(found) == 9 and all(r.train_mse == 1.0 for r in found)


FEATURES = {"a": "a", "b": "b"}


def test_prefixes_of_a_forest_are_separate_fits(table):
    options = {"part": 2, "max_depth": 5, "min_leaf": 5}
    whole = ensembles.fit_forest(table, "y", FEATURES, trees=6, **options)
    small = ensembles.fit_forest(table, "y", FEATURES, trees=4, **options)
    predictions = [
        [r.prediction for r in forest.transform(table).orderBy("id").collect()] for forest in (whole.first(4), small, whole)
    ]
    assert predictions[0] == predictions[1] != predictions[2]
    with pytest.raises(ValueError):
        whole.first(3)
    assert ensembles.part_sizes(7, 3) == [3, 3, 1]


def test_a_stored_forest_is_the_mean_of_its_parts(spark, table):
    forest = ensembles.fit_forest(table, "y", FEATURES, trees=5, part=2, max_depth=4)
    parts = [ensembles.StoredForest((p,), (n,), forest.expressions) for p, n in zip(forest.paths, forest.trees)]
    each = [[r.prediction for r in p.transform(table).orderBy("id").collect()] for p in parts]
    whole = forest.transform(table)
    assert whole.columns == [*table.columns, "prediction"]
    got = [r.prediction for r in whole.orderBy("id").collect()]
    assert got == pytest.approx(np.average(each, axis=0, weights=[2, 2, 1]))
    folder = scratch_path(spark, "models")
    models.save_model(forest, folder, "random_forest", spark)
    loaded = models.load_model(folder, "random_forest", spark)
    assert [r.prediction for r in loaded.transform(table).orderBy("id").collect()] == got
    importances = models.feature_importances(loaded, FEATURES, spark).collect()
    assert sum(r.importance for r in importances) == pytest.approx(1.0) and importances[0].feature == "a"
    as_one = models.fit_trees(table, models.random_forest("y", trees=2, max_depth=2), FEATURES)
    models.save_model(as_one, folder := scratch_path(spark, "models"), "random_forest", spark)
    assert models.load_model(folder, "random_forest", spark).transform(table).count() == 400


def test_forest_search_scores_are_those_of_separate_fits(table):
    found = ensembles.forest_scores(
        table, "y", FEATURES, fold="fold", trees=[2, 4], min_leaf=[5, 40], max_depth=6, part=2)
    assert len(found) == 2 * 2 * 5
    for trees, least, fold in ((2, 5, 0), (4, 40, 3), (4, 5, 1)):
        model = ensembles.fit_forest(
            table.where(F.col("fold") != fold), "y", FEATURES, trees=trees, min_leaf=least, max_depth=6, part=2)
        error = F.avg((F.col("y") - F.col("prediction")) ** 2)
        scored = model.transform(table).groupBy((F.col("fold") == fold).alias("held")).agg(error.alias("mse"))
        assert found[trees, least, fold] == {r.held: pytest.approx(r.mse) for r in scored.collect()}


def test_boosting_search_scores_are_those_of_separate_fits(table):
    found = ensembles.boosting_scores(
        table, "y", FEATURES, fold="fold", trees=[1, 3, 6], max_depth=[2], rate=[0.5, 0.1])
    assert len(found) == 3 * 2 * 5
    rows = ensembles.training_rows(table, "y", FEATURES, ["fold"])
    for trees, rate, fold in ((1, 0.5, 0), (3, 0.1, 2), (6, 0.5, 4)):
        model = models.boosted_trees("label", trees=trees, max_depth=2, rate=rate).fit(rows.where(F.col("fold") != fold))
        scored = model.transform(rows).groupBy((F.col("fold") == fold).alias("held")).agg(
            F.avg((F.col("label") - F.col("prediction")) ** 2).alias("mse"))
        assert found[trees, 2, rate, fold] == {r.held: pytest.approx(r.mse) for r in scored.collect()}


def test_cross_products_are_one_aggregate(spark, table):
    columns = ["a", "b", "c", "a * b", "a * a"]
    got = linear.cross_products(table, columns, "y", "fold")
    x, y, fold = arrays(table)
    z = np.c_[x, x[:, 0] * x[:, 1], x[:, 0] ** 2, y]
    z = np.c_[np.ones(len(z)), z - z.mean(axis=0)]
    for f in range(5):
        assert got[f] == pytest.approx(z[fold == f].T @ z[fold == f])
    holes = table.withColumn("a", F.when(F.col("id") > 10, F.col("a")))
    assert sum(m[0, 0] for m in linear.cross_products(holes, ["a", "b"], "y", "fold").values()) == 389
    assert linear.cross_products(table.limit(0), ["a"], "y") == {}


def test_no_r2_for_a_constant_label(table):
    flat = table.withColumn("y", F.when(F.col("fold") == 1, 0.1).otherwise(F.col("y")))
    scores = {r.fold: r.r2 for r in linear.cross_val_linear(flat, ["a", "b"], "y", "fold").collect()}
    assert scores[1] is None and None not in [scores[f] for f in (0, 2, 3, 4)]
    path = linear.lasso_path(flat, ["a", "b"], "y", "fold", [0.1]).first()
    assert path.val_r2 is None and path.train_r2 > 0


def test_categories_of_thousands_of_values(spark):
    rng = np.random.default_rng(4)
    n, values = 20000, 5000
    one, two = rng.integers(0, values, n), rng.integers(0, 7, n)
    x = rng.normal(size=(n, 2)) + 50
    y = x @ [2.0, -1.0] + rng.normal(size=values)[one] + 0.3 * two + 0.1 * rng.normal(size=n)
    rows = [(i, *map(float, v), f"v{a}", int(b) if i % 50 else None, float(t), i % 3) for i, (v, a, b, t) in enumerate(zip(x, one, two, y))]
    df = spark.createDataFrame(rows, "id long, p double, q double, one string, two int, y double, fold int")
    present = np.arange(n) % 50 != 0
    fold = np.arange(n) % 3
    # the shares of each value taken out of numbers and label leave a small dense problem
    def reduced(train):
        z = np.c_[x - x.mean(axis=0), *[(two == k) & present for k in range(7)]].astype(float)
        counts = np.bincount(one[train], minlength=values)
        mean = lambda v: np.bincount(one[train], v[train], values) / np.maximum(counts, 1)
        parts = np.array([mean(c) for c in z.T]).T
        w = np.linalg.lstsq((z - parts[one])[train], (y - mean(y)[one])[train], rcond=None)[0]
        return z, w, mean(y) - parts @ w, counts
    model = sparse_linear.fit_categories(df, ["p", "q"], ["one", "two"], "y")
    z, w, own, _ = reduced(np.ones(n, bool))
    got = np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])
    assert got == pytest.approx(z @ w + own[one], abs=1e-6)
    scores = {r.fold: r.mse for r in sparse_linear.cross_val_categories(df, ["p", "q"], ["one", "two"], "y", "fold").collect()}
    for f in range(3):
        z, w, own, counts = reduced(fold != f)
        assert (counts[one[fold == f]] > 0).mean() > 0.9
        known = (fold == f) & (counts[one] > 0)
        if known.sum() == (fold == f).sum():
            assert scores[f] == pytest.approx(((y - z @ w - own[one])[known] ** 2).mean(), rel=1e-6)
        assert np.isfinite(scores[f])


def test_categories_equal_indicators(spark, table):
    coded = table.withColumns({"k": F.col("id") % 7, "m": F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string"))})
    indicators = [f"if(k = {i}, 1D, 0D)" for i in range(7)] + [f"if(m <=> '{i}', 1D, 0D)" for i in range(3)]
    sparse = {r.fold: (r.mse, r.r2) for r in sparse_linear.cross_val_categories(coded, ["a", "b"], ["k", "m"], "y", "fold").collect()}
    dense = {r.fold: (r.mse, r.r2) for r in linear.cross_val_linear(coded, ["a", "b", *indicators], "y", "fold").collect()}
    assert sparse == {f: pytest.approx(v, rel=1e-7) for f, v in dense.items()}
    assert sparse_linear.fit_categories(coded.limit(0), ["a"], ["k"], "y").transform(coded).count() == 400


def test_materialize_builds_once_per_parameters(spark):
    folder, built = scratch_path(spark, "stored"), []

    def build(n):
        built.append(n)
        return spark.range(n)

    for n in (3, 3, 4):
        table = sinks.materialize(spark, "t", lambda n=n: build(n), parameters={"n": n}, folder=folder)
        assert table.count() == n
    assert built == [3, 4]
    sinks.materialize(spark, "t", lambda: build(3), parameters={"n": 3}, folder=folder, force=True)
    assert built == [3, 4, 3]


def test_prefixes():
    assert strip_name_prefix(["log__a", "b", "x__y__z"]) == ["a", "b", "y__z"]
