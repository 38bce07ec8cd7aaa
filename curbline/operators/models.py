"""Regression models as Spark ML pipelines, plus the nearest-neighbour model."""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators import knn
from curbline.operators.ensembles import StoredForest, boosting_scores, fit_forest, forest_scores
from curbline.operators.grown_forest import GrownForest
from curbline.operators.prep import INPUT, fit_scaler, vector_stages
from curbline.operators.stats import evaluate
from curbline.session import exists

MODEL_KINDS = ("baseline", "linear", "knn", "random_forest", "boosting")
# the boosted trees go by this name too
KIND_ALIASES = {"xgboost": "boosting"}

# Model features: name to expression over the street table.
RAW_FEATURES: dict[str, str] = {
    c: f"cast({c} as double)"
    for c in (
        "has_bike_lane", "st_width", "shape_leng", "is_av", "is_st", "is_rd", "has_humps",
        "n_trees", "speed_limit", "traffic_volume", "n_parking_meters",
    )
}
LINEAR_FEATURES: dict[str, str] = {
    "log_st_width": "log1p(st_width)",
    "log_shape_leng": "log1p(shape_leng)",
    "log_traffic_volume": "log1p(traffic_volume)",
    "inv_n_trees": "1 / (1 + n_trees)",
    **{
        c: f"cast({c} as double)"
        for c in ("has_bike_lane", "is_av", "is_st", "is_rd", "has_humps", "speed_limit", "n_parking_meters")
    },
}
KNN_FEATURES = ("log1p(st_width)", "log1p(shape_leng)", "log1p(traffic_volume)")

def _scaled(train: DataFrame, features: dict[str, str]) -> list:
    """As ``vector_stages`` with every feature standard-scaled on ``train`` (population deviation)."""
    return vector_stages(fit_scaler(train, list(features.values())).expressions())


def _fit(stages: list, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)


def fit_mean(train: DataFrame, label: str) -> PipelineModel:
    """Predicts the training mean everywhere."""
    mean = float(train.agg(F.avg(label)).first()[0])
    statement = f"SELECT *, {mean!r}D AS prediction FROM {INPUT}"
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


def fit_linear(train: DataFrame, label: str, features: dict[str, str] = LINEAR_FEATURES) -> PipelineModel:
    """Ordinary least squares on scaled features."""
    return _fit([*_scaled(train, features), LinearRegression(labelCol=label, solver="normal")], train)


def fit_lasso(
    train: DataFrame, label: str, alpha: float, features: dict[str, str] = LINEAR_FEATURES
) -> PipelineModel:
    """Least squares with an L1 penalty on scaled features."""
    estimator = LinearRegression(
        labelCol=label, elasticNetParam=1.0, regParam=alpha, standardization=False,
        maxIter=1000, tol=1e-9,
    )
    return _fit([*_scaled(train, features), estimator], train)


def fit_quadratic(
    train: DataFrame, label: str, features: dict[str, str] = LINEAR_FEATURES
) -> PipelineModel:
    """Least squares on all monomials of degree 1 and 2, scaled after multiplying."""
    return fit_linear(train, label, quadratic_terms(features))


def quadratic_terms(features: dict[str, str]) -> dict[str, str]:
    names = list(features)
    terms = dict(features)
    for i, a in enumerate(names):
        for b in names[i:]:
            terms[f"{a}*{b}"] = f"({features[a]}) * ({features[b]})"
    return terms


def random_forest(label: str, *, trees: int = 100, min_leaf: int = 5, max_depth: int = 30, bootstrap: bool = True, seed: int = 42):
    """Forest over all features; every child of a split keeps ``min_leaf`` rows. The depth is Spark's
    greatest unless told otherwise. Without ``bootstrap`` every tree sees all rows."""
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf,
        maxDepth=max_depth, featureSubsetStrategy="all", bootstrap=bootstrap, seed=seed,
    )


def boosted_trees(label: str, *, trees: int = 100, max_depth: int = 5, rate: float = 0.1, seed: int = 42):
    return GBTRegressor(labelCol=label, maxIter=trees, maxDepth=max_depth, stepSize=rate, seed=seed)


def fit_trees(train: DataFrame, estimator, features: dict[str, str] = RAW_FEATURES) -> PipelineModel:
    """Fit a forest or boosted trees on unscaled features."""
    return _fit([*vector_stages(list(features.values())), estimator], train)


def coefficient_table(model: PipelineModel, features: dict[str, str], spark: SparkSession) -> DataFrame:
    """Coefficient per feature, largest magnitude first."""
    values = model.stages[-1].coefficients
    rows = [(n, float(v)) for n, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, coefficient double").orderBy(
        F.abs("coefficient").desc()
    )


def feature_importances(model: PipelineModel | StoredForest | GrownForest, features: dict[str, str], spark: SparkSession) -> DataFrame:
    stored = isinstance(model, StoredForest | GrownForest)
    values = model.importances() if stored else model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc()
    )


def cross_val_score(
    df: DataFrame, label: str, fold: str, fit: Callable[[DataFrame], PipelineModel]
) -> DataFrame:
    """Hold-out ``mse``, ``mae`` and ``r2`` per fold, for any fitting function.

    Linear models should use ``linear.cross_val_linear``, which needs one pass in all.
    """
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    scored = None
    for f in folds:
        model = fit(df.where(F.col(fold) != f))
        part = model.transform(df.where(F.col(fold) == f)).select(fold, label, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return evaluate(scored, label, keys=[fold])


# The grids of the regression study. It asks for a least node size of 10, 20 or 50 rows to split; as
# Spark only knows a least size of the children, half of it is used.
FOREST_GRID = {"numTrees": [50, 100, 500], "minInstancesPerNode": [5, 10, 25]}
BOOSTING_GRID = {
    "maxIter": [400, 500, 800, 1000], "maxDepth": [1, 5, 10, 20], "stepSize": [0.1, 0.05, 0.01, 0.001, 0.0001],
}


@dataclass(frozen=True)
class Search:
    """The best combination by cross-validated MSE, and the model refitted with it on all rows."""

    best: dict[str, float]
    best_model: PipelineModel | StoredForest
    results: DataFrame


def _search(
    spark: SparkSession, grid: dict[str, Sequence], scores: Callable[[dict], list[dict[bool, float]]],
    refit: Callable[[dict], PipelineModel | StoredForest], train_scores: bool = True,
) -> Search:
    """The table of a search from the errors of each combination's folds, and the best one refitted."""
    rows = []
    for params in (dict(zip(grid, values)) for values in itertools.product(*grid.values())):
        parts = scores(params)
        val, seen = (sum(p.get(held, 0.0) for p in parts) / len(parts) for held in (True, False))
        rows.append((params, val, seen if train_scores else None))
    best = min(rows, key=lambda r: r[1])[0]
    schema = ", ".join(f"{n} double" for n in grid) + ", val_mse double, train_mse double"
    table = [(*map(float, params.values()), val, seen) for params, val, seen in rows]
    return Search(best, refit(best), spark.createDataFrame(table, schema))


def grid_search(
    train: DataFrame,
    label: str,
    estimator,
    grid: dict[str, Sequence],
    *,
    fold: str,
    features: dict[str, str] = RAW_FEATURES,
    parallelism: int = 4,
    train_scores: bool = False,
) -> Search:
    """All combinations of the grid by cross-validated MSE; the best one refitted on ``train``.

    ``results`` has one row per combination. Each fit is scored on both of its parts in one job and then
    let go, so that at most ``parallelism`` models are held, however large the grid is.
    """
    expressions = list(features.values())
    folds = [r[0] for r in train.select(fold).distinct().orderBy(fold).collect()]
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]

    def fit(rows: DataFrame, params: dict) -> PipelineModel:
        tuned = estimator.copy({estimator.getParam(n): v for n, v in params.items()})
        return _fit([*vector_stages(expressions), tuned], rows)

    def scored(task: tuple[int, int]) -> dict[bool, float]:
        left_out = folds[task[1]]
        model = fit(train.where(F.col(fold) != left_out), combinations[task[0]])
        rows = train if train_scores else train.where(F.col(fold) == left_out)
        errors = (
            model.transform(rows).groupBy((F.col(fold) == left_out).alias("held"))
            .agg(F.avg((F.col(label) - F.col("prediction")) ** 2).alias("mse")).collect()
        )
        return {r["held"]: r["mse"] for r in errors}

    tasks = list(itertools.product(range(len(combinations)), range(len(folds))))
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        found = dict(zip(tasks, pool.map(inheritable_thread_target(train.sparkSession)(scored), tasks, chunksize=1)))
    return _search(
        train.sparkSession, grid,
        lambda params: [found[combinations.index(params), f] for f in range(len(folds))],
        lambda params: fit(train, params), train_scores,
    )


def forest_search(
    train: DataFrame, label: str, *, fold: str, grid: dict[str, Sequence] = FOREST_GRID,
    features: dict[str, str] = RAW_FEATURES, **options,
) -> Search:
    """The forest search of the study, with train scores. One forest per least leaf size and fold is fitted; smaller
    ones are its first parts."""
    trees, leaves = grid["numTrees"], grid["minInstancesPerNode"]
    part = math.gcd(*trees)
    options = {"part": max(d for d in range(1, min(part, 50) + 1) if part % d == 0), **options}
    found = forest_scores(train, label, features, fold=fold, trees=trees, min_leaf=leaves, **options)
    folds = sorted({key[-1] for key in found})
    return _search(
        train.sparkSession, grid,
        lambda p: [found[p["numTrees"], p["minInstancesPerNode"], f] for f in folds],
        lambda p: fit_forest(train, label, features, trees=p["numTrees"], min_leaf=p["minInstancesPerNode"], **options),
    )


def boosting_search(
    train: DataFrame, label: str, *, fold: str, grid: dict[str, Sequence] = BOOSTING_GRID,
    features: dict[str, str] = RAW_FEATURES, **options,
) -> Search:
    """The boosting search of the study, with train scores. One ensemble per depth, rate and fold is fitted; smaller
    ones are its first trees."""
    found = boosting_scores(
        train, label, features, fold=fold, trees=grid["maxIter"], max_depth=grid["maxDepth"], rate=grid["stepSize"], **options
    )
    folds = sorted({key[-1] for key in found})
    return _search(
        train.sparkSession, grid,
        lambda p: [found[p["maxIter"], p["maxDepth"], p["stepSize"], f] for f in folds],
        lambda p: fit_trees(
            train, boosted_trees(label, trees=p["maxIter"], max_depth=p["maxDepth"], rate=p["stepSize"]), features),
    )


def best_knn(
    train: DataFrame, label: str, results: DataFrame, *, row_id: str, features: Sequence[str] = KNN_FEATURES
) -> tuple[dict, knn.KnnModel]:
    """The best k and weighting of a ``grid_search_knn`` table, and the model for them on all rows."""
    best = results.orderBy("val_mse", "k", "weights").first()
    chosen = {"k": int(best["k"]), "weights": best["weights"]}
    return chosen, knn.fit_knn(train, features, label, row_id=row_id, k_max=chosen["k"])


def grid_search_knn(
    train: DataFrame,
    label: str,
    *,
    row_id: str,
    fold: str,
    ks: Sequence[int],
    features: Sequence[str] = KNN_FEATURES,
    weights: Sequence[str] = knn.WEIGHTS,
    folds: int = 5,
    train_scores: bool = False,
) -> DataFrame:
    """``k weights val_mse train_mse``: neighbours are ranked once for the largest k, within blocks of query vectors, and
    every k and weighting follows from running sums over the rank. With train scores, each row is also asked for every
    fold it does not belong to."""
    model = knn.fit_knn(train, features, label, row_id=row_id, k_max=max(ks), fold=fold)
    mse = F.col("sse") / F.col("n")
    if train_scores:
        errors = knn.knn_fold_errors(model, train.where(F.col(row_id).isNotNull()), label, fold=fold, ks=ks, weights=weights)
        return errors.where((F.col("n") > 0) & F.col("left_out").between(0, folds - 1)).groupBy("k", "weights").agg(
            F.avg(F.when(F.col("held"), mse)).alias("val_mse"), F.avg(F.when(~F.col("held"), mse)).alias("train_mse")
        )
    # where ids repeat, every row of an id is asked for each label of the id
    truth = train.select(F.col(row_id).alias("_q"), F.col(label).alias("_y"), F.col(fold).alias("_scored"))
    asked = train.withColumns({"_q": F.col(row_id), "_left_out": F.col(fold)}).join(truth, "_q")
    errors = knn.knn_fold_errors(model, asked, "_y", fold="_left_out", ks=ks, weights=weights, scored="_scored")
    scores = errors.where(F.col("n") > 0).groupBy("k", "weights").agg(F.avg(mse).alias("val_mse"))
    return scores.withColumn("train_mse", F.lit(None).cast("double"))


def save_model(model: PipelineModel | StoredForest | knn.KnnModel, folder: str, kind: str, spark: SparkSession) -> str:
    path = model_path(folder, kind)
    if isinstance(model, StoredForest | GrownForest):
        model.save(path, spark)
    elif isinstance(model, knn.KnnModel):
        model.rows.write.mode("overwrite").parquet(f"{path}/rows")
        meta = {
            "features": model.features, "means": model.means, "deviations": model.deviations,
            "cut_axes": model.cut_axes, "cuts": model.cuts, "k_max": model.k_max,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")
    else:
        model.write().overwrite().save(path)
    return path


def load_model(folder: str, kind: str, spark: SparkSession) -> PipelineModel | StoredForest | knn.KnnModel:
    path = model_path(folder, kind)
    if KIND_ALIASES.get(kind, kind) == "random_forest" and exists(spark, f"{path}/meta"):
        return StoredForest.load(path, spark)  # else a forest fitted as one
    if KIND_ALIASES.get(kind, kind) != "knn":
        return PipelineModel.load(path)
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    fields = {n: tuple(v) if isinstance(v, list) else v for n, v in meta.items()}
    return knn.KnnModel(rows=spark.read.parquet(f"{path}/rows"), **fields)


def model_path(folder: str, kind: str) -> str:
    name = KIND_ALIASES.get(kind, kind)
    if name not in MODEL_KINDS:
        raise ValueError(f"unknown model kind {kind!r}, expected one of {MODEL_KINDS}")
    return f"{folder.rstrip('/')}/{name}"
