"""Tree ensembles fitted in parts, and searches that score every prefix of a fitted ensemble.

The trees of a forest do not depend on each other. So a forest is fitted as parts of a few trees, each with a seed of
its own, and each part is stored as soon as it is fitted: neither the driver nor a job ever holds the nodes and statistics of all
trees. The forest predicts the mean of its parts, weighted by their trees, read one part after the other. The first parts
of a forest are a forest, too: a search over numbers of trees fits the largest one and scores the smaller ones on the way.

Boosted trees build on each other, so they are fitted at once; the errors after each number of trees come from one pass.

Training rows are stored as vectors once. They are read in as few partitions as their size asks for, since the
statistics of a tree's nodes are made in each partition; parts are fitted side by side instead.
"""

from __future__ import annotations

import itertools
import json
import math
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.grown_forest import TABLE_ROWS, GrownForest, grow_forest, prefix_errors
from curbline.operators.prep import vector_stages
from curbline.session import copy_folder, release, scratch_path, settle, settled_as

#: Trees of a part, parts fitted side by side, and bytes of feature values in a partition of training rows.
PART, PARALLEL, PARTITION_BYTES = 25, 4, 8 << 20
#: Training rows times trees, of a part and of all parts fitted side by side: the driver holds their nodes while they
#: grow. Most parts at once, where that allows them.
PART_ROWS, HELD_ROWS, MOST_PARALLEL = 400_000, 2_000_000, 5
#: Training rows above which a forest is not fitted in parts but grown where its rows are.
GROWN_ROWS = 16_000


@dataclass(frozen=True)
class StoredForest:
    """Parts of a forest in the shared folder: their paths, numbers of trees, and the feature expressions."""

    paths: tuple[str, ...]
    trees: tuple[int, ...]
    expressions: tuple[str, ...]

    def first(self, trees: int) -> StoredForest:
        """The forest of the first parts, which have so many trees."""
        ends = list(itertools.accumulate(self.trees))
        if trees not in ends:
            raise ValueError(f"no parts of {trees} trees, only of {ends}")
        count = ends.index(trees) + 1
        return StoredForest(self.paths[:count], self.trees[:count], self.expressions)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``. The sums are stored after each part, or a few small ones, so that no more than
        these are held at a time."""
        spark = df.sparkSession
        out, replace = df.withColumn("_sum", F.lit(0.0)), _replacing(spark)
        groups = self._held_together()
        for number, group in enumerate(groups, start=1):
            out = _vectors(out, self.expressions)
            loaded = side_by_side(RandomForestRegressionModel.load, [self.paths[i] for i in group], PARALLEL, spark)
            for i, model in zip(group, loaded):
                out = _with_part(out, model, self.trees[i])
            out = out.select(*df.columns, "_sum")
            if number < len(groups):
                out = replace(out)
        return out.withColumn("prediction", F.col("_sum") / sum(self.trees)).drop("_sum")

    def _held_together(self) -> list[list[int]]:
        """The numbers of the parts, in groups of ``PARALLEL`` parts and ``PART`` trees at most."""
        groups: list[list[int]] = []
        for i, trees in enumerate(self.trees):
            last = groups[-1] if groups else []
            if last and len(last) < PARALLEL and sum(self.trees[j] for j in last) + trees <= PART:
                last.append(i)
            else:
                groups.append([i])
        return groups

    def importances(self) -> np.ndarray:
        """Mean over the trees of each feature's share of the impurity removed."""
        def grown(path: str) -> np.ndarray:
            model = RandomForestRegressionModel.load(path)
            return sum(tree.numNodes > 1 for tree in model.trees) * model.featureImportances.toArray()

        spark = SparkSession.active()
        total = sum(side_by_side(grown, self.paths, PARALLEL, spark), np.zeros(len(self.expressions)))
        return total / total.sum() if total.any() else total

    def save(self, folder: str, spark: SparkSession) -> None:
        for i, path in enumerate(self.paths):
            copy_folder(spark, path, f"{folder}/part-{i}")
        meta = {"trees": self.trees, "expressions": self.expressions}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/meta")

    @staticmethod
    def load(folder: str, spark: SparkSession) -> StoredForest | GrownForest:
        meta = json.loads(spark.read.text(f"{folder}/meta").first()[0])
        if "bounds" in meta:
            return GrownForest.of(meta, folder)
        paths = tuple(f"{folder}/part-{i}" for i in range(len(meta["trees"])))
        return StoredForest(paths, tuple(meta["trees"]), tuple(meta["expressions"]))


def _replacing(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """Stores a table and lets go the one stored before."""
    group, count = uuid.uuid4().hex, itertools.count(1)

    def replace(df: DataFrame) -> DataFrame:
        number = next(count)
        with settled_as(f"{group}-{number}"):
            stored = settle(df, "forest-sums")
        release(spark, f"{group}-{number - 1}")
        return stored

    return replace


def _vectors(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    return PipelineModel(stages=vector_stages(expressions)).transform(df)


def _with_part(df: DataFrame, model: RandomForestRegressionModel, trees: int) -> DataFrame:
    out = model.setPredictionCol("_part").transform(df)
    return out.withColumn("_sum", F.col("_sum") + F.col("_part") * trees).drop("_part")


def training_rows(train: DataFrame, label: str, features: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Stored label and vector of each row, in partitions of about ``PARTITION_BYTES``.

    Rows are placed by a hash of their values, so that reruns draw the same samples of them however ``train`` is read.
    """
    values = [f"_x{i}" for i in range(len(features))]
    rows = _vectors(train, list(features.values())).select(
        "features", F.col(label).alias("label"), *keep, F.xxhash64(label, *values).alias("_place")
    )
    placed = rows.repartition(few_partitions(train, len(features)), "_place").sortWithinPartitions("_place", *keep)
    return settle(placed.drop("_place"), "training")


def few_partitions(rows: DataFrame, features: int) -> int:
    """As many partitions as the size of the features asks for: the steps of a tree wait for each of them."""
    return max(1, math.ceil(rows.count() * features * 8 / PARTITION_BYTES))


def part_sizes(trees: int, part: int = PART) -> list[int]:
    """A forest's parts: full ones, then the rest."""
    full, rest = divmod(trees, part)
    return [part] * full + ([rest] if rest else [])


def largest_part(rows: int) -> int:
    """Trees of a part for so many training rows: ``PART``, fewer where there are many rows."""
    return max(1, min(PART, PART_ROWS // max(1, rows)))


def _fit_part(rows: DataFrame, number: int, trees: int, settings: dict) -> RandomForestRegressionModel:
    """The part of this number. Its seed depends on the number only, so equal beginnings give equal parts."""
    forest = RandomForestRegressor(
        labelCol="label", numTrees=trees, featureSubsetStrategy="all", cacheNodeIds=True,
        **{**settings, "seed": settings["seed"] * 1_000_003 + number},
    )
    return forest.fit(rows)


def side_by_side(function: Callable, tasks: Iterable, parallelism: int, spark: SparkSession) -> list:
    tasks = list(tasks)
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(function), tasks, chunksize=1)


def _settings(min_leaf: int, max_depth: int, bootstrap: bool, seed: int) -> dict:
    return {"minInstancesPerNode": min_leaf, "maxDepth": max_depth, "bootstrap": bootstrap, "seed": seed}


def fit_forest(
    train: DataFrame, label: str, features: dict[str, str], *, trees: int = 100, min_leaf: int = 5, max_depth: int = 30,
    bootstrap: bool = True, seed: int = 42, part: int | None = None, parallelism: int | None = None,
) -> StoredForest | GrownForest:
    """A forest over all features; every child of a split keeps ``min_leaf`` rows. Unless told otherwise, the size of
    the parts and how many are fitted side by side follow from the number of rows; on more than ``GROWN_ROWS`` it is
    grown without parts."""
    spark, rows = train.sparkSession, training_rows(train, label, features)
    count = max(1, rows.count())
    if count > GROWN_ROWS:
        folder, binned = grow_forest(
            rows, scratch_path(spark, "forest"), trees=trees, min_leaf=min_leaf, max_depth=max_depth, bootstrap=bootstrap, seed=seed
        )
        return GrownForest(folder, trees, binned.bounds, binned.mean, tuple(features.values()))
    part = part or largest_part(count)
    parallelism = parallelism or max(1, min(MOST_PARALLEL, HELD_ROWS // (count * part)))
    settings, sizes = _settings(min_leaf, max_depth, bootstrap, seed), part_sizes(trees, part)

    def fit(number: int) -> str:
        path = scratch_path(spark, "forest-part")
        _fit_part(rows, number, sizes[number], settings).write().save(path)
        return path

    paths = side_by_side(fit, range(len(sizes)), parallelism, spark)
    return StoredForest(tuple(paths), tuple(sizes), tuple(features.values()))


def _errors(rows: DataFrame, prediction) -> dict[bool, float]:
    """Mean squared error of the held-out rows and of the others."""
    found = rows.groupBy("held").agg(F.avg((F.col("label") - prediction) ** 2).alias("mse")).collect()
    return {r["held"]: r["mse"] for r in found}


def forest_scores(
    train: DataFrame, label: str, features: dict[str, str], *, fold: str, trees: Sequence[int], min_leaf: Sequence[int],
    max_depth: int = 30, seed: int = 42, part: int = PART, parallelism: int = PARALLEL,
) -> dict[tuple[int, int, int], dict[bool, float]]:
    """(trees, min_leaf, fold) to the mean squared error with the fold held out, on it and on the other rows.

    One forest per ``min_leaf`` and fold, of as many trees as the largest number asks for. Parts end at every
    number asked for; where ``part`` divides them, the prefixes are what ``fit_forest`` gives.
    """
    spark, rows = train.sparkSession, training_rows(train, label, features, [fold])
    folds = [r[0] for r in rows.select(fold).distinct().orderBy(fold).collect()]
    if (count := rows.count()) > GROWN_ROWS:
        if count <= TABLE_ROWS:
            return prefix_errors(rows, fold=fold, trees=trees, min_leaf=min_leaf, max_depth=max_depth, seed=seed)
        return _grown_scores(train, label, features, fold, folds, trees, min_leaf, max_depth, seed)
    ends = sorted(trees)
    sizes = [size for low, high in zip([0, *ends], ends) for size in part_sizes(high - low, part)]
    scores: dict[tuple[int, int, int], dict[bool, float]] = {}

    def score(task: tuple[int, int]) -> None:
        least, left_out = task
        seen = rows.where(F.col(fold) != left_out)
        sums = rows.select("features", "label", (F.col(fold) == left_out).alias("held"), F.lit(0.0).alias("_sum"))
        grown, replace = 0, _replacing(spark)
        for number, size in enumerate(sizes):
            model = _fit_part(seen, number, size, _settings(least, max_depth, True, seed))
            sums = replace(_with_part(sums, model, size))
            grown += size
            if grown in ends:
                scores[grown, least, left_out] = _errors(sums, F.col("_sum") / grown)

    side_by_side(score, itertools.product(min_leaf, folds), parallelism, spark)
    return scores


def _grown_scores(
    train: DataFrame, label: str, features: dict[str, str], fold: str, folds: Sequence[int], trees: Sequence[int],
    min_leaf: Sequence[int], max_depth: int, seed: int,
) -> dict[tuple[int, int, int], dict[bool, float]]:
    """The errors of the first trees of a forest for each ``min_leaf`` and fold, one forest after the other."""
    scores: dict[tuple[int, int, int], dict[bool, float]] = {}
    for least, left_out in itertools.product(min_leaf, folds):
        forest = fit_forest(train.where(F.col(fold) != left_out), label, features, trees=max(trees), min_leaf=least, max_depth=max_depth, seed=seed)
        for count in trees:
            predicted = forest.first(count).transform(train).select(F.col(label).alias("label"), "prediction", (F.col(fold) == left_out).alias("held"))
            scores[count, least, left_out] = _errors(predicted, F.col("prediction"))
    return scores


def boosting_scores(
    train: DataFrame, label: str, features: dict[str, str], *, fold: str, trees: Sequence[int], max_depth: Sequence[int],
    rate: Sequence[float], seed: int = 42, parallelism: int = PARALLEL,
) -> dict[tuple[int, int, float, int], dict[bool, float]]:
    """(trees, max_depth, rate, fold) to the mean squared error with the fold held out, on it and on the other rows.

    One ensemble per depth, rate and fold, of the largest number of trees; its errors after fewer trees are those of
    the smaller ensembles, as each tree depends only on those before it.
    """
    spark, rows = train.sparkSession, training_rows(train, label, features, [fold])
    folds = [r[0] for r in rows.select(fold).distinct().orderBy(fold).collect()]
    scores: dict[tuple[int, int, float, int], dict[bool, float]] = {}

    def score(task: tuple[int, float, int]) -> None:
        depth, step, left_out = task
        held = rows.where(F.col(fold) == left_out)
        seen = rows.where(F.col(fold) != left_out)
        model = GBTRegressor(labelCol="label", maxIter=max(trees), maxDepth=depth, stepSize=step, seed=seed).fit(seen)
        on_held, on_seen = (model.evaluateEachIteration(part, "squared") for part in (held, seen))
        for count in trees:
            scores[count, depth, step, left_out] = {True: on_held[count - 1], False: on_seen[count - 1]}

    side_by_side(score, itertools.product(max_depth, rate, folds), parallelism, spark)
    return scores
