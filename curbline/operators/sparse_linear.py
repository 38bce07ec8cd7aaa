"""Least squares on numbers and on categories of any number of values, from sparse sums.

A category stands for one 0/1 feature per value, but those columns are never made. All the normal equations need is
grouped: per value the number of rows and the sums of the numbers, per pair of values of two categories the number of
rows. These sums, one entry for each value and each pair of values that occur together, come to the driver, where
the equations are solved by conjugate gradients, which only multiply by them. Training sums are the total minus one
fold, as in ``linear``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.operators.linear import cross_products


@dataclass(frozen=True)
class SparseMoments:
    """Sums of products of (1, numbers, label) among each other, with the values, and of the values."""

    dense: np.ndarray  # (1, numbers, label) squared
    mixed: np.ndarray  # (1, numbers, label) by values; the first row counts the rows of each value
    left: np.ndarray  # pairs of values of two categories: indices
    right: np.ndarray
    together: np.ndarray  # and numbers of rows

    def __add__(self, other: SparseMoments) -> SparseMoments:
        return self._combined(other, 1.0)

    def __sub__(self, other: SparseMoments) -> SparseMoments:
        return self._combined(other, -1.0)

    def _combined(self, other: SparseMoments, sign: float) -> SparseMoments:
        joined = [np.concatenate(p) for p in ((self.left, other.left), (self.right, other.right))]
        weights = np.concatenate([self.together, sign * other.together])
        return SparseMoments(self.dense + sign * other.dense, self.mixed + sign * other.mixed, *joined, weights)

    @property
    def n(self) -> float:
        return self.dense[0, 0]

    def times(self, w: np.ndarray) -> np.ndarray:
        """The matrix of all products, label included, times a vector (1, numbers, label, values)."""
        d = len(self.dense)
        a, b = w[:d], w[d:]
        values = self.mixed.T @ a + self.mixed[0] * b
        values += np.bincount(self.left, self.together * b[self.right], len(b))
        values += np.bincount(self.right, self.together * b[self.left], len(b))
        return np.concatenate([self.dense @ a + self.mixed @ b, values])

    def error(self, w: np.ndarray) -> float:
        """Mean squared error of the coefficients ``w``, with -1 for the label."""
        return float(w @ self.times(w) / self.n)

    def variance(self) -> float:
        """Of the label; 0 for a constant label, up to rounding."""
        square = self.dense[-1, -1] / self.n
        variance = square - (self.dense[0, -1] / self.n) ** 2
        return float(variance) if variance > 1e-13 * square else 0.0

    def least_squares(self, tolerance: float = 1e-14, most_steps: int = 20_000) -> np.ndarray:
        """Coefficients (1, numbers, -1 for the label, values). Where features determine each other the shortest of
        the scaled solutions is found, and the predictions do not depend on it."""
        label = len(self.dense) - 1
        diagonal = np.concatenate([np.diag(self.dense), self.mixed[0]])
        scale = np.where(diagonal > 0, 1 / np.sqrt(np.where(diagonal > 0, diagonal, 1.0)), 0.0)
        scale[label] = 0.0
        target = np.zeros(len(scale))
        target[label] = 1.0
        right = scale * self.times(target)
        w, rest = np.zeros(len(scale)), right
        step, size = rest.copy(), rest @ rest
        goal = tolerance**2 * size
        for _ in range(most_steps):
            if size <= goal:
                break
            image = scale * self.times(scale * step)
            curve = step @ image
            if curve <= 0:
                break
            w = w + size / curve * step
            rest = rest - size / curve * image
            size, before = rest @ rest, size
            step = rest + size / before * step
        w = scale * w
        w[label] = -1.0
        return w


@dataclass(frozen=True)
class CategoryModel:
    """Predictions from numbers and values; a missing or unknown value adds nothing."""

    intercept: float
    slopes: dict[str, float]  # of the expressions
    values: dict[str, dict]  # category to value to coefficient

    def transform(self, df: DataFrame) -> DataFrame:
        spark, out = df.sparkSession, df
        prediction = F.lit(self.intercept)
        for expression, slope in self.slopes.items():
            prediction = prediction + F.expr(expression).cast("double") * slope
        out = out.withColumn("prediction", prediction)
        for category, known in self.values.items():
            kind = df.schema[category].dataType.simpleString()
            table = spark.createDataFrame(list(known.items()), f"_value {kind}, _coefficient double")
            out = (
                out.join(table, F.col(category) == F.col("_value"), "left")
                .withColumn("prediction", F.col("prediction") + F.coalesce("_coefficient", F.lit(0.0)))
                .drop("_value", "_coefficient")
            )
        return out


def sparse_moments(
    df: DataFrame, numbers: Sequence[str], categories: Sequence[str], target: str, fold: str | None = None
) -> tuple[dict[int, SparseMoments], list[tuple[str, object]], list[float]]:
    """Sums per fold, the (category, value) of each index, and the means that numbers and label are shifted by.

    Rows with a missing number or label are left out, a missing value only has no feature.
    """
    columns = [F.expr(c).cast("double") for c in (*numbers, target)]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    means = [float(m or 0.0) for m in df.where(complete).agg(*[F.avg(c) for c in columns]).first()]
    names = [f"_x{i}" for i in range(len(columns))]
    rows = df.where(complete).select(
        (F.col(fold) if fold else F.lit(0)).alias("_fold"), *categories,
        *[(c - F.lit(m)).alias(n) for n, c, m in zip(names, columns, means)],
    )
    dense = cross_products(rows.select("_fold", *names), names[:-1], names[-1], "_fold")
    index: dict[tuple[str, object], int] = {}
    mixed = {f: [] for f in dense}
    for category in categories:
        sums = rows.where(F.col(category).isNotNull()).groupBy("_fold", category).agg(
            F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(n).alias(n) for n in names]
        )
        for row in sums.orderBy(category).collect():
            at = index.setdefault((category, row[category]), len(index))
            mixed[row["_fold"]].append((at, [row["n"], *(row[n] for n in names)]))
    pairs = {f: ([], [], []) for f in dense}
    for a, b in combinations(categories, 2):
        both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select("_fold", F.col(a).alias("a"), F.col(b).alias("b"))
        for row in both.groupBy("_fold", "a", "b").count().collect():
            for out, value in zip(pairs[row["_fold"]], (index[a, row["a"]], index[b, row["b"]], float(row["count"]))):
                out.append(value)
    found = {}
    for f in dense:
        table = np.zeros((len(columns) + 1, len(index)))
        for at, values in mixed[f]:
            table[:, at] = values
        left, right, together = pairs[f]
        found[f] = SparseMoments(dense[f], table, np.array(left, int), np.array(right, int), np.array(together, float))
    return found, list(index), means


def cross_val_categories(
    df: DataFrame, numbers: Sequence[str], categories: Sequence[str], target: str, fold: str
) -> DataFrame:
    """Hold-out ``mse`` and ``r2`` of least squares per fold; no ``r2`` for a constant label."""
    parts, _, _ = sparse_moments(df, numbers, categories, target, fold)
    total = reduce(SparseMoments.__add__, parts.values()) if parts else None
    rows = []
    for f, held in sorted(parts.items()):
        mse, variance = held.error((total - held).least_squares()), held.variance()
        rows.append((int(f), mse, 1 - mse / variance if variance else None))
    return df.sparkSession.createDataFrame(rows, "fold int, mse double, r2 double")


def fit_categories(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], target: str) -> CategoryModel:
    """Least squares of ``target`` on the numbers and one feature per value of the categories. From no rows
    comes a model that predicts 0."""
    parts, names, means = sparse_moments(df, numbers, categories, target)
    if not parts:
        return CategoryModel(0.0, {n: 0.0 for n in numbers}, {c: {} for c in categories})
    w = reduce(SparseMoments.__add__, parts.values()).least_squares()
    count = len(numbers)
    slopes, coefficients = w[1 : count + 1], w[count + 2 :]
    values: dict[str, dict] = {c: {} for c in categories}
    for (category, value), coefficient in zip(names, coefficients):
        values[category][value] = float(coefficient)
    intercept = float(w[0] + means[-1] - np.dot(slopes, means[:-1]))
    return CategoryModel(intercept, dict(zip(numbers, map(float, slopes))), values)
