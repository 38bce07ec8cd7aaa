"""Linear models from cross-product sums.

One pass over the table gives, per fold, the sums n, x, y, x x', x y and y y. Training sums are
the total minus one fold. Least squares, lasso, their errors and R2 on either part all follow
from these p x p sums, so 300 alphas times 5 folds cost one pass, not 1,500.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cross_products(
    df: DataFrame, features: Sequence[str], target: str, fold: str | None = None
) -> dict[int, np.ndarray]:
    """Fold to the matrix Z'Z with Z = (1, x1..xp, y). The columns are shifted by their overall
    means first, which leaves every result but the intercept unchanged and keeps digits.

    All products of a row are one vector, and one aggregate of fixed size adds the vectors up, combined on the
    map side: the plan does not grow with the number of columns. Rows with a missing number are left out.
    """
    columns = [*features, target]
    numbers = [F.expr(c).cast("double") for c in columns]
    means = df.agg(*[F.avg(c) for c in numbers]).first()
    names = [f"_{i}" for i in range(len(columns))]
    shifted = df.select(
        (F.col(fold) if fold else F.lit(0)).alias("_fold"),
        *[(c - F.lit(float(m or 0.0))).alias(n) for n, c, m in zip(names, numbers, means)],
    )
    rows = VectorAssembler(inputCols=names, outputCol="_z", handleInvalid="skip").transform(shifted)
    products = PolynomialExpansion(degree=2, inputCol="_z", outputCol="_products").transform(rows)
    summary = Summarizer.metrics("sum", "count").summary(F.col("_products"))
    size, result = len(columns) + 1, {}
    for row in products.groupBy("_fold").agg(summary.alias("s")).collect():
        sums, matrix = row["s"]["sum"].toArray(), np.zeros((size, size))
        matrix[0, 0] = row["s"]["count"]
        for j in range(1, size):  # in the vector: z1, z1 z1, z2, z1 z2, z2 z2, ...
            start = (j - 1) * (j + 2) // 2
            matrix[: j + 1, j] = matrix[j, : j + 1] = sums[start : start + j + 1]
        result[row["_fold"]] = matrix
    return result


class _Moments:
    """Means, covariances and errors read off one cross-product matrix."""

    def __init__(self, z: np.ndarray) -> None:
        self.z, self.n = z, z[0, 0]
        self.mean = z[0, 1:] / self.n
        self.cov = z[1:, 1:] / self.n - np.outer(self.mean, self.mean)

    @property
    def scale(self) -> np.ndarray:
        deviations = np.sqrt(np.maximum(np.diag(self.cov)[:-1], 0.0))
        return np.where(deviations > 1e-12, deviations, 1.0)

    def intercept(self, slopes: np.ndarray) -> float:
        return float(self.mean[-1] - self.mean[:-1] @ slopes)

    def mse(self, slopes: np.ndarray, intercept: float) -> float:
        v = np.concatenate([[-intercept], -slopes, [1.0]])
        return float(v @ self.z @ v / self.n)

    def r2(self, slopes: np.ndarray, intercept: float) -> float | None:
        """None for a constant label, up to rounding."""
        if self.cov[-1, -1] <= 1e-13 * self.z[-1, -1] / self.n:
            return None
        return float(1.0 - self.mse(slopes, intercept) / self.cov[-1, -1])

    def least_squares(self) -> np.ndarray:
        scale = self.scale
        correlation = self.cov[:-1, :-1] / np.outer(scale, scale)
        return np.linalg.lstsq(correlation, self.cov[:-1, -1] / scale, rcond=1e-10)[0] / scale

    def lasso(self, alpha: float, start: np.ndarray, tolerance: float = 1e-12) -> np.ndarray:
        """Coefficients of the scaled features minimising mse/2 + alpha*|w|.

        With the right signs the coefficients follow from linear equations. The signs of the start, usually those of
        the next larger alpha, are tried first; cyclic updates change them until they are right.
        """
        scale = self.scale
        gram = self.cov[:-1, :-1] / np.outer(scale, scale)
        right = self.cov[:-1, -1] / scale
        w = start.copy()
        for _ in range(100_000):
            solved = _with_signs(gram, right, alpha, np.sign(w))
            if solved is not None:
                return solved
            largest = 0.0
            for j in range(len(w)):
                if gram[j, j] <= 0:
                    continue
                rest = right[j] - gram[j] @ w + gram[j, j] * w[j]
                new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / gram[j, j]
                largest, w[j] = max(largest, abs(new - w[j])), new
            if largest <= tolerance * max(1e-12, float(np.max(np.abs(w)))):
                return w
        raise RuntimeError(f"lasso with alpha {alpha} did not converge")


def _with_signs(gram: np.ndarray, right: np.ndarray, alpha: float, signs: np.ndarray) -> np.ndarray | None:
    """The lasso's coefficients if they have these signs, else None."""
    used = np.flatnonzero(signs)
    w = np.zeros(len(signs))
    if len(used):
        try:
            w[used] = np.linalg.solve(gram[np.ix_(used, used)], right[used] - alpha * signs[used])
        except np.linalg.LinAlgError:
            return None
    gradient = right - gram @ w
    slack = 1e-10 * max(alpha, float(np.max(np.abs(right), initial=0.0))) + 1e-300
    rest = signs == 0
    met = (np.sign(w) == signs).all() and (np.abs(gradient[rest]) <= alpha + slack).all()
    return w if met and (np.abs(gradient[used] - alpha * signs[used]) <= slack).all() else None


def least_squares(df: DataFrame, features: dict[str, str], target: str) -> DataFrame:
    """``feature coefficient train_mse``: the slopes of the unscaled features, and the error over the rows."""
    whole = _Moments(sum(cross_products(df, list(features.values()), target).values()))
    slopes = whole.least_squares()
    mse = whole.mse(slopes, whole.intercept(slopes))
    rows = [(name, float(slope), mse) for name, slope in zip(features, slopes)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, train_mse double")


def cross_val_linear(
    df: DataFrame, features: Sequence[str], target: str, fold: str
) -> DataFrame:
    """Hold-out ``mse`` and ``r2`` of least squares per fold."""
    parts = cross_products(df, features, target, fold)
    total = sum(parts.values())
    rows = []
    for f, held in sorted(parts.items()):
        train, test = _Moments(total - held), _Moments(held)
        slopes = train.least_squares()
        b = train.intercept(slopes)
        rows.append((int(f), test.mse(slopes, b), test.r2(slopes, b)))
    return df.sparkSession.createDataFrame(rows, "fold int, mse double, r2 double")


def lasso_path(
    df: DataFrame, features: Sequence[str], target: str, fold: str, alphas: Sequence[float]
) -> DataFrame:
    """Per alpha the coefficients of the scaled features (columns ``w_<feature>``) and the mean
    hold-out and the training MSE and R2."""
    parts = cross_products(df, features, target, fold)
    total = sum(parts.values())
    whole = _Moments(total)
    folds = [(_Moments(total - held), _Moments(held)) for _, held in sorted(parts.items())]
    starts = [np.zeros(len(features)) for _ in range(len(folds) + 1)]
    rows = []
    for alpha in sorted(alphas, reverse=True):  # each fit starts from the next larger alpha's
        starts[0] = whole.lasso(alpha, starts[0])
        slopes = starts[0] / whole.scale
        b = whole.intercept(slopes)
        scores = []
        for i, (train, test) in enumerate(folds, start=1):
            starts[i] = train.lasso(alpha, starts[i])
            s = starts[i] / train.scale
            scores.append((test.mse(s, train.intercept(s)), test.r2(s, train.intercept(s))))
        val_mse, val_r2 = (None if None in part else float(np.mean(part)) for part in zip(*scores))
        rows.append(
            [float(alpha), *map(float, starts[0]), whole.r2(slopes, b), val_r2, whole.mse(slopes, b), val_mse]
        )
    names = ["alpha", *[f"w_{f}" for f in features], "train_r2", "val_r2", "train_mse", "val_mse"]
    schema = ", ".join(f"`{n}` double" for n in names)
    return df.sparkSession.createDataFrame(rows[::-1], schema)
