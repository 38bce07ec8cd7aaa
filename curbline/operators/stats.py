"""Evaluation statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _error(label: str, prediction: str) -> Column:
    return F.col(label) - F.col(prediction)


def mse(label: str, prediction: str = "prediction") -> Column:
    return F.avg(_error(label, prediction) * _error(label, prediction))


def mae(label: str, prediction: str = "prediction") -> Column:
    return F.avg(F.abs(_error(label, prediction)))


def r2(label: str, prediction: str = "prediction") -> Column:
    """1 - residual over total sum of squares, in one pass; NULL for a constant label."""
    squares = F.sum(_error(label, prediction) * _error(label, prediction))
    total = F.var_pop(label) * F.count(label)
    return F.lit(1.0) - F.try_divide(squares, total)


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        mse(label, prediction).alias("mse"),
        mae(label, prediction).alias("mae"),
        r2(label, prediction).alias("r2"),
    )


def residuals(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(prediction) - F.col(label))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, ``a b correlation``; rows missing one of the two are
    left out for that pair, booleans count as 0/1. All pairs come from one pass."""
    def number(c: str) -> Column:
        return F.col(c).cast("double")

    def pair(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(both, number(a)), F.when(both, number(b)))

    names = list(columns)
    upper = {(i, j): f"_{i}_{j}" for i in range(len(names)) for j in range(i, len(names))}
    row = df.agg(*[pair(names[i], names[j]).alias(n) for (i, j), n in upper.items()])
    entries = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            F.col(upper[min(i, j), max(i, j)]).alias("correlation"),
        )
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return row.select(F.inline(F.array(*entries)))


def simple_regression(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept and number of rows of the least-squares line of y on x."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("n"),
    )
