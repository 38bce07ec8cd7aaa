"""Feature preparation: fitted on one table, applied to any table of the same columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Imputer, ImputerModel, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 1000

#: How a transformer's statement names its input, and the vector column that models read.
INPUT, VECTOR = "__THIS__", "features"


def vector_stages(expressions: Sequence[str]) -> list:
    """Stages computing the expressions into one vector column."""
    names = [f"_x{i}" for i in range(len(expressions))]
    columns = ", ".join(f"{e} AS {n}" for e, n in zip(expressions, names))
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM {INPUT}"),
        VectorAssembler(inputCols=names, outputCol=VECTOR),
    ]


def fit_impute_mean(
    train: DataFrame, columns: Sequence[str], *, missing_value: float | None = None
) -> ImputerModel:
    """Missing values become the column mean; with ``missing_value`` that value (say 0) is what
    is replaced, by the mean of the others. Apply with ``.transform``."""
    imputer = Imputer(strategy="mean", inputCols=list(columns), outputCols=list(columns))
    if missing_value is not None:
        imputer = imputer.setMissingValue(missing_value)
    return imputer.fit(train)


def impute_constant(df: DataFrame, values: dict[str, float | int | str]) -> DataFrame:
    return df.fillna(values)


@dataclass(frozen=True)
class Scaler:
    """(x - mean) / population deviation; a constant column is only shifted."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def expressions(self) -> list[str]:
        return [
            f"(cast({c} as double) - {m!r}D) / {d!r}D"
            for c, m, d in zip(self.columns, self.means, self.deviations)
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(e) for c, e in zip(self.columns, self.expressions())})


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean and deviation of all columns in one pass."""
    numbers = [F.expr(c).cast("double") for c in columns]
    row = train.agg(*[F.avg(c) for c in numbers], *[F.stddev_pop(c) for c in numbers]).first()
    p = len(columns)
    return Scaler(
        tuple(columns),
        tuple(float(v) for v in row[:p]),
        tuple(float(v) or 1.0 for v in row[p:]),
    )


def categories_of(df: DataFrame, column: str, most: int | None = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct values of a categorical column; refuses one of more than ``most`` values (None:
    any number), as each of them becomes a column."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct()
    values = [r[0] for r in (found if most is None else found.limit(most + 1)).collect()]
    if most is not None and len(values) > most:
        raise ValueError(f"column {column!r} has more than {most} values")
    return sorted(values)


def one_hot_fixed(df: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """0/1 column ``<column>_<value>`` per given category; an unlisted or missing value gives 0
    in all of them."""
    indicators = {
        f"{c}_{v}": F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
        for c, values in categories.items()
        for v in values
    }
    return df.select(
        *[c for c in df.columns if c not in categories],
        *[e.alias(n) for n, e in indicators.items()],
    )


def one_hot(df: DataFrame, columns: Sequence[str], *, most: int | None = MAX_CATEGORIES) -> DataFrame:
    """As ``one_hot_fixed`` with the categories found in the table, at most ``most`` a column."""
    return one_hot_fixed(df, {c: categories_of(df, c, most) for c in columns})


def quadratic_expressions(columns: Sequence[str]) -> dict[str, str]:
    """Name to expression of all monomials of degree 1 and 2, without the constant."""
    terms = {c: f"cast({c} as double)" for c in columns}
    for i, a in enumerate(columns):
        for b in columns[i:]:
            name = f"{a}_sq" if a == b else f"{a}_x_{b}"
            terms[name] = f"cast({a} as double) * cast({b} as double)"
    return terms


def quadratic_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in columns]
    terms = quadratic_expressions(columns)
    return df.select(*rest, *[F.expr(e).alias(n) for n, e in terms.items()])


def column_transform(
    df: DataFrame, transformations: dict[str, str], *, passthrough: Sequence[str] = ()
) -> DataFrame:
    """New columns from expressions, the ``passthrough`` columns as they are, the rest dropped."""
    return df.select(*[F.expr(e).alias(n) for n, e in transformations.items()], *passthrough)
