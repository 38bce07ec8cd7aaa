"""Train/test splits and folds by an integer hash of a row key, with exact sizes.

The rows are ordered by the hash; a split takes the first ones. Ranking all rows would need one
global sort, so only the cut-off rows are looked for: the hash range is counted in a fixed
number of buckets, and the one bucket holding a cut-off is ranked. Assigning a row is then a
comparison with one or a few cut-offs, without shuffling the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the hash, which any SQL engine can repeat with 64-bit integers:
# h = ((id * MULTIPLIER + seed) mod PRIME) ** 5 mod PRIME. The fifth power permutes the
# residues of this prime, so keys below it never collide, and breaks up runs of keys.
PRIME = 2147483647
MULTIPLIER = 1103515245
BUCKET_BITS = 15
DEFAULT_SEED = 42


def portable_hash(row_id: str, seed: int = DEFAULT_SEED) -> Column:
    x = f"((pmod({row_id}, {PRIME}) * {MULTIPLIER} + {seed}) % {PRIME})"
    square = f"({x} * {x} % {PRIME})"
    return F.expr(f"({square} * {square} % {PRIME}) * {x} % {PRIME}")


def _position(row_id: str, seed: int) -> Column:
    return F.struct(
        portable_hash(row_id, seed).cast("long").alias("h"), F.col(row_id).cast("long").alias("id")
    )


def _join_strata(
    left: DataFrame, right: DataFrame, strata: Sequence[str], keys: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Join on the strata, where NULL is a stratum like any other, and on ``keys``."""
    columns = [*strata, *keys]
    other = right.withColumnsRenamed({c: f"_{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(other, same, how).drop(*[f"_{c}" for c in columns])


def _cutoffs(
    df: DataFrame, row_id: str, seed: int, ranks: Sequence[str], strata: Sequence[str] = ()
) -> DataFrame:
    """Per stratum the positions ``c0, c1, ..`` of the rows with the given ranks. A rank is an
    SQL expression over the stratum's ``total``; rank 0 gives NULL."""
    hashed = df.select(*strata, _position(row_id, seed).alias("p")).withColumn(
        "bucket", F.shiftright("p.h", BUCKET_BITS)
    )
    counts = hashed.groupBy(*strata, "bucket").agg(F.count(F.lit(1)).alias("n"))
    ordered = Window.partitionBy(*strata).orderBy("bucket")
    counts = counts.withColumns(
        {
            "upto": F.sum("n").over(ordered),
            "total": F.sum("n").over(Window.partitionBy(*strata)),
        }
    )
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.expr(rank).cast("long").alias("rank"))
            for i, rank in enumerate(ranks)
        ]
    )
    bounds = (
        counts.select(*strata, "bucket", "n", "upto", F.inline(wanted))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select(*strata, "bucket", "i", (F.col("rank") - F.col("upto") + F.col("n")).alias("place"))
    )
    inside = Window.partitionBy(*strata, "bucket", "i").orderBy("p")
    hits = (
        _join_strata(hashed, bounds, strata, ["bucket"])
        .withColumn("n", F.row_number().over(inside))
        .where(F.col("n") == F.col("place"))
    )
    return hits.groupBy(*strata).agg(
        *[F.max(F.when(F.col("i") == i, F.col("p"))).alias(f"c{i}") for i in range(len(ranks))]
    )


def with_test_flag(
    df: DataFrame,
    row_id: str,
    *,
    test_size: float = 0.2,
    seed: int = DEFAULT_SEED,
    strata: Sequence[str] = (),
    exact: bool = True,
    name: str = "is_test",
) -> DataFrame:
    """Add ``is_test`` for ceil(test_size * n) rows, within each stratum if ``strata`` is given.

    ``exact=False`` compares the hash with a threshold: sizes are approximate, nothing is counted.
    """
    if not exact:
        return df.withColumn(name, portable_hash(row_id, seed) < F.lit(int(PRIME * test_size)))
    rank = f"ceil(total * {Decimal(str(test_size))})"
    cut = _cutoffs(df, row_id, seed, [rank], strata)
    position = _position(row_id, seed)
    if not strata:
        return df.withColumn(name, F.coalesce(position <= cut.select("c0").scalar(), F.lit(False)))
    flagged = _join_strata(df, cut, strata, how="left")
    return flagged.withColumn(name, F.coalesce(position <= F.col("c0"), F.lit(False))).drop("c0")


def train_test_split(df: DataFrame, row_id: str, **options) -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(df, row_id, name="_is_test", **options)
    return (
        flagged.where(~F.col("_is_test")).drop("_is_test"),
        flagged.where(F.col("_is_test")).drop("_is_test"),
    )


def stratified_split(
    df: DataFrame, row_id: str, strata: Sequence[str], **options
) -> tuple[DataFrame, DataFrame]:
    return train_test_split(df, row_id, strata=strata, **options)


def with_fold(
    df: DataFrame,
    row_id: str,
    *,
    folds: int = 5,
    seed: int = DEFAULT_SEED,
    exact: bool = True,
    name: str = "fold",
) -> DataFrame:
    """Add the fold 0..folds-1: contiguous runs in hash order, the first n mod folds one longer.

    ``exact=False`` takes the hash modulo the number of folds, without counting.
    """
    if not exact:
        return df.withColumn(name, F.pmod(portable_hash(row_id, seed), F.lit(folds)).cast("int"))
    ranks = [
        f"{i} * (total div {folds}) + least({i}, total % {folds})" for i in range(1, folds)
    ]
    cuts = _cutoffs(df, row_id, seed, ranks)
    bounds = cuts.select(F.struct(*cuts.columns)).scalar()
    position = _position(row_id, seed)
    fold = F.lit(0)
    for i in range(folds - 1):
        # no cut-off: the fold before it is empty, every row lies beyond
        fold = fold + F.coalesce(position > bounds[f"c{i}"], F.lit(True)).cast("int")
    return df.withColumn(name, fold)
