"""Grouped and whole-table aggregates with the missing-value rules of data-frame libraries:
a sum of nothing is 0, a mean or extreme of nothing is missing, NULL group keys are dropped."""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import settle

AGGREGATES = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "count": F.count,
}


def aggregate_by_name(name: str):
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate {name!r}, expected one of {sorted(AGGREGATES)}")
    return AGGREGATES[name]


def group_agg_named(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, str],
    *,
    rename: dict[str, str] | None = None,
    keep_null_keys: bool = True,
) -> DataFrame:
    """One aggregate per column, named after it (or after ``rename``)."""
    rows = df if keep_null_keys else df.dropna(subset=list(keys))
    names = rename or {}
    return rows.groupBy(*keys).agg(
        *[aggregate_by_name(op)(F.col(c)).alias(names.get(c, c)) for c, op in aggregates.items()]
    )


def two_level_average(
    df: DataFrame, site: Sequence[str], period: Sequence[str], value: str
) -> DataFrame:
    """Sum per site and period, then the mean of those sums per site."""
    totals = df.dropna(subset=[*site, *period]).groupBy(*site, *period).agg(
        AGGREGATES["sum"](F.col(value)).alias(value)
    )
    return totals.groupBy(*site).agg(F.avg(value).alias(value))


def count_if_groups(df: DataFrame, keys: Sequence[str], condition: Column, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(condition).alias(name))


def dedupe_by_geometry(df: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """Merge rows with the same geometry."""
    return group_agg_named(df, ["geometry"], aggregates)


def mode_value(df: DataFrame, column: str) -> Column:
    """Most frequent value, the smallest on a tie, as a scalar subquery.

    Counts per value are combined on the map side; one row per distinct value is compared.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column)))).scalar()


def scalar_min(df: DataFrame, column: str) -> Column:
    return df.agg(F.min(column)).scalar()


def distinct_month_count(df: DataFrame, timestamp: str, *, count_missing: bool = False) -> DataFrame:
    """Number of distinct (month, year) pairs; ``count_missing`` lets an absent date add one."""
    months = df.select(
        F.month(timestamp).alias("month"), F.year(timestamp).alias("year")
    )
    if not count_missing:
        months = months.dropna()
    return months.distinct().agg(F.count(F.lit(1)).alias("months"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), column)
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of present values of every column, in one pass."""
    types = dict(df.dtypes)
    names = df.columns
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("non_null")
        )
        for c in names
    ]
    return counts.select(F.inline(F.array(*entries)))


#: Bits of a number that one pass of the quantile search settles.
DIGIT = 16


def ordered_image(value: Column) -> Column:
    """A long integer that sorts as the double does: its exponent and fraction bits, negative for negative numbers.

    The exponent from the logarithm is corrected by comparing powers of two, and all divisions are by powers of
    two, so the image is exact. NaN has none; both zeros have 0.
    """
    size, two = F.abs(value), F.lit(2.0)
    guess = F.floor(F.log2(size))
    power = F.pow(two, guess)
    exponent = F.when(power > size, guess - 1).when(power * 2 <= size, guess + 1).otherwise(guess)
    normal = (exponent + 1023) * (1 << 52) + ((size / F.pow(two, exponent) - 1) * float(1 << 52)).cast("long")
    tiny = (size * float(1 << 537) * float(1 << 537)).cast("long")
    image = (
        F.when(size == float("inf"), F.lit(2047 << 52))
        .when(size >= 2.0**-1022, normal)
        .otherwise(tiny)
    )
    return F.when(F.isnan(value), F.lit(None)).when(value < 0, -image).otherwise(image)


def number_of_image(image: int) -> float:
    """The double that ``ordered_image`` maps to this integer."""
    value = struct.unpack("<d", struct.pack("<q", abs(image)))[0]
    return -value if image < 0 else value


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``column share value``: quantiles with linear interpolation between neighbours. NULL and NaN are missing.

    Built-in exact percentiles keep a count per distinct value in one task. Here a radix selection finds the wanted
    ranks: numbers become integers of the same order, and each of four passes counts the next 16 bits of those that
    begin like a wanted rank, combined on the map side. Nothing is sorted or gathered, however uneven the values are.
    """
    entries = [F.struct(F.lit(c).alias("column"), ordered_image(F.col(c).cast("double")).alias("key")) for c in columns]
    long = settle(df.select(F.inline(F.array(*entries))).where(F.col("key").isNotNull()), "quantile-keys")
    sizes = {r["column"]: r["n"] for r in long.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    # (column, rank): how the number of this rank begins, and how many numbers begin with less
    wanted = {
        (c, rank): (0, 0)
        for c, n in sizes.items() for s in shares for rank in (math.floor(s * (n - 1)), math.ceil(s * (n - 1)))
    }
    for shift in range(64 - DIGIT, -1, -DIGIT):
        wanted = _next_digit(long, wanted, shift) if wanted else {}
    rows = []
    for c, n in sizes.items():
        for share in shares:
            at = share * (n - 1)
            low, high = (number_of_image(wanted[c, r][0]) for r in (math.floor(at), math.ceil(at)))
            rows.append((c, float(share), low + (high - low) * (at - math.floor(at)) if high > low else low))
    return df.sparkSession.createDataFrame(rows, "column string, share double, value double")


def _next_digit(long: DataFrame, wanted: dict[tuple, tuple[int, int]], shift: int) -> dict[tuple, tuple[int, int]]:
    """The beginnings of the wanted ranks with ``DIGIT`` more bits. They are two a share and column at most."""
    spark = long.sparkSession
    ranks = F.broadcast(spark.createDataFrame(
        [(c, rank, begin, before) for (c, rank), (begin, before) in wanted.items()],
        "column string, rank long, begin long, before long",
    ))
    first = shift + DIGIT == 64
    begin = F.lit(0).cast("long") if first else F.shiftright("key", shift + DIGIT)
    counts = (
        long.withColumn("begin", begin).join(ranks.select("column", "begin").distinct(), ["column", "begin"], "left_semi")
        .groupBy("column", "begin", F.shiftright("key", shift).alias("longer")).agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("column", "begin").orderBy("longer")  # 2 ** DIGIT rows at most
    running = counts.withColumn("less", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    place = F.col("rank") - F.col("before")
    found = running.join(ranks, ["column", "begin"]).where((place >= F.col("less")) & (place < F.col("less") + F.col("n")))
    return {
        (r["column"], r["rank"]): (r["longer"], r["before"] + r["less"])
        for r in found.select("column", "rank", "longer", "before", "less").collect()
    }


def describe(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column, NULL and NaN being missing; ``exact=False``
    estimates the quartiles in the same pass as the rest."""
    floating = {n for n, t in df.dtypes if t in ("float", "double")}
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in columns])
    measures = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    if not exact:
        measures |= {
            n: lambda c, s=s: F.percentile_approx(c, F.lit(s)).cast("double") for n, s in quartiles.items()
        }
    row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[measure(F.col(c)).alias(name) for name, measure in measures.items()],
            ).alias(c)
            for c in columns
        ]
    )
    table = row.select(F.inline(F.array(*columns)))
    if not exact:
        return table
    found = exact_quantiles(df, columns, list(quartiles.values()))
    wide = found.groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for n, s in quartiles.items()]
    )
    return table.join(wide, "column", "left")


def histogram(
    df: DataFrame, column: str, bins: int, hue: str | None = None
) -> DataFrame:
    """Counts in ``bins`` equal-width bins over the whole range, per value of ``hue``.

    The last bin is closed on the right. All groups share the bins.
    """
    present = df.where(F.col(column).isNotNull())
    bounds = present.agg(
        F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    ).scalar()
    width = (bounds["high"] - bounds["low"]) / F.lit(bins)
    position = F.coalesce(
        F.floor(F.try_divide(F.col(column).cast("double") - bounds["low"], width)), F.lit(0)
    )
    keys = ([hue] if hue else []) + ["bin"]
    return (
        present.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def month_hour_distribution(df: DataFrame, timestamp: str) -> DataFrame:
    return (
        df.where(F.col(timestamp).isNotNull())
        .groupBy(F.month(timestamp).alias("month"), F.hour(timestamp).alias("hour"))
        .agg(F.count(F.lit(1)).alias("crashes"))
    )
