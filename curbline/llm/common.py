"""Expressions and small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: A word: a longest run of other characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_spaces(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` does just that for texts of one-byte characters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run within hand at most so many rows at once to Python, so that long texts fit in a worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hot_limit(total: int, spark: SparkSession) -> int:
    """Weight above which a key is hot: half a mean partition's share.

    The weights add up to ``total``, so fewer than twice as many keys as there are partitions can be
    hot. That is the size bound of every broadcast of hot keys in this package.
    """
    return max(1, total // (2 * partitions(spark)))
