"""Row-level operators: filters, flags, fills, de-duplication and joins, with the rule that a
comparison with a missing value is false."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.operators.spatial_join import spread_hot_keys

# The street-name parts that mark a street type.
AVENUE_SUFFIXES = ("AVE", "BLVD")
AVENUE_PREFIX = "AVE"
AVENUE_NAMES = ("BROADWAY", "BOWERY")
STREET_SUFFIX = "ST"
ROAD_SUFFIXES = ("RD", "ROAD")


def is_true(condition: Column) -> Column:
    """A condition that is false, not NULL, where a value is missing."""
    return F.coalesce(condition, F.lit(False))


def street_filter(df: DataFrame, *, road_type: str = "1", min_length: float = 80.0) -> DataFrame:
    return df.where(
        (F.col("rw_type") == road_type) & (F.col("shape_leng").cast("double") > min_length)
    )


def street_type_flags(df: DataFrame) -> DataFrame:
    """Add ``is_av``, ``is_st`` and ``is_rd`` from the parts of the street name."""
    return df.withColumns(
        {
            "is_av": is_true(F.col("post_type").isin(*AVENUE_SUFFIXES))
            | is_true(F.col("pre_type") == AVENUE_PREFIX)
            | is_true(F.col("st_name").isin(*AVENUE_NAMES)),
            "is_st": is_true(F.col("post_type") == STREET_SUFFIX),
            "is_rd": is_true(F.col("post_type").isin(*ROAD_SUFFIXES)),
        }
    )


def is_present_flag(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(column).isNotNull())


def positive_flag(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, is_true(F.col(column).cast("double") > 0))


def cast_columns(df: DataFrame, types: dict[str, str], *, strict: bool = True) -> DataFrame:
    """Cast text columns; text that does not parse raises, or gives NULL unless ``strict``."""
    cast = Column.cast if strict else Column.try_cast
    return df.withColumns({c: cast(F.col(c), t) for c, t in types.items()})


def date_window_filter(
    df: DataFrame, *, until_after: datetime, after_before: datetime
) -> DataFrame:
    """Interval rows that reach past ``until_after`` and start before ``after_before``."""
    return df.where(
        (F.col("until") > F.lit(until_after).cast("timestamp_ntz"))
        & (F.col("after") < F.lit(after_before).cast("timestamp_ntz"))
    )


def margin_window_filter(
    df: DataFrame, installed: str, *, first_event: Column, as_of: datetime, days: int = 365
) -> DataFrame:
    """Installations more than ``days`` after the first event and before ``as_of``."""
    end = F.lit(as_of).cast("timestamp_ntz")
    return df.where(
        (F.col(installed) > F.timestamp_add("DAY", F.lit(days), first_event))
        & (F.col(installed) < F.timestamp_add("DAY", F.lit(-days), end))
    )


def positive_width_filter(df: DataFrame, width: str = "st_width") -> DataFrame:
    return df.where(F.col(width) > 0)


def is_blank_text(text: Column) -> Column:
    """White space only. Empty text does not count."""
    return text.rlike(r"^\s+$")


def unlocated_injury_filter(df: DataFrame) -> DataFrame:
    """Crashes without a latitude in which people were injured or killed."""
    return df.where(
        F.col("latitude").isNull() & (F.col("persons_injured") + F.col("persons_killed") > 0)
    )


def has_off_street() -> Column:
    name = F.col("off_street_name")
    return name.isNotNull() & ~is_true(is_blank_text(name))


def off_street_rows(df: DataFrame) -> DataFrame:
    return df.where(has_off_street())


def cross_street_rows(df: DataFrame) -> DataFrame:
    """The rows not on the off-street list that name both streets of a crossing."""
    return df.where(
        ~has_off_street()
        & F.col("cross_street_name").isNotNull()
        & F.col("on_street_name").isNotNull()
    )


def drop_duplicates_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First row per key in the given order.

    An aggregate over the whole row: it combines on the map side, so a key repeated very often
    does not bring all its copies to one task, as a ranking window would.
    """
    ranks = F.struct(*order)
    first = F.min_by(F.struct(*df.columns), ranks).alias("_row")
    return df.groupBy(*keys).agg(first).select("_row.*")


def multi_left_join(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left join several tables on the same keys, which are shuffled by them once."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), frames)


def inner_join_suffixes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_before", "_after")
) -> DataFrame:
    """Inner join whose shared non-key columns get a suffix per side."""
    shared = [c for c in before.columns if c in after.columns and c not in keys]
    a = before.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = after.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, list(keys))


def replace_by_group_values(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Replace row attributes by their largest value per key."""
    largest = df.groupBy(key).agg(*[F.max(c).alias(c) for c in columns])
    kept = df.drop(*columns)
    spread, copied = spread_hot_keys(kept, largest, [key], [c for c in kept.columns if c != key] or [key])
    return spread.join(copied, [key, "salt"], "left").drop("salt")


def densify(
    entities: DataFrame, facts: DataFrame, keys: Sequence[str], flag: str, fill: Sequence[str]
) -> DataFrame:
    """Every entity with ``flag`` false and true, the facts joined, missing facts 0."""
    both = entities.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias(flag))
    return both.join(facts, [*keys, flag], "left").fillna(0, subset=list(fill))


def before_after_left_join(
    df: DataFrame, key: str, flag: str, value: str, names: tuple[str, str], *, unique: bool = False
) -> DataFrame:
    """Per key the value of every row without the flag with that of every row with it; incomplete
    pairs are dropped.

    ``unique`` promises at most one row per key and flag. Then one conditional aggregate takes the
    place of the self-join, and the table is read and shuffled once.
    """
    if not unique:
        before = df.where(~F.col(flag)).select(key, F.col(value).alias(names[0])).dropna()
        after = df.where(F.col(flag)).select(key, F.col(value).alias(names[1])).dropna()
        return before.join(after, key)
    return (
        df.groupBy(key)
        .agg(
            F.max(F.when(~F.col(flag), F.col(value))).alias(names[0]),
            F.max(F.when(F.col(flag), F.col(value))).alias(names[1]),
        )
        .dropna()
    )


def semi_join_isin(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def anti_join_isin(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def rows_around_min(df: DataFrame, order: str, value: str, k: int) -> DataFrame:
    """The row with the least ``value``, the k rows before it in ``order`` and the k-1 after.

    Two top-k selections around the minimum; the table itself is not sorted as a whole.
    """
    least = df.agg(F.min_by(order, F.struct(value, order))).scalar()
    before = df.where(F.col(order) < least).orderBy(F.col(order).desc()).limit(k)
    after = df.where(F.col(order) >= least).orderBy(order).limit(k)
    return before.unionByName(after)
