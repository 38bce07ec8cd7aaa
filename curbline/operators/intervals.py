"""Validity intervals, half open: a row with ``after`` and ``until`` holds for
``after < t <= until``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.operators.spatial_join import line_within_buffer_pairs, spread_hot_keys

HORIZON = (datetime(2012, 7, 1), datetime(2024, 4, 1))
SECONDS_PER_WEEK = 604800.0


def in_interval(t: Column, after: str = "after", until: str = "until") -> Column:
    """False, never NULL, for an undated event."""
    return F.coalesce((t > F.col(after)) & (t <= F.col(until)), F.lit(False))


def validity_split(
    df: DataFrame,
    installed: str,
    flag: str,
    *,
    horizon: tuple[datetime, datetime] = HORIZON,
) -> DataFrame:
    """One row per street without installation, two (before, after) with one.

    Replaces column ``installed`` by ``after``, ``until`` and the boolean ``flag``.
    """
    start, end = (F.lit(t).cast("timestamp_ntz") for t in horizon)
    moment = F.col(installed).cast("timestamp_ntz")

    def row(after: Column, until: Column, has: bool) -> Column:
        return F.struct(after.alias("after"), until.alias("until"), F.lit(has).alias(flag))

    rows = F.when(moment.isNull(), F.array(row(start, end, False))).otherwise(
        F.array(row(start, moment, False), row(moment, end, True))
    )
    kept = [c for c in df.columns if c != installed]
    return df.select(*kept, F.inline(rows))


def linear_feature_flag(
    features: DataFrame,
    streets: DataFrame,
    flag: str,
    *,
    feature_id: str,
    date_column: str,
    street_id: str = "physicalid",
    predicate: str = "contains",
    radius: float = 30.0,
    horizon: tuple[datetime, datetime] = HORIZON,
) -> DataFrame:
    """``(street_id, after, until, flag)``: the newest installation among the features whose
    buffer contains the street, as validity intervals."""
    if predicate != "contains":
        raise ValueError(f"predicate {predicate!r} is not supported for linear features")
    contained = line_within_buffer_pairs(
        streets.select(street_id, "geometry"), features.select(feature_id, "geometry"), radius,
        inner_id=street_id, outer_id=feature_id,
    )
    newest = (
        contained.join(features.select(feature_id, date_column), feature_id)
        .groupBy(street_id)
        .agg(F.max(date_column).alias("_installed"))
    )
    dated = streets.select(street_id).distinct().join(newest, street_id, "left")
    return validity_split(dated, "_installed", flag, horizon=horizon)


def add_linear_feature(streets: DataFrame, features: DataFrame, flag: str, **options) -> DataFrame:
    """Street table with the interval rows of a linear feature (see ``linear_feature_flag``)."""
    key = options.get("street_id", "physicalid")
    return streets.join(linear_feature_flag(features, streets, flag, **options), key, "left")


def interval_join(
    rows: DataFrame,
    events: DataFrame,
    key: str,
    event_time: str,
    *,
    keys: Sequence[str],
    name: str,
) -> DataFrame:
    """Number of events of the same key inside each row's interval; 0 where there is none.

    Events are counted per key and time first; keys that still hold very many are spread.
    """
    counted = events.groupBy(key, event_time).agg(F.count(F.lit(1)).alias("_n"))
    bounds = rows.select(*dict.fromkeys([key, "after", "until", *keys]))
    spread, copied = spread_hot_keys(counted, bounds, [key], [event_time])
    hits = (
        spread.join(copied, [key, "salt"])
        .where(in_interval(F.col(event_time)))
        .groupBy(*keys)
        .agg(F.sum("_n").alias(name))
    )
    return rows.select(*keys).distinct().join(hits, list(keys), "left").fillna({name: 0})


def weeks_between(start: Column, end: Column) -> Column:
    """Fractional weeks from ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(SECONDS_PER_WEEK)


def weekly_rate(count: Column, start: Column, end: Column) -> Column:
    return F.try_divide(count, weeks_between(start, end))
