"""Feature expressions of the regression models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log1p_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(c) for c in columns})


def inverse_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"inv_{c}": F.try_divide(F.lit(1.0), F.col(c) + 1) for c in columns})


def per_tree_ratios(df: DataFrame) -> DataFrame:
    """Logged length and width per tree, counting one tree more than there are."""
    per = F.col("n_trees") + 1
    return df.withColumns(
        {
            "leng_per_tree": F.try_divide(F.log1p("shape_leng"), per),
            "width_per_tree": F.try_divide(F.log1p("st_width"), per),
        }
    )


def hump_ratio_features(df: DataFrame) -> DataFrame:
    """Volume and trees per foot, trees per vehicle. A street without length has no ratio."""
    return df.withColumns(
        {
            "vol_per_leng": F.try_divide(F.col("vol"), F.col("road_leng")),
            "trees_per_leng": F.try_divide(F.col("tree_count"), F.col("road_leng")),
            "trees_per_vol": F.try_divide(F.col("tree_count"), F.col("vol") + 1),
        }
    )


def feature_preprocessor(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """The five features of the hump-effect model, other columns dropped but the key and ``keep``."""
    ratios = hump_ratio_features(df)
    return ratios.select(
        "physicalid",
        F.col("collisions_per_week_before"),
        F.coalesce(F.col("bike_lane").cast("double") > 0, F.lit(False)).alias("has_bike_lane"),
        "trees_per_leng",
        "trees_per_vol",
        "speed_limit",
        *keep,
    )


def rate_per_length(rate: Column, length: Column, scale: float = 1.0) -> Column:
    return F.try_divide(rate * F.lit(scale), length)


def parse_date_time(date: Column, time: Column | None = None) -> Column:
    """``YYYY-MM-DDT...`` and an optional ``H:MM`` to a timestamp without time zone."""
    day = F.to_date(F.split(date, "T")[0])
    midnight = day.cast("timestamp_ntz")
    if time is None:
        return midnight
    clock = F.split(time, ":")
    seconds = clock[0].cast("int") * 3600 + clock[1].cast("int") * 60
    return F.timestamp_add("SECOND", seconds, midnight)


def parse_date(text: Column) -> Column:
    """Text to a timestamp; missing or unreadable text stays missing."""
    return text.try_cast("timestamp_ntz")


def date_parts(timestamp: str) -> dict[str, Column]:
    return {
        "month": F.month(timestamp),
        "hour": F.hour(timestamp),
        "year": F.year(timestamp),
    }


def pedestrians_involved(injured: Column, killed: Column) -> Column:
    return F.coalesce(injured, F.lit(0)) + F.coalesce(killed, F.lit(0))


def strip_name_prefix(names: Sequence[str]) -> list[str]:
    """Output names ``step__column`` without the step."""
    return [n.split("__", 1)[-1] for n in names]
