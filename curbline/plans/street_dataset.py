"""The street table for modelling: collision rates and attributes per street and interval."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.transforms import rate_per_length
from curbline.operators.intervals import HORIZON, add_linear_feature, weekly_rate
from curbline.operators.point_features import PointFeature, point_feature_values
from curbline.operators.relational import (
    cast_columns,
    date_window_filter,
    drop_duplicates_first,
    is_present_flag,
    is_true,
    multi_left_join,
    positive_width_filter,
    street_filter,
    street_type_flags,
)
from curbline.operators.spatial_join import line_within_buffer_pairs
from curbline.operators.splits import train_test_split
from curbline.session import settle

# Columns of the street layer, as the dataset names them.
STREET_COLUMNS = (
    "physicalid", "geometry", "bike_lane", "st_width", "shape_leng", "post_type", "pre_type", "st_name",
)
DEFAULT_SPEED_LIMIT = 25.0


@dataclass(frozen=True)
class Layers:
    """Planar layers: ``streets``, ``speedhumps`` and ``speedlimits`` with ``geometry``, the
    others with ``x`` and ``y``."""

    streets: DataFrame
    crashes: DataFrame
    speedhumps: DataFrame
    speedlimits: DataFrame
    trees: DataFrame
    traffic_volumes: DataFrame
    parking_meters: DataFrame


@dataclass(frozen=True)
class Settings:
    horizon: tuple[datetime, datetime] = HORIZON
    # interval rows must reach past the first and start before the second of these
    window: tuple[datetime, datetime] = (datetime(2013, 7, 1), datetime(2023, 3, 1))
    radius: float = 30.0


def street_table(streets: DataFrame) -> DataFrame:
    """Streets long enough, one row each, with type flags."""
    wanted = street_filter(streets).select(*STREET_COLUMNS)
    single = drop_duplicates_first(wanted, ["physicalid"], ["shape_leng", "st_width"])
    typed = cast_columns(single, {"physicalid": "long", "st_width": "double", "shape_leng": "double"})
    flagged = street_type_flags(is_present_flag(typed, "bike_lane", "has_bike_lane"))
    return flagged.drop("bike_lane", "post_type", "pre_type", "st_name")


def interval_streets(layers: Layers, settings: Settings = Settings()) -> DataFrame:
    """Street table with ``has_humps`` and its validity intervals."""
    streets = street_table(layers.streets)
    split = add_linear_feature(
        streets, layers.speedhumps, "has_humps", feature_id="hump_id", date_column="date_insta",
        radius=settings.radius, horizon=settings.horizon,
    )
    return date_window_filter(
        split, until_after=settings.window[0], after_before=settings.window[1]
    )


def line_feature_max(
    features: DataFrame, streets: DataFrame, radius: float, *, feature_id: str, value: str, name: str
) -> DataFrame:
    """Largest value among the line features lying entirely in the street's buffer."""
    inside = line_within_buffer_pairs(
        features.select(feature_id, "geometry"), streets.select("physicalid", "geometry"), radius,
        inner_id=feature_id, outer_id="physicalid",
    )
    return (
        inside.join(features.select(feature_id, F.col(value).cast("double").alias(value)), feature_id)
        .groupBy("physicalid")
        .agg(F.max(value).alias(name))
    )


def street_collision_dataset(layers: Layers, settings: Settings = Settings()) -> DataFrame:
    """One row per street and interval with its weekly collision rate and attributes.

    Only collisions depend on the interval. The other features are computed once per street, so
    streets with two interval rows are not joined twice.
    """
    rows = settle(interval_streets(layers, settings), "streets")
    streets = drop_duplicates_first(rows.select("physicalid", "geometry"), ["physicalid"], ["physicalid"])
    r = settings.radius
    interval = ["physicalid", "after", "until"]
    collisions = point_feature_values(
        PointFeature("collision_rate", layers.crashes, date_column="crash_date", split_by_date=True, radius=r),
        rows, interval,
    )
    per_street = [
        point_feature_values(
            PointFeature("n_trees", layers.trees, radius=r, collapse=False, point_id="tree_id"), streets
        ),
        line_feature_max(
            layers.speedlimits, streets, r, feature_id="limit_id", value="postvz_sl", name="speed_limit"
        ),
        point_feature_values(
            PointFeature("traffic_volume", layers.traffic_volumes, method="value", value_column="vol",
                         operation="mean", radius=r),
            streets,
        ),
        point_feature_values(
            PointFeature("n_parking_meters", layers.parking_meters, radius=r, collapse=False,
                         point_id="meter_id"),
            streets,
        ),
    ]
    joined = multi_left_join([rows, *per_street], ["physicalid"])
    joined = multi_left_join([joined, collisions], interval)
    counted = joined.fillna(0.0, subset=["collision_rate", "n_trees", "n_parking_meters"])
    rated = counted.withColumn(
        "collision_rate", weekly_rate(F.col("collision_rate"), F.col("after"), F.col("until"))
    ).withColumns(
        {
            "collision_rate_per_length": rate_per_length(F.col("collision_rate"), F.col("shape_leng")),
            "has_volume_meas": F.col("traffic_volume").isNotNull(),
            "has_parking_meters": is_true(F.col("n_parking_meters") > 0),
        }
    )
    return positive_width_filter(rated.drop("after", "until")).fillna(
        {"speed_limit": DEFAULT_SPEED_LIMIT}
    )


def with_row_id(dataset: DataFrame, name: str = "row_id") -> DataFrame:
    """Key of a street's interval row: without humps even, with humps odd."""
    return dataset.withColumn(name, F.col("physicalid") * 2 + F.col("has_humps").cast("long"))


def split_dataset(dataset: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the row key, 20 % for testing."""
    train, test = train_test_split(with_row_id(dataset), "row_id", **options)
    return train, test
