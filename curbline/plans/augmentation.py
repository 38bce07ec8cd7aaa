"""Predicting the collision rate a street would have with speed humps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.operators.aggregates import group_agg_named, mode_value, two_level_average
from curbline.operators.nearest import nearest_join
from curbline.operators.relational import drop_duplicates_first
from curbline.operators.spatial_join import line_within_buffer_pairs, spatial_pairs
from curbline.session import settle


def volume_sites(volumes: DataFrame) -> DataFrame:
    """Mean daily volume per count site."""
    return two_level_average(volumes, ["site_id", "x", "y"], ["yr", "m", "d"], "vol")


def hump_augmentation_dataset(
    difference: DataFrame,
    streets: DataFrame,
    volumes: DataFrame,
    limits: DataFrame,
    trees: DataFrame,
    *,
    radius: float = 25.0,
    tree_radius: float = 40.0,
) -> DataFrame:
    """Before/after pairs with street attributes, the nearest site's volume, the mean limit of the
    limit lines in the street's buffer (the most frequent limit where there is none) and the
    number of trees. Streets with a missing attribute drop out, as NULL grouping keys do."""
    attributes = streets.select(
        "physicalid", F.coalesce(F.col("bike_lane").cast("double"), F.lit(0.0)).alias("bike_lane"),
        F.col("shape_leng").alias("road_leng"), "st_width", "geometry",
    )
    described = settle(
        drop_duplicates_first(
            difference.join(attributes, "physicalid"), ["physicalid", "humps"], ["road_leng", "st_width"]
        ),
        "hump-streets",
    )
    lines = drop_duplicates_first(described.select("physicalid", "geometry"), ["physicalid"], ["physicalid"])
    volume = nearest_join(
        lines, volume_sites(volumes), line_id="physicalid", site_id="site_id", buffer=radius
    ).select("physicalid", "vol")
    inside = line_within_buffer_pairs(
        limits.select("limit_id", "geometry"), lines, radius, inner_id="limit_id", outer_id="physicalid"
    )
    matched = settle(
        inside.join(limits.select("limit_id", F.col("postvz_sl").alias("speed_limit")), "limit_id"),
        "hump-limits",
    )
    usual = mode_value(matched, "speed_limit")
    limit = group_agg_named(matched, ["physicalid"], {"speed_limit": "mean"})
    near_trees = spatial_pairs(trees, lines, tree_radius, point_id="tree_id")
    planted = group_agg_named(near_trees, ["physicalid"], {"tree_id": "count"}, rename={"tree_id": "tree_count"})
    return (
        described.drop("geometry")
        .join(volume, "physicalid", "left")
        .join(limit, "physicalid", "left")
        .join(planted, "physicalid", "left")
        .withColumn("speed_limit", F.coalesce("speed_limit", usual))
        .fillna({"tree_count": 0})
        .dropna()
    )
