"""Crashes by street and hour, crashes between intersections, and crashes without coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.operators.aggregates import distinct_month_count, group_agg_named, mode_value
from curbline.operators.intersections import away_from_intersections
from curbline.operators.relational import (
    cross_street_rows,
    drop_duplicates_first,
    off_street_rows,
    unlocated_injury_filter,
)
from curbline.operators.spatial_join import spatial_join_aggregate, spatial_pairs
from curbline.plans.layers import load_street_lines, with_street_key
from curbline.session import settle

HOURLY_ATTRIBUTES = ("rw_type", "bike_lane", "shape_leng", "trafdir", "st_width")


def street_profile(
    streets: DataFrame, limits: DataFrame, humps: DataFrame, radius: float = 32.0
) -> DataFrame:
    """Streets, one per geometry, with the mean speed limit (missing ones take the most frequent
    limit found) and the number of humps among the centroids in their buffers."""
    lines = with_street_key(
        drop_duplicates_first(
            streets.select("physicalid", *HOURLY_ATTRIBUTES, "geometry"), ["geometry"], ["physicalid"]
        )
    )
    keyed = lines.select("street", "geometry")
    near_limits = settle(
        spatial_pairs(limits, keyed, radius, point_id="limit_id", closed=True), "street-limits"
    )
    usual = mode_value(near_limits, "postvz_sl")
    limit = group_agg_named(near_limits, ["street"], {"postvz_sl": "mean"})
    near_humps = spatial_pairs(humps, keyed, radius, point_id="hump_id", closed=True)
    hump = group_agg_named(near_humps, ["street"], {"humps": "sum"})
    return (
        lines.join(limit, "street", "left")
        .join(hump, "street", "left")
        .withColumns(
            {
                "postvz_sl": F.coalesce("postvz_sl", usual.cast("double")),
                "humps": F.coalesce(F.col("humps").cast("double"), F.lit(0.0)),
            }
        )
    )


def crashes_by_street_hour(
    profile: DataFrame, crashes: DataFrame, radius: float = 32.0, *, count_missing_month: bool = False,
    keep_key: bool = False,
) -> DataFrame:
    """Average monthly crashes per street and hour of day; a street without any crash has one row
    without hour.

    ``crashes`` has ``datetime``. ``count_missing_month`` lets streets without crashes add one to
    the number of months, as a distinct count over all rows would. ``keep_key`` keeps the key of
    the street row as ``street``.
    """
    places = settle(crashes.groupBy("x", "y", "datetime").agg(F.count(F.lit(1)).alias("n")), "places")
    found = settle(
        spatial_pairs(
            places, profile.select("street", "geometry"), radius,
            point_id=["x", "y", "datetime"], closed=True,
        )
        .groupBy("street", "datetime")
        .agg(F.sum("n").alias("n")),
        "street-crashes",
    )
    hourly = found.groupBy("street", F.hour("datetime").alias("hour")).agg(F.sum("n").alias("n"))
    joined = profile.drop("geometry").join(hourly, "street", "left")
    months = distinct_month_count(found, "datetime").scalar()
    if count_missing_month:
        bare = joined.agg(F.max(F.col("n").isNull().cast("long"))).scalar()
        months = months + bare
    return joined.withColumn(
        "crashes", F.try_divide(F.coalesce("n", F.lit(0)), months.cast("double"))
    ).drop("n", *([] if keep_key else ["street"]))


def mid_block_crashes(
    crashes: DataFrame,
    streets: DataFrame,
    radius: float,
    *,
    humps: DataFrame | None = None,
    limits: DataFrame | None = None,
    trees: DataFrame | None = None,
    extra_columns: Sequence[str] = (),
) -> DataFrame:
    """Crashes away from street ends with the streets whose buffer they lie in.

    ``humps`` (centroids) adds the humps and earliest installation of the street, ``limits`` its
    mean limit, ``trees`` the number of trees.
    """
    lines = settle(with_street_key(load_street_lines(streets, ["shape_leng", "st_width"])), "streets")
    between = away_from_intersections(crashes, lines, radius, point_id="collision_id")
    described = lines
    wanted = ["collision_id", "x", "y", "datetime", *extra_columns, "physicalid", "shape_leng", "st_width"]
    if humps is not None:
        described = spatial_join_aggregate(
            described, humps, radius, {"humps": "sum", "date_insta": "min"},
            street_id="street", point_id="hump_id",
        )
        wanted += ["humps", "date_insta"]
    if limits is not None:
        described = spatial_join_aggregate(
            described, limits, radius, {"postvz_sl": "mean"}, street_id="street", point_id="limit_id"
        )
        wanted.append("postvz_sl")
    if trees is not None:
        counted = spatial_join_aggregate(
            described, trees, radius, {"tree_id": "count"}, street_id="street", point_id="tree_id"
        )
        described = counted.withColumnRenamed("tree_id", "trees")
        wanted.append("trees")
    pairs = spatial_pairs(
        between.select("collision_id", "x", "y", "datetime", *extra_columns),
        described, radius, point_id="collision_id", closed=True,
    )
    return pairs.select(*wanted)


def crash_location_gaps(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Injury crashes without coordinates: (those with an off-street address, those of the rest
    naming a crossing)."""
    unlocated = unlocated_injury_filter(raw)
    return off_street_rows(unlocated), cross_street_rows(unlocated)
