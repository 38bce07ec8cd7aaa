"""Did collisions drop after speed humps were installed? Before/after studies per street."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.transforms import pedestrians_involved
from curbline.operators.aggregates import scalar_min
from curbline.operators.intervals import weeks_between
from curbline.operators.relational import (
    before_after_left_join,
    densify,
    inner_join_suffixes,
    margin_window_filter,
    replace_by_group_values,
)
from curbline.operators.spatial_join import line_within_buffer_pairs, spatial_pairs
from curbline.plans.layers import with_street_key
from curbline.session import settle

ROAD = ["physicalid", "humps", "shape_leng", "road_leng", "date_insta"]


def hump_roads(streets: DataFrame, humps: DataFrame, radius: float = 25.0) -> DataFrame:
    """Street rows lying in a hump line's buffer, with the largest hump attributes and the number
    of hump lines around them."""
    rows = with_street_key(
        streets.select("physicalid", "geometry", F.col("shape_leng").cast("double").alias("road_leng"))
    )
    inside = line_within_buffer_pairs(
        rows.select("street", "geometry"), humps.select("hump_id", "geometry"), radius,
        inner_id="street", outer_id="hump_id",
    )
    around = (
        inside.join(humps.select("hump_id", "humps", "shape_leng", "date_insta"), "hump_id")
        .groupBy("street")
        .agg(
            F.count(F.lit(1)).alias("hump_lines"),
            F.max("humps").cast("double").alias("humps"),
            F.max("shape_leng").cast("double").alias("shape_leng"),
            F.max("date_insta").alias("date_insta"),
        )
    )
    return rows.join(around, "street")


COUNTS = ["n", "n_walked", "injured", "killed"]


def hump_road_crashes(
    crashes: DataFrame, streets: DataFrame, humps: DataFrame, *, as_of: datetime, radius: float = 25.0
) -> DataFrame:
    """Crash counts per hump street and crash date, with ``first_crash`` and ``after_humps``.

    A crash counts once per street row and hump line around it. Crashes at the same place and
    day are combined before they are joined to the streets; only streets with humps are searched.
    Attributes are the largest per street. Humps installed within a year of the first crash or
    of ``as_of`` are left out.
    """
    people = pedestrians_involved(
        F.col("number_of_pedestrians_injured"), F.col("number_of_pedestrians_killed")
    )
    walked = people > 0

    def summed(column: str):
        return F.sum(F.when(walked, F.coalesce(F.col(column), F.lit(0))).otherwise(0))

    places = crashes.groupBy("x", "y", "crash_date").agg(
        F.count("collision_id").alias("n"),
        F.count(F.when(walked, F.col("collision_id"))).alias("n_walked"),
        summed("number_of_pedestrians_injured").alias("injured"),
        summed("number_of_pedestrians_killed").alias("killed"),
    )
    places = settle(places, "places")
    roads = settle(hump_roads(streets, humps, radius), "hump-roads")
    found = settle(
        spatial_pairs(places, roads, radius, point_id=["x", "y", "crash_date"])
        .groupBy(*ROAD, "crash_date")
        .agg(*[F.sum(F.col(c) * F.col("hump_lines")).alias(c) for c in COUNTS]),
        "hump-crashes",
    )
    dated = replace_by_group_values(found, "physicalid", ROAD[1:]).withColumn(
        "first_crash", scalar_min(found, "crash_date")
    )
    kept = margin_window_filter(dated, "date_insta", first_event=F.col("first_crash"), as_of=as_of)
    return kept.withColumn("after_humps", F.col("date_insta") < F.col("crash_date"))


def _per_week(counts: DataFrame, columns: list[str], as_of: datetime) -> DataFrame:
    """Weekly rate over the time before or after the installation."""
    end = F.lit(as_of).cast("timestamp_ntz")
    weeks = F.when(F.col("after_humps"), weeks_between(F.col("date_insta"), end)).otherwise(
        weeks_between(F.col("first_crash"), F.col("date_insta"))
    )
    return counts.withColumns(
        {f"{c}_per_week": F.try_divide(F.col(c), weeks) for c in columns}
    ).drop("first_crash")


def crashes_per_road(found: DataFrame, *, as_of: datetime, pedestrians: bool = False) -> DataFrame:
    """Two rows per street, before and after the installation; 0 where nothing happened.

    ``pedestrians`` keeps crashes in which pedestrians were hurt and adds their numbers.
    """
    if pedestrians:
        rows = found.where(F.col("n_walked") > 0)
        measures = {
            "number_of_pedestrians_injured": F.sum("injured"),
            "number_of_pedestrians_killed": F.sum("killed"),
            "pedestrians_involved": F.sum(F.col("injured") + F.col("killed")),
            "collisions": F.sum("n_walked"),
        }
        rated = ["collisions", "pedestrians_involved"]
    else:
        rows, rated = found, ["collisions"]
        measures = {"collisions": F.sum("n")}
    counts = rows.groupBy(*ROAD, "after_humps").agg(
        F.max("first_crash").alias("first_crash"), *[m.alias(n) for n, m in measures.items()]
    )
    rates = _per_week(counts, rated, as_of)
    facts = rates.drop("humps", "shape_leng", "road_leng", "date_insta")
    filled = [*measures, *[f"{c}_per_week" for c in rated]]
    return densify(rates.select(*ROAD).distinct(), facts, ["physicalid"], "after_humps", filled)


def crashes_difference(per_road: DataFrame) -> DataFrame:
    """One row per street with the rates before and after."""
    rates = [c for c in per_road.columns if c.endswith("_per_week")]
    columns = ["physicalid", "humps", "shape_leng", *rates]
    return inner_join_suffixes(
        per_road.where(~F.col("after_humps")).select(*columns),
        per_road.where(F.col("after_humps")).select(*columns),
        ["physicalid", "humps", "shape_leng"],
    )


def hump_effect(difference: DataFrame, rate: str = "collisions_per_week") -> DataFrame:
    """Slope of the rate after on the rate before, with their correlation."""
    before, after = f"{rate}_before", f"{rate}_after"
    return difference.agg(
        F.count(F.lit(1)).alias("streets"),
        F.regr_slope(after, before).alias("slope"),
        F.regr_intercept(after, before).alias("intercept"),
        F.corr(before, after).alias("correlation"),
    )


def hump_effect_from_dataset(dataset: DataFrame, *, scale: float = 1000.0) -> DataFrame:
    """Per street the weekly rate per ``scale`` feet before and after, from the street table."""
    scaled = dataset.withColumn("rate", F.col("collision_rate_per_length") * F.lit(scale))
    return before_after_left_join(
        scaled, "physicalid", "has_humps", "rate",
        ("collisions_per_week_before", "collisions_per_week_after"), unique=True,
    )


