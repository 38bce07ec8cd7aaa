"""Point features per street: weigh the features, find their streets, aggregate.

The order of work is chosen for large inputs. Features at the same place (and time) are first
combined into one row, with partial aggregation on the map side, so a place holding a large
share of the table becomes one row before anything is shuffled by grid cell. Street attributes
travel as grouping keys, so the join result is combined again before it is shuffled by street.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.operators.intersections import intersection_weights, within_disc
from curbline.operators.intervals import in_interval
from curbline.operators.spatial_join import spatial_pairs
from curbline.session import settle

METHODS = ("uniform", "weighted", "binary", "value")
OPERATIONS = ("sum", "max", "mean")


@dataclass(frozen=True)
class PointFeature:
    """What to compute for a street from a layer of points (columns ``x``, ``y``).

    ``method``: ``uniform`` counts, ``weighted`` uses the weight of the intersection around the
    point, ``binary`` drops points at intersections, ``value`` uses ``value_column``.
    ``split_by_date`` sets the weight to 0 outside the street row's validity interval.
    ``collapse=False`` skips the combining by place, for layers where places do not repeat;
    such a layer needs ``point_id``.
    """

    output: str
    points: DataFrame
    method: str = "uniform"
    operation: str = "sum"
    value_column: str | None = None
    date_column: str | None = None
    split_by_date: bool = False
    radius: float = 30.0
    intersections: DataFrame | None = None
    collapse: bool = True
    point_id: str | None = None

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"unknown method {self.method!r}, expected one of {METHODS}")
        if self.operation not in OPERATIONS:
            raise ValueError(f"unknown operation {self.operation!r}, expected one of {OPERATIONS}")
        if self.method == "value" and not isinstance(self.value_column, str):
            raise TypeError("method 'value' needs the name of a value column")
        if self.split_by_date and self.date_column is None:
            raise TypeError("split_by_date needs a date column")
        if not self.collapse and self.point_id is None:
            raise TypeError("collapse=False needs the key of the points")

    @property
    def fill(self) -> float | None:
        """Value of a street without any feature."""
        return 0.0 if self.operation == "sum" or self.split_by_date else None


def _places(feature: PointFeature) -> tuple[DataFrame, list[str]]:
    """(rows with n, n_val, total, top; their key): features combined per place and time."""
    keys = ["x", "y"]
    dated = feature.split_by_date
    time = [F.col(feature.date_column).alias("_t")] if dated else []
    weight = (
        F.col(feature.value_column).cast("double")
        if feature.method == "value"
        else F.lit(1.0)
    )
    if not feature.collapse:
        rows = feature.points.select(
            F.col(feature.point_id).alias("_id"), *keys, *time, weight.alias("total")
        ).withColumns(
            {
                "n": F.lit(1).cast("long"),
                "n_val": F.col("total").isNotNull().cast("long"),
                "top": F.col("total"),
            }
        )
        return rows, ["_id"]
    if dated:
        keys = [*keys, "_t"]
    rows = (
        feature.points.select("x", "y", *time, weight.alias("_w"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("_w").alias("n_val"),
            F.sum("_w").alias("total"),
            F.max("_w").alias("top"),
        )
    )
    # Stored, because both the count per cell and the join read it: the features are scanned once.
    return settle(rows, "places"), keys


def _weigh(feature: PointFeature, places: DataFrame, key: list[str], streets: DataFrame) -> DataFrame:
    """Multiply by the intersection weight: 1 away from intersections, else the weight of the
    intersection (``weighted``) or 0 (``binary``)."""
    if feature.method not in ("weighted", "binary"):
        return places
    discs = feature.intersections
    if discs is None:
        discs = intersection_weights(
            streets.select("physicalid", "geometry").dropDuplicates(["physicalid"]), feature.radius
        )
    spots = places.select(*dict.fromkeys([*key, "x", "y"]))
    inside = (
        within_disc(spots, discs.select("x", "y", "weight"), feature.radius, point_id=key)
        .groupBy(*key)
        .agg(F.min("weight").alias("_in"))
    )
    outside = F.col("_in").isNull()
    factor = F.when(outside, F.lit(1.0)).otherwise(
        F.col("_in") if feature.method == "weighted" else F.lit(0.0)
    )
    on = F.lit(True)
    other = inside.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_in")
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        places.join(other, on, "left")
        .withColumns({"total": F.col("total") * factor, "top": F.col("top") * factor})
        .drop("_in", *[f"_k{i}" for i in range(len(key))])
    )


def point_feature_values(
    feature: PointFeature, streets: DataFrame, keys: Sequence[str] = ("physicalid",)
) -> DataFrame:
    """``keys`` and the feature, only for streets with at least one feature in their buffer."""
    if feature.split_by_date and not {"after", "until"} <= set(streets.columns):
        raise TypeError("split_by_date needs streets with the columns after and until")
    places, place_key = _places(feature)
    places = _weigh(feature, places, place_key, streets)
    interval = [c for c in ("after", "until") if c in streets.columns and c not in keys]
    pairs = spatial_pairs(
        places, streets.select(*keys, *interval, "geometry"), feature.radius, point_id=place_key
    )
    total, valued, top = F.col("total"), F.col("n_val"), F.col("top")
    if feature.split_by_date:
        inside = in_interval(F.col("_t"))
        total = F.when(inside, total).otherwise(0.0)
        valued = F.when(inside, valued).otherwise(F.col("n"))
        top = F.when(inside, top).otherwise(0.0)
    value: Column = {
        "sum": lambda: F.coalesce(F.sum(total), F.lit(0.0)),
        "mean": lambda: F.try_divide(F.sum(total), F.sum(valued)),
        "max": lambda: F.max(top),
    }[feature.operation]()
    return pairs.groupBy(*keys).agg(value.alias(feature.output))


def point_feature_aggregate(
    feature: PointFeature, streets: DataFrame, keys: Sequence[str] = ("physicalid",)
) -> DataFrame:
    """``keys`` and the feature for every street, also those without features."""
    found = point_feature_values(feature, streets, keys)
    rows = streets.select(*keys).distinct().join(found, list(keys), "left")
    return rows if feature.fill is None else rows.fillna({feature.output: feature.fill})


def add_point_feature(streets: DataFrame, feature: PointFeature) -> DataFrame:
    """Street table with the feature attached by ``physicalid``."""
    return add_point_features(streets, [feature], ["physicalid"])


def add_point_features(
    streets: DataFrame, features: Sequence[PointFeature], keys: Sequence[str]
) -> DataFrame:
    """Attach several features. Every feature table is already partitioned by ``keys``, so the
    joins share one partitioning and only the streets are shuffled for them."""
    joined = streets
    for feature in features:
        found = point_feature_values(feature, streets, keys)
        joined = joined.join(found, list(keys), "left")
    zero = {f.output: f.fill for f in features if f.fill is not None}
    return joined.fillna(zero) if zero else joined
