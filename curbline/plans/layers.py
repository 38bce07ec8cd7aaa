"""Reading the layers of a study: select, cast, de-duplicate, reduce lines to centroids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.functions.projection import GEOGRAPHIC_CRS, point_from_lat_long
from curbline.functions.transforms import parse_date_time
from curbline.operators.aggregates import dedupe_by_geometry
from curbline.operators.relational import cast_columns, drop_duplicates_first


def load_crash_points(
    raw: DataFrame,
    *,
    from_year: int = 2010,
    extra_columns: Sequence[str] = (),
    crs: str = GEOGRAPHIC_CRS,
) -> DataFrame:
    """Located crashes from ``from_year`` on: key, ``datetime``, extras and planar ``x``, ``y``.

    The year test reads the raw text (ISO dates sort as text), so it can reach the scan.
    """
    columns = ["collision_id", "crash_date", "crash_time", "latitude", "longitude"]
    columns += [c for c in extra_columns if c not in columns]
    recent = raw.select(*columns).where(F.col("crash_date") >= f"{from_year:04d}-01-01")
    located = point_from_lat_long(recent, crs=crs)
    moment = parse_date_time(F.col("crash_date"), F.col("crash_time"))
    return located.withColumn("datetime", moment).drop("crash_date", "crash_time")


def with_street_key(streets: DataFrame, name: str = "street") -> DataFrame:
    """Add a key of the street row. ``physicalid`` is not one: raw street tables repeat it for
    rows of different geometry."""
    return streets.withColumn(name, F.struct("physicalid", F.xxhash64("geometry").alias("shape")))


def load_street_lines(streets: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Streets proper (road type 1) with the wanted columns, one row per geometry."""
    wanted = list(dict.fromkeys([*columns, "physicalid", "geometry"]))
    proper = streets.where(F.col("rw_type") == "1").select(*wanted)
    return drop_duplicates_first(proper, ["geometry"], ["physicalid"])


def _centroids(lines: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    merged = dedupe_by_geometry(geo.drop_empty_geometry(lines), aggregates)
    centre = geo.centroid(F.col("geometry"))
    return merged.select(*aggregates, centre.alias("_c")).select(
        *aggregates, F.col("_c.x").alias("x"), F.col("_c.y").alias("y")
    )


def load_hump_centroids(humps: DataFrame) -> DataFrame:
    """Humps summed and earliest installation per geometry, at its centroid."""
    cast = cast_columns(
        humps.select("humps", "date_insta", "geometry"),
        {"humps": "double", "date_insta": "timestamp_ntz"},
    )
    return _centroids(cast, {"humps": "sum", "date_insta": "min"})


def load_limit_centroids(limits: DataFrame) -> DataFrame:
    """Mean limit per geometry, at its centroid."""
    cast = cast_columns(limits.select("postvz_sl", "geometry"), {"postvz_sl": "int"})
    return _centroids(cast, {"postvz_sl": "mean"})


def load_tree_points(trees: DataFrame) -> DataFrame:
    return trees.select("tree_id", "x", "y")
