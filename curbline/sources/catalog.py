"""The registered datasets: where they come from, their raw schema and their geometry."""

from __future__ import annotations

from dataclasses import dataclass

from curbline.functions.projection import GEOGRAPHIC_CRS, PLANAR_CRS

_GEOJSON = "struct<type:string,coordinates:string>"


@dataclass(frozen=True)
class Dataset:
    """``geometry_column`` is None for points given as ``latitude`` and ``longitude``.

    Raw scalars are text, as the public record service delivers them. GeoJSON coordinates are
    read as text too, because their nesting depends on the geometry type.
    """

    name: str
    resource: str
    schema: str
    geometry_column: str | None = None
    crs: str = GEOGRAPHIC_CRS
    points: bool = False
    format: str = "json"


def _text(*names: str) -> str:
    return ", ".join(f"{n} string" for n in names)


# The public identifiers of the seven datasets.
CATALOG: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            "crashes", "h9gi-nx95",
            _text("collision_id", "crash_date", "crash_time", "latitude", "longitude",
                  "number_of_pedestrians_injured", "number_of_pedestrians_killed"),
            points=True,
        ),
        Dataset(
            "centerline", "8rma-cm9c",
            f"the_geom {_GEOJSON}, " + _text("physicalid", "rw_type", "bike_lane", "trafdir", "st_width",
                                             "shape_leng", "post_type", "pre_type", "st_name"),
            geometry_column="the_geom",
        ),
        Dataset("speedlimits", "978y-cak4", f"the_geom {_GEOJSON}, " + _text("limit_id", "postvz_sl"),
                geometry_column="the_geom"),
        Dataset("speedhumps", "yjra-caqx",
                f"the_geom {_GEOJSON}, " + _text("hump_id", "humps", "date_insta", "shape_leng"),
                geometry_column="the_geom"),
        Dataset("trees", "5rq2-4hqu", f"the_geom {_GEOJSON}, " + _text("tree_id"),
                geometry_column="the_geom", points=True),
        Dataset("traffic_volumes", "7ym2-wayt", _text("wktgeom", "vol", "yr", "m", "d"),
                geometry_column="wktgeom", crs=PLANAR_CRS, points=True),
        Dataset("parking_meters", "693u-uax6", f"location {_GEOJSON}, " + _text("meter_id"),
                geometry_column="location", points=True),
    )
}


def dataset(name: str) -> Dataset:
    if name not in CATALOG:
        raise KeyError(f"unknown dataset {name!r}, expected one of {sorted(CATALOG)}")
    return CATALOG[name]
