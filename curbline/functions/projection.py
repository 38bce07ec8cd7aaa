"""Longitude/latitude (EPSG:4326) to planar feet (EPSG:2263).

Lambert conformal conic with two standard parallels, Snyder, USGS Professional Paper 1395,
equations 15-1 to 15-10, on the GRS80 ellipsoid; WGS84 and NAD83 are taken as equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOGRAPHIC_CRS = "EPSG:4326"
PLANAR_CRS = "EPSG:2263"

# Fixed values of the projection.
SEMI_MAJOR_AXIS = 6378137.0
INVERSE_FLATTENING = 298.257222101
STANDARD_PARALLELS = (40 + 40 / 60, 41 + 2 / 60)
ORIGIN_LATITUDE = 40 + 10 / 60
ORIGIN_LONGITUDE = -74.0
FALSE_EASTING_M = 300000.0
FEET_PER_METRE = 3937 / 1200


def _cone() -> tuple[float, float, float, float]:
    flattening = 1 / INVERSE_FLATTENING
    e = math.sqrt(flattening * (2 - flattening))

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi: float) -> float:
        s = e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    p1, p2 = (math.radians(p) for p in STANDARD_PARALLELS)
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    scale = SEMI_MAJOR_AXIS * m(p1) / (n * t(p1) ** n)
    return e, n, scale, scale * t(math.radians(ORIGIN_LATITUDE)) ** n


ECCENTRICITY, CONE_CONSTANT, SCALE, ORIGIN_RADIUS = _cone()


def project(longitude: Column, latitude: Column) -> tuple[Column, Column]:
    """Planar x and y in feet."""
    phi = F.radians(latitude)
    s = F.lit(ECCENTRICITY) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(ECCENTRICITY / 2))
    rho = F.lit(SCALE) * F.pow(t, F.lit(CONE_CONSTANT))
    theta = F.lit(CONE_CONSTANT) * F.radians(longitude - F.lit(ORIGIN_LONGITUDE))
    x = (F.lit(FALSE_EASTING_M) + rho * F.sin(theta)) * F.lit(FEET_PER_METRE)
    y = (F.lit(ORIGIN_RADIUS) - rho * F.cos(theta)) * F.lit(FEET_PER_METRE)
    return x, y


def project_geometry(geometry: Column) -> Column:
    """Project every vertex of a longitude/latitude geometry."""

    def planar(v: Column) -> Column:
        x, y = project(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(geometry, lambda part: F.transform(part, planar))


def point_from_lat_long(
    df: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    *,
    crs: str = GEOGRAPHIC_CRS,
) -> DataFrame:
    """Planar point columns ``x``, ``y`` in place of the two coordinate columns.

    Rows without a coordinate are dropped first, so the projection never sees them.
    """
    located = df.dropna(subset=[latitude, longitude])
    lon, lat = F.col(longitude).cast("double"), F.col(latitude).cast("double")
    x, y = project(lon, lat) if crs == GEOGRAPHIC_CRS else (lon, lat)
    return located.withColumns({"x": x, "y": y}).drop(latitude, longitude)
