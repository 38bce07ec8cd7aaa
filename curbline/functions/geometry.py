"""Geometry as native columns.

A line layer has a column ``geometry`` of type ``array<array<struct<x,y>>>``: parts, each
a list of vertices. A point layer has two double columns ``x`` and ``y``. Buffers are never
built: an operator keeps the core geometry and tests distances against the radius.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOMETRY_TYPE = "array<array<struct<x:double,y:double>>>"


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def straight_line(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A line of one part with two vertices."""
    return F.array(F.array(vertex(x0, y0), vertex(x1, y1)))


def point_geometry(x: Column, y: Column) -> Column:
    """A point in the shape of a line geometry: one part, one vertex."""
    return F.array(F.array(vertex(x, y)))


def geometry_from_wkt(wkt: Column) -> Column:
    """Decode POINT, LINESTRING and MULTILINESTRING text; EMPTY gives no parts."""
    body = F.regexp_extract(wkt, r"\((.*)\)", 1)
    inner = F.regexp_replace(body, r"^[\s(]+|[\s)]+$", "")
    parts = F.transform(
        F.split(inner, r"\)\s*,\s*\("),
        lambda part: F.transform(F.split(part, ","), _wkt_vertex),
    )
    return (
        F.when(wkt.isNull(), F.lit(None))
        .when(inner == "", F.array())
        .otherwise(parts)
        .cast(GEOMETRY_TYPE)
    )


def _wkt_vertex(text: Column) -> Column:
    ordinates = F.split(F.trim(text), r"\s+")
    return vertex(ordinates[0], ordinates[1])


def geometry_to_wkt(geometry: Column) -> Column:
    """Text form for files: MULTILINESTRING, or POINT for a single vertex."""

    def vertices(part: Column) -> Column:
        return F.array_join(
            F.transform(part, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))),
            ", ",
        )

    body = F.array_join(
        F.transform(geometry, lambda part: F.concat(F.lit("("), vertices(part), F.lit(")"))), ", "
    )
    single = (F.size(geometry) == 1) & (F.size(F.flatten(geometry)) == 1)
    return (
        F.when(geometry.isNull(), F.lit(None))
        .when(F.size(geometry) == 0, "MULTILINESTRING EMPTY")
        .when(single, F.concat(F.lit("POINT "), body))
        .otherwise(F.concat(F.lit("MULTILINESTRING ("), body, F.lit(")")))
    )


def geometry_from_geojson(record: Column, *, is_text: bool = True) -> Column:
    """Decode a Point, LineString or MultiLineString record.

    ``record`` is GeoJSON text, or (``is_text=False``) a struct with the fields ``type`` and
    ``coordinates`` where the coordinates were read as a string.
    """
    if is_text:
        kind = F.get_json_object(record, "$.type")
        coordinates = F.get_json_object(record, "$.coordinates")
    else:
        kind, coordinates = record["type"], record["coordinates"]

    def line(vertices: Column) -> Column:
        return F.transform(vertices, lambda v: vertex(v[0], v[1]))

    point = F.from_json(coordinates, "array<double>")
    single = F.from_json(coordinates, "array<array<double>>")
    multi = F.from_json(coordinates, "array<array<array<double>>>")
    return (
        F.when(kind == "Point", point_geometry(point[0], point[1]))
        .when(kind == "LineString", F.array(line(single)))
        .when(kind == "MultiLineString", F.transform(multi, line))
        .cast(GEOMETRY_TYPE)
    )


def first_vertex(geometry: Column) -> Column:
    return geometry[0][0]


def is_empty(geometry: Column) -> Column:
    return F.size(F.flatten(geometry)) == 0


def segments(geometry: Column) -> Column:
    """All straight segments as ``array<struct<part,pos,x0,y0,x1,y1>>``. A part of one vertex is a
    segment of length zero, so that points take part in joins as lines do."""
    return F.flatten(
        F.transform(
            geometry,
            lambda part, i: F.transform(
                F.slice(part, F.lit(1), F.greatest(F.size(part) - 1, F.lit(1))),
                lambda v, j: F.struct(
                    i.alias("part"),
                    j.alias("pos"),
                    v["x"].alias("x0"),
                    v["y"].alias("y0"),
                    F.coalesce(F.get(part, j + 1)["x"], v["x"]).alias("x1"),
                    F.coalesce(F.get(part, j + 1)["y"], v["y"]).alias("y1"),
                ),
            ),
        )
    )


def explode_segments(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row per straight segment; the other columns of ``df`` are repeated."""
    kept = [c for c in df.columns if c != geometry]
    return df.select(*kept, F.explode(segments(F.col(geometry))).alias("_s")).select(
        *kept, "_s.*"
    )


def geometry_segments(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``explode_segments`` with the bounding box of every segment."""
    return (
        explode_segments(df, geometry)
        .withColumn("xmin", F.least("x0", "x1"))
        .withColumn("ymin", F.least("y0", "y1"))
        .withColumn("xmax", F.greatest("x0", "x1"))
        .withColumn("ymax", F.greatest("y0", "y1"))
    )


def centroid(geometry: Column) -> Column:
    """Length-weighted mean of the segment midpoints, as ``struct<x,y>``.

    A geometry without length (a point, a collapsed line) has its mean vertex as centroid.
    """

    def total(items: Column, value) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda acc, s: acc + value(s))

    def length(s: Column) -> Column:
        return F.sqrt(
            (s["x1"] - s["x0"]) * (s["x1"] - s["x0"])
            + (s["y1"] - s["y0"]) * (s["y1"] - s["y0"])
        )

    pieces, vertices = segments(geometry), F.flatten(geometry)
    weight = total(pieces, length)

    def coordinate(axis: str) -> Column:
        along = total(pieces, lambda s: length(s) * (s[f"{axis}0"] + s[f"{axis}1"]) / 2)
        mean = F.try_divide(total(vertices, lambda v: v[axis]), F.size(vertices))
        return F.coalesce(F.try_divide(along, weight), mean)

    return F.struct(coordinate("x").alias("x"), coordinate("y").alias("y"))


def boundary_points(geometry: Column) -> Column:
    """End points of a line by the mod-2 rule: an end shared by an even number of part
    ends (a closed ring, two parts meeting) is not part of the boundary."""
    ends = F.flatten(
        F.transform(
            F.filter(geometry, lambda part: F.size(part) > 1),
            lambda part: F.array(part[0], F.element_at(part, -1)),
        )
    )
    return F.filter(
        F.array_distinct(ends),
        lambda end: F.size(F.filter(ends, lambda other: other == end)) % 2 == 1,
    )


def distance_squared(x: str, y: str) -> Column:
    """Squared distance of the point in columns ``x``, ``y`` from the segment in the columns
    x0, y0, x1, y1.

    The foot of the perpendicular decides between the two ends and the line itself; a
    collapsed segment falls into the first case.
    """
    along = f"(({x} - x0) * (x1 - x0) + ({y} - y0) * (y1 - y0))"
    across = f"(({y} - y0) * (x1 - x0) - ({x} - x0) * (y1 - y0))"
    length2 = "((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))"
    return F.expr(
        f"case when {along} <= 0 then ({x} - x0) * ({x} - x0) + ({y} - y0) * ({y} - y0) "
        f"when {along} >= {length2} then ({x} - x1) * ({x} - x1) + ({y} - y1) * ({y} - y1) "
        f"else {across} * {across} / {length2} end"
    )


def drop_missing_geometry(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.where(F.col(geometry).isNotNull())


def drop_empty_geometry(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.where(~is_empty(F.col(geometry)))


def swap_active_geometry(
    df: DataFrame, new: str, *, keep_as: str, active: str = "geometry"
) -> DataFrame:
    """Make column ``new`` the active geometry and keep the former one as ``keep_as``."""
    return df.withColumnsRenamed({active: keep_as, new: active})
