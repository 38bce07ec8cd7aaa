"""Geometry columns and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.registry import query
from curbline.functions import geometry as geo
from curbline.functions import projection
from curbline.operators import intersections, nearest, relational, spatial_join
from curbline.operators.aggregates import two_level_average

RADIUS = 30.0


def streets(spark, sf_dir):
    return relational.street_filter(fx.all_streets(spark, sf_dir))


def street_lines(spark, sf_dir):
    return streets(spark, sf_dir).select("physicalid", "geometry")


def sql_near(points: str, lines: str, limit: float, op: str = "<") -> str:
    """Brute-force pairs: every point against every line."""
    return (
        f"SELECT p.*, s.* EXCLUDE (x0, y0, x1, y1), sqrt({fx.sql_distance_squared('p', 's')}) AS distance "
        f"FROM {points} p JOIN {lines} s ON {fx.sql_distance_squared('p', 's')} {op} {limit * limit}"
    )


def sql_contained(inner: str, inner_id: str, outer: str, outer_id: str, radius: float) -> str:
    """Single segments: the buffer of a segment is convex, so both ends inside is enough."""
    r2 = f"pow({radius} + {spatial_join.TOLERANCE}, 2)"
    start = fx.sql_distance_squared("a", "s")
    end = fx.sql_distance_squared("b", "s")
    return (
        f"SELECT a.{inner_id}, s.{outer_id} "
        f"FROM (SELECT {inner_id}, x0 AS x, y0 AS y FROM {inner}) a "
        f"JOIN {outer} s ON {start} <= {r2} "
        f"JOIN (SELECT {inner_id}, x1 AS x, y1 AS y FROM {inner}) b "
        f"ON a.{inner_id} = b.{inner_id} AND {end} <= {r2}"
    )


def _projection_sql(lon: str, lat: str) -> str:
    e, n = projection.ECCENTRICITY, projection.CONE_CONSTANT
    s = f"(CAST({e!r} AS DOUBLE) * sin(radians({lat})))"
    t = f"(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {s}) / (1 + {s}), CAST({e / 2!r} AS DOUBLE)))"
    rho = f"(CAST({projection.SCALE!r} AS DOUBLE) * pow({t}, CAST({n!r} AS DOUBLE)))"
    theta = f"(CAST({n!r} AS DOUBLE) * radians({lon} + 74))"
    feet = f"CAST({projection.FEET_PER_METRE!r} AS DOUBLE)"
    return (
        f"round((300000 + {rho} * sin({theta})) * {feet}, 3) AS x, "
        f"round((CAST({projection.ORIGIN_RADIUS!r} AS DOUBLE) - {rho} * cos({theta})) * {feet}, 3) AS y"
    )


@query("point_from_lat_long", fx.with_layers(
    "raw_crashes",
    f"SELECT collision_id, {_projection_sql('longitude', 'latitude')} FROM raw_crashes "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))
def _(spark, sf_dir):
    raw = fx.raw_crashes(spark, sf_dir).select("collision_id", "latitude", "longitude")
    return projection.point_from_lat_long(raw).select(
        "collision_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")
    )


_LON = "CAST(-74.25 AS DOUBLE) + CAST(event_id * 6151 % 5503 AS DOUBLE) / 10000"
_LAT = "CAST(40.5 AS DOUBLE) + CAST(event_id * 7919 % 4001 AS DOUBLE) / 10000"


@query("reproject_4326_to_2263", f"SELECT event_id, {_projection_sql(f'({_LON})', f'({_LAT})')} FROM events")
def _(spark, sf_dir):
    k = F.col("event_id")
    lon = F.lit(-74.25) + ((k * 6151) % 5503) / F.lit(10000.0)
    lat = F.lit(40.5) + ((k * 7919) % 4001) / F.lit(10000.0)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", geo.point_geometry(lon, lat).alias("geometry")
    )
    planar = geo.first_vertex(projection.project_geometry(F.col("geometry")))
    return events.select(
        "event_id", F.round(planar["x"], 3).alias("x"), F.round(planar["y"], 3).alias("y")
    )


def _ends(df, key="physicalid"):
    first = F.col("geometry")[0][0]
    last = F.element_at(F.element_at("geometry", -1), -1)
    return df.select(
        key, first["x"].alias("x0"), first["y"].alias("y0"), last["x"].alias("x1"), last["y"].alias("y1")
    )


_ENDS_SQL = fx.with_layers("all_streets", "SELECT physicalid, x0, y0, x1, y1 FROM all_streets")


def _text(template: str):
    first, last = F.col("geometry")[0][0], F.col("geometry")[0][1]
    return F.format_string(template, first["x"], first["y"], last["x"], last["y"])


@query("geometry_from_wkt", _ENDS_SQL)
def _(spark, sf_dir):
    multi = _text("MULTILINESTRING ((%.3f %.3f, %.3f %.3f))")
    line = _text("LINESTRING (%.3f %.3f, %.3f %.3f)")
    text = fx.all_streets(spark, sf_dir).select(
        "physicalid", F.when(F.col("physicalid") % 2 == 0, multi).otherwise(line).alias("wkt")
    )
    return _ends(text.select("physicalid", geo.geometry_from_wkt(F.col("wkt")).alias("geometry")))


@query("geometry_from_geojson", _ENDS_SQL)
def _(spark, sf_dir):
    multi = _text('{"type": "MultiLineString", "coordinates": [[[%.3f, %.3f], [%.3f, %.3f]]]}')
    line = _text('{"type": "LineString", "coordinates": [[%.3f, %.3f], [%.3f, %.3f]]}')
    text = fx.all_streets(spark, sf_dir).select(
        "physicalid", F.when(F.col("physicalid") % 2 == 0, multi).otherwise(line).alias("record")
    )
    return _ends(text.select("physicalid", geo.geometry_from_geojson(F.col("record")).alias("geometry")))


@query("drop_missing_geometry", fx.with_layers(
    "all_streets", "SELECT physicalid FROM all_streets WHERE st_width IS NOT NULL"))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).withColumn(
        "geometry", F.when(F.col("st_width").isNotNull(), F.col("geometry"))
    )
    return geo.drop_missing_geometry(rows).select("physicalid")


@query("drop_empty_geometry", fx.with_layers(
    "all_streets", "SELECT physicalid FROM all_streets WHERE post_type IS NOT NULL"))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).withColumn(
        "geometry",
        F.when(F.col("post_type").isNotNull(), F.col("geometry")).otherwise(F.array().cast(geo.GEOMETRY_TYPE)),
    )
    return geo.drop_empty_geometry(rows).select("physicalid")


def bent_streets(spark, sf_dir):
    """Streets as two parts meeting in a corner."""
    a, b = F.col("geometry")[0][0], F.col("geometry")[0][1]
    corner = geo.vertex(b["x"], a["y"])
    return fx.all_streets(spark, sf_dir).select(
        "physicalid", F.array(F.array(a, corner), F.array(corner, b)).alias("geometry")
    )


@query("centroid", fx.with_layers("all_streets", """
    SELECT physicalid,
           round(coalesce((w * (x0 + x1) / 2 + h * x1) / nullif(w + h, 0), x0), 6) AS x,
           round(coalesce((w * y0 + h * (y0 + y1) / 2) / nullif(w + h, 0), y0), 6) AS y
    FROM (SELECT *, abs(x1 - x0) AS w, abs(y1 - y0) AS h FROM all_streets)"""))
def _(spark, sf_dir):
    rows = bent_streets(spark, sf_dir).select("physicalid", geo.centroid(F.col("geometry")).alias("c"))
    return rows.select("physicalid", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


@query("boundary_points", fx.with_layers("all_streets", """
    SELECT physicalid, x, y FROM (
        SELECT physicalid, x0 AS x, y0 AS y FROM all_streets
        UNION ALL SELECT physicalid, x1, y0 FROM all_streets
        UNION ALL SELECT physicalid, x1, y0 FROM all_streets
        UNION ALL SELECT physicalid, x1, y1 FROM all_streets)
    GROUP BY physicalid, x, y HAVING count(*) % 2 = 1"""))
def _(spark, sf_dir):
    return bent_streets(spark, sf_dir).select(
        "physicalid", F.inline(geo.boundary_points(F.col("geometry")))
    )


@query("geometry_segments", fx.with_layers("all_streets", """
    SELECT physicalid, part, CAST(0 AS INTEGER) AS pos, x0, y0, x1, y1, least(x0, x1) AS xmin,
           least(y0, y1) AS ymin, greatest(x0, x1) AS xmax, greatest(y0, y1) AS ymax
    FROM (SELECT physicalid, CAST(0 AS INTEGER) AS part, x0, y0, x1, y0 AS y1 FROM all_streets
          UNION ALL SELECT physicalid, CAST(1 AS INTEGER), x1, y0, x1, y1 FROM all_streets)"""))
def _(spark, sf_dir):
    return geo.geometry_segments(bent_streets(spark, sf_dir))


@query("swap_active_geometry", fx.with_layers("speedhumps", """
    SELECT hump_id, round((x0 + x1) / 2, 6) + 0 AS active_x, round(x0, 6) + 0 AS kept_x FROM speedhumps"""))
def _(spark, sf_dir):
    humps = fx.speedhumps(spark, sf_dir)
    centre = geo.centroid(F.col("geometry"))
    humps = humps.withColumn("centre", geo.point_geometry(centre["x"], centre["y"]))
    swapped = geo.swap_active_geometry(humps, "centre", keep_as="road_geom")
    return swapped.select(
        "hump_id",
        F.round(geo.first_vertex(F.col("geometry"))["x"], 6).alias("active_x"),
        F.round(geo.first_vertex(F.col("road_geom"))["x"], 6).alias("kept_x"),
    )


_ENDS_CTE = (
    "SELECT DISTINCT x, y FROM (SELECT physicalid, x, y FROM ("
    "SELECT physicalid, x0 AS x, y0 AS y FROM streets UNION ALL SELECT physicalid, x1, y1 FROM streets) "
    "GROUP BY physicalid, x, y HAVING count(*) % 2 = 1)"
)
_DISCS_CTE = "SELECT x AS x0, y AS y0, x AS x1, y AS y1, x AS disc_x, y AS disc_y FROM ends"


@query("buffer", fx.with_layers(
    "streets crashes",
    "SELECT collision_id, disc_x, disc_y, round(distance, 6) AS distance FROM pairs",
    ends=_ENDS_CTE, discs=_DISCS_CTE, pairs=sql_near("crashes", "discs", RADIUS)))
def _(spark, sf_dir):
    ends = intersections.street_ends(streets(spark, sf_dir)).withColumns(
        {"disc_x": F.col("x"), "disc_y": F.col("y")}
    )
    points = fx.crashes(spark, sf_dir).select("collision_id", "x", "y")
    return intersections.within_disc(points, ends, RADIUS, point_id="collision_id").select(
        "collision_id", "disc_x", "disc_y", F.round("distance", 6).alias("distance")
    )


_TREE_PAIRS = sql_near("trees", "streets", RADIUS)


def _tree_join(how):
    def run(spark, sf_dir):
        pairs = spatial_join.point_within_buffer_join(
            fx.trees(spark, sf_dir), street_lines(spark, sf_dir), RADIUS,
            point_id="tree_id", line_id="physicalid", how=how,
        )
        return pairs.select("physicalid", "tree_id", F.round("distance", 6).alias("distance"))

    return run


query("point_within_buffer_join", fx.with_layers(
    "streets trees",
    "SELECT s.physicalid, p.tree_id, round(p.distance, 6) AS distance FROM streets s "
    "LEFT JOIN pairs p ON s.physicalid = p.physicalid",
    pairs=_TREE_PAIRS))(_tree_join("right"))
query("point_within_buffer_join_left", fx.with_layers(
    "streets trees",
    "SELECT p.physicalid, t.tree_id, round(p.distance, 6) AS distance FROM trees t "
    "LEFT JOIN pairs p ON t.tree_id = p.tree_id",
    pairs=_TREE_PAIRS))(_tree_join("left"))
query("point_within_buffer_join_inner", fx.with_layers(
    "streets trees", "SELECT physicalid, tree_id, round(distance, 6) AS distance FROM pairs",
    pairs=_TREE_PAIRS))(_tree_join("inner"))


@query("point_intersects_buffer_join", fx.with_layers(
    "streets crashes",
    "SELECT s.physicalid, p.collision_id, round(p.distance, 6) AS distance FROM streets s "
    "LEFT JOIN pairs p ON s.physicalid = p.physicalid",
    pairs=sql_near("crashes", "streets", 32.0, "<=")))
def _(spark, sf_dir):
    pairs = spatial_join.point_intersects_buffer_join(
        fx.crashes(spark, sf_dir).select("collision_id", "x", "y"), street_lines(spark, sf_dir), 32.0,
        point_id="collision_id", line_id="physicalid",
    )
    return pairs.select("physicalid", "collision_id", F.round("distance", 6).alias("distance"))


@query("line_within_buffer_join", fx.with_layers(
    "streets speedhumps",
    "SELECT s.physicalid, c.hump_id, h.date_insta FROM streets s "
    "LEFT JOIN contained c ON s.physicalid = c.physicalid LEFT JOIN speedhumps h ON c.hump_id = h.hump_id",
    contained=sql_contained("streets", "physicalid", "speedhumps", "hump_id", RADIUS)))
def _(spark, sf_dir):
    humps = fx.speedhumps(spark, sf_dir).select("hump_id", "date_insta", "geometry")
    return spatial_join.line_within_buffer_join(
        street_lines(spark, sf_dir), humps, RADIUS, inner_id="physicalid", outer_id="hump_id", how="left"
    ).select("physicalid", "hump_id", "date_insta")


@query("line_within_buffer_join_right", fx.with_layers(
    "streets speedlimits",
    "SELECT s.physicalid, c.limit_id, l.postvz_sl FROM streets s "
    "LEFT JOIN contained c ON s.physicalid = c.physicalid LEFT JOIN speedlimits l ON c.limit_id = l.limit_id",
    contained=sql_contained("speedlimits", "limit_id", "streets", "physicalid", RADIUS)))
def _(spark, sf_dir):
    limits = fx.speedlimits(spark, sf_dir)
    return spatial_join.line_within_buffer_join(
        limits, street_lines(spark, sf_dir), RADIUS, inner_id="limit_id", outer_id="physicalid", how="right"
    ).select("physicalid", "limit_id", "postvz_sl")


SITES_SQL = (
    "SELECT site_id, x, y, avg(vol) AS vol FROM (SELECT site_id, x, y, yr, m, d, sum(vol) AS vol "
    "FROM traffic_volumes GROUP BY ALL) GROUP BY ALL"
)


@query("nearest_join", fx.with_layers(
    "streets traffic_volumes",
    "SELECT physicalid, site_id, round(vol, 6) AS vol, round(distance, 6) AS distance FROM ranked WHERE n = 1",
    sites=SITES_SQL,
    measured=f"SELECT s.physicalid, p.site_id, p.vol, greatest(0, sqrt({fx.sql_distance_squared('p', 's')}) - 25) "
             "AS distance FROM streets s CROSS JOIN sites p",
    ranked="SELECT *, row_number() OVER (PARTITION BY physicalid ORDER BY distance, site_id) AS n FROM measured"))
def _(spark, sf_dir):
    sites = two_level_average(
        fx.traffic_volumes(spark, sf_dir), ["site_id", "x", "y"], ["yr", "m", "d"], "vol"
    )
    found = nearest.nearest_join(
        street_lines(spark, sf_dir), sites, line_id="physicalid", site_id="site_id", buffer=25.0
    )
    return found.select(
        "physicalid", "site_id", F.round("vol", 6).alias("vol"), F.round("distance", 6).alias("distance")
    )


# Components by transitive closure over all pairs of ends nearer than two radii.
COMPONENT_CTES = {
    "ends": _ENDS_CTE,
    "nodes": "SELECT row_number() OVER (ORDER BY x, y) AS node, x, y FROM ends",
    "links": f"SELECT a.node AS a, b.node AS b FROM nodes a JOIN nodes b ON "
             f"(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < {4 * RADIUS * RADIUS}",
    "reached": "SELECT node AS a, node AS b FROM nodes UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a",
    "components": "SELECT a AS node, min(b) AS root FROM reached GROUP BY a",
    "labelled": "SELECT n.x, n.y, n.node, c.root FROM nodes n JOIN components c ON n.node = c.node",
    "touching": f"SELECT DISTINCT p.root, s.physicalid FROM labelled p JOIN streets s "
                f"ON {fx.sql_distance_squared('p', 's')} <= {RADIUS * RADIUS}",
    "sizes": "SELECT root, count(*) AS streets FROM touching GROUP BY root",
}


@query("intersection_components", fx.with_layers(
    "streets",
    "SELECT l.x, l.y, r.x AS root_x, r.y AS root_y FROM labelled l JOIN nodes r ON l.root = r.node",
    **{k: v for k, v in COMPONENT_CTES.items() if k not in ("touching", "sizes")}))
def _(spark, sf_dir):
    labelled = intersections.intersection_components(streets(spark, sf_dir), RADIUS)
    roots = labelled.groupBy("component").agg(F.min(F.struct("x", "y")).alias("root"))
    return labelled.join(roots, "component").select(
        "x", "y", F.col("root.x").alias("root_x"), F.col("root.y").alias("root_y")
    )


@query("intersection_weights", fx.with_layers(
    "streets",
    "SELECT l.x, l.y, s.streets, round(1.0 / s.streets, 6) AS weight FROM labelled l JOIN sizes s ON l.root = s.root",
    **COMPONENT_CTES))
def _(spark, sf_dir):
    weights = intersections.intersection_weights(streets(spark, sf_dir), RADIUS)
    return weights.select("x", "y", "streets", F.round("weight", 6).alias("weight"))


@query("intersection_split", fx.with_layers(
    "streets crashes",
    "SELECT collision_id, collision_id IN (SELECT collision_id FROM pairs) AS at_intersection FROM crashes",
    ends=_ENDS_CTE, discs=_DISCS_CTE, pairs=sql_near("crashes", "discs", RADIUS)))
def _(spark, sf_dir):
    points = fx.crashes(spark, sf_dir).select("collision_id", "x", "y")
    inside, outside = intersections.intersection_split(
        points, streets(spark, sf_dir), RADIUS, point_id="collision_id"
    )
    return inside.select("collision_id", F.lit(True).alias("at_intersection")).unionByName(
        outside.select("collision_id", F.lit(False).alias("at_intersection"))
    )


_LIMIT_POINTS = "SELECT limit_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, postvz_sl FROM speedlimits"


@query("spatial_join_aggregate", fx.with_layers(
    "streets speedlimits",
    "SELECT s.physicalid, s.st_name, round(avg(p.postvz_sl), 6) AS postvz_sl, count(p.limit_id) AS limit_id "
    "FROM streets s LEFT JOIN pairs p ON s.physicalid = p.physicalid GROUP BY s.physicalid, s.st_name",
    points=_LIMIT_POINTS, pairs=sql_near("points", "streets", 32.0, "<=")))
def _(spark, sf_dir):
    joined = spatial_join.spatial_join_aggregate(
        streets(spark, sf_dir), limit_points(spark, sf_dir), 32.0, {"postvz_sl": "mean", "limit_id": "count"},
        street_id="physicalid", point_id="limit_id",
    )
    return joined.select("physicalid", "st_name", F.round("postvz_sl", 6).alias("postvz_sl"), "limit_id")


def limit_points(spark, sf_dir):
    limits = fx.speedlimits(spark, sf_dir)
    return limits.select("limit_id", "postvz_sl", F.inline(F.array(geo.centroid(F.col("geometry")))))


# --- lines of many segments and parts, a crowded cell and a hot site

@query("boundary_points_of_paths", fx.with_layers("path_ends", "SELECT physicalid, x, y FROM path_ends"))
def _(spark, sf_dir):
    return fx.paths(spark, sf_dir).select("physicalid", F.inline(geo.boundary_points(F.col("geometry"))))


@query("centroid_of_paths", fx.with_layers("path_vertices path_segments", """
    SELECT v.physicalid, round(coalesce(s.x, v.x), 6) AS x, round(coalesce(s.y, v.y), 6) AS y
    FROM (SELECT physicalid, avg(x) AS x, avg(y) AS y FROM path_vertices GROUP BY 1) v
    LEFT JOIN (SELECT physicalid, sum(l * (x0 + x1) / 2) / nullif(sum(l), 0) AS x, sum(l * (y0 + y1) / 2) / nullif(sum(l), 0) AS y
               FROM (SELECT *, sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2)) AS l FROM path_segments) GROUP BY 1) s
      ON s.physicalid = v.physicalid"""))
def _(spark, sf_dir):
    rows = fx.paths(spark, sf_dir).select("physicalid", geo.centroid(F.col("geometry")).alias("c"))
    return rows.select("physicalid", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


_CROWD_PAIRS = (
    f"SELECT p.point_id, s.physicalid, sqrt(min({fx.sql_distance_squared('p', 's')})) AS distance FROM crowd p JOIN path_segments s "
    f"ON {fx.sql_distance_squared('p', 's')} < {RADIUS * RADIUS} GROUP BY 1, 2"
)


def _crowd_join(how):
    def run(spark, sf_dir):
        pairs = spatial_join.point_within_buffer_join(
            fx.crowd(spark, sf_dir), fx.paths(spark, sf_dir), RADIUS, point_id="point_id", line_id="physicalid", how=how)
        return pairs.select("point_id", "physicalid", F.round("distance", 6).alias("distance"))

    return run


query("point_within_buffer_of_paths_left", fx.with_layers(
    "crowd path_segments",
    "SELECT c.point_id, p.physicalid, round(p.distance, 6) AS distance FROM crowd c LEFT JOIN pairs p ON c.point_id = p.point_id",
    pairs=_CROWD_PAIRS))(_crowd_join("left"))
query("point_within_buffer_of_paths_right", fx.with_layers(
    "crowd path_segments",
    "SELECT p.point_id, s.physicalid, round(p.distance, 6) AS distance FROM (SELECT DISTINCT physicalid FROM path_vertices) s "
    "LEFT JOIN pairs p ON s.physicalid = p.physicalid",
    pairs=_CROWD_PAIRS))(_crowd_join("right"))


@query("nearest_join_of_paths", fx.with_layers(
    "path_segments traffic_volumes",
    "SELECT physicalid, site_id, round(distance, 6) AS distance FROM ranked WHERE n = 1",
    sites=SITES_SQL,
    measured=f"SELECT s.physicalid, p.site_id, greatest(0, sqrt(min({fx.sql_distance_squared('p', 's')})) - 25) AS distance "
             "FROM path_segments s CROSS JOIN sites p GROUP BY 1, 2",
    ranked="SELECT *, row_number() OVER (PARTITION BY physicalid ORDER BY distance, site_id) AS n FROM measured"))
def _(spark, sf_dir):
    sites = two_level_average(fx.traffic_volumes(spark, sf_dir), ["site_id", "x", "y"], ["yr", "m", "d"], "vol")
    found = nearest.nearest_join(
        fx.paths(spark, sf_dir), sites, line_id="physicalid", site_id="site_id", buffer=25.0
    )
    return found.select("physicalid", "site_id", F.round("distance", 6).alias("distance"))


@query("intersection_components_of_paths", fx.with_layers(
    "path_ends",
    "SELECT l.x, l.y, r.x AS root_x, r.y AS root_y FROM labelled l JOIN nodes r ON l.root = r.node",
    ends="SELECT DISTINCT x, y FROM path_ends",
    **{k: v for k, v in COMPONENT_CTES.items() if k not in ("ends", "touching", "sizes")}))
def _(spark, sf_dir):
    labelled = intersections.intersection_components(fx.paths(spark, sf_dir), RADIUS)
    roots = labelled.groupBy("component").agg(F.min(F.struct("x", "y")).alias("root"))
    return labelled.join(roots, "component").select(
        "x", "y", F.col("root.x").alias("root_x"), F.col("root.y").alias("root_y")
    )


@query("spatial_join_aggregate_of_paths", fx.with_layers(
    "crowd path_segments",
    "SELECT s.physicalid, count(p.point_id) AS point_id FROM (SELECT DISTINCT physicalid FROM path_vertices) s "
    "LEFT JOIN pairs p ON s.physicalid = p.physicalid GROUP BY 1",
    pairs=_CROWD_PAIRS.replace(" < ", " <= ")))
def _(spark, sf_dir):
    return spatial_join.spatial_join_aggregate(
        fx.paths(spark, sf_dir), fx.crowd(spark, sf_dir), RADIUS, {"point_id": "count"}, street_id="physicalid", point_id="point_id",
    ).select("physicalid", "point_id")


@query("line_within_buffer_of_paths", fx.with_layers(
    "path_vertices", "SELECT DISTINCT physicalid AS shifted_id, physicalid FROM path_vertices"))
def _(spark, sf_dir):
    """A path moved by less than the radius lies within its own buffer, whatever its corners, rings and parts."""
    lines = fx.paths(spark, sf_dir)
    by = (F.col("physicalid") % 3 * 12).cast("double")
    moved = lines.select(
        F.col("physicalid").alias("shifted_id"),
        F.transform("geometry", lambda part: F.transform(part, lambda v: geo.vertex(v["x"] + by, v["y"] - by / 2))).alias("geometry"),
    )
    pairs = spatial_join.line_within_buffer_join(moved, lines, RADIUS, inner_id="shifted_id", outer_id="physicalid")
    return pairs.where("shifted_id = physicalid").select("shifted_id", "physicalid")
