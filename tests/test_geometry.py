import math
import random

import pytest
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.functions import projection


def line(spark, rows):
    """rows of (id, parts), parts as lists of (x, y)."""
    data = [(i, [[{"x": float(x), "y": float(y)} for x, y in part] for part in parts]) for i, parts in rows]
    return spark.createDataFrame(data, f"id long, geometry {geo.GEOMETRY_TYPE}")


def test_wkt_decodes_and_encodes(spark):
    texts = {
        1: "POINT (1.5 -2)",
        2: "LINESTRING (0 0, 3 4)",
        3: "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 4))",
        4: "MULTILINESTRING EMPTY",
        5: None,
    }
    df = spark.createDataFrame(list(texts.items()), "id long, wkt string")
    decoded = df.select("id", geo.geometry_from_wkt(F.col("wkt")).alias("geometry"))
    shapes = {r.id: r.geometry and [[tuple(v) for v in p] for p in r.geometry] for r in decoded.collect()}
    assert shapes[1] == [[(1.5, -2.0)]]
    assert shapes[2] == [[(0.0, 0.0), (3.0, 4.0)]]
    assert shapes[3] == [[(0.0, 0.0), (1.0, 1.0)], [(2.0, 2.0), (3.0, 3.0), (4.0, 4.0)]]
    assert not shapes[4] and shapes[5] is None
    again = decoded.select("id", geo.geometry_from_wkt(geo.geometry_to_wkt(F.col("geometry"))).alias("geometry"))
    assert sorted(map(str, again.collect())) == sorted(map(str, decoded.collect()))
    assert geo.drop_empty_geometry(geo.drop_missing_geometry(decoded)).count() == 3


def test_geojson_of_three_types(spark):
    texts = [
        (1, '{"type":"Point","coordinates":[-74.0,40.5]}'),
        (2, '{"type":"LineString","coordinates":[[0,0],[1,2]]}'),
        (3, '{"type":"MultiLineString","coordinates":[[[0,0],[1,2]],[[5,5],[6,6]]]}'),
    ]
    df = spark.createDataFrame(texts, "id long, t string").select(
        "id", geo.geometry_from_geojson(F.col("t")).alias("g")
    )
    shapes = {r.id: [[tuple(v) for v in p] for p in r.g] for r in df.collect()}
    assert shapes == {
        1: [[(-74.0, 40.5)]],
        2: [[(0.0, 0.0), (1.0, 2.0)]],
        3: [[(0.0, 0.0), (1.0, 2.0)], [(5.0, 5.0), (6.0, 6.0)]],
    }


def test_boundary_of_ring_and_touching_parts(spark):
    df = line(spark, [
        (1, [[(0, 0), (1, 0), (1, 1), (0, 0)]]),  # closed ring
        (2, [[(0, 0), (1, 0)], [(1, 0), (2, 0)]]),  # two parts meeting
        (3, [[(0, 0), (5, 5), (9, 0)]]),
    ])
    rows = df.select("id", F.inline(geo.boundary_points(F.col("geometry")))).collect()
    assert sorted((r.id, r.x, r.y) for r in rows) == [(2, 0, 0), (2, 2, 0), (3, 0, 0), (3, 9, 0)]


def test_centroid_weights_by_length(spark):
    df = line(spark, [(1, [[(0, 0), (4, 0), (4, 2)]]), (2, [[(7, 7), (7, 7)]]), (3, [[(2, 3)]])])
    found = {r.id: (r.c.x, r.c.y) for r in df.select("id", geo.centroid(F.col("geometry")).alias("c")).collect()}
    assert found[1] == pytest.approx(((2 * 4 + 4 * 2) / 6, (0 * 4 + 1 * 2) / 6))
    assert found[2] == (7.0, 7.0) and found[3] == (2.0, 3.0)


def test_distance_against_sampling(spark):
    rng = random.Random(1)
    rows = [tuple(rng.uniform(-50, 50) for _ in range(6)) for _ in range(200)] + [(3.0, 4.0, 0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double, x0 double, y0 double, x1 double, y1 double")
    for r in df.withColumn("d2", geo.distance_squared("x", "y")).collect():
        best = min(
            (r.x - r.x0 - t * (r.x1 - r.x0)) ** 2 + (r.y - r.y0 - t * (r.y1 - r.y0)) ** 2
            for t in (i / 2000 for i in range(2001))
        )
        assert r.d2 <= best + 1e-9 and math.isclose(r.d2, best, rel_tol=1e-2, abs_tol=1e-2)


def test_projection_known_points(spark):
    df = spark.createDataFrame([(40 + 10 / 60, -74.0), (40.7128, -74.006), (None, -74.0)], "latitude double, longitude double")
    rows = sorted((round(r.x, 1), round(r.y, 1)) for r in projection.point_from_lat_long(df).collect())
    assert rows == [(982586.6, 198968.8), (984250.0, 0.0)]
