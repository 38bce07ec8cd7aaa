import math
import random

import pytest

from curbline.functions import geometry as geo
from curbline.operators import intersections, nearest, spatial_join
from tests.test_geometry import line


def points(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y)) for i, x, y in rows], "pid long, x double, y double")


def segment_distance(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    l2 = dx * dx + dy * dy
    t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / l2))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


def line_distance(p, parts):
    return min(segment_distance(*p, *a, *b) for part in parts for a, b in zip(part, part[1:]))


def random_lines(rng, n, extent=1000.0):
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.choice([1, 1, 2])):
            x, y = rng.uniform(-extent, extent), rng.uniform(-extent, extent)
            part = [(x, y)]
            for _ in range(rng.randint(1, 4)):
                x, y = x + rng.uniform(-300, 300), y + rng.uniform(-300, 300)
                part.append((x, y))
            parts.append(part)
        rows.append((i, parts))
    return rows


@pytest.fixture(scope="module")
def scene(spark):
    rng = random.Random(7)
    lines = random_lines(rng, 60)
    pts = [(i, rng.uniform(-1200, 1200), rng.uniform(-1200, 1200)) for i in range(800)]
    return lines, pts


def expected_pairs(scene, r):
    lines, pts = scene
    return sorted((i, j) for i, x, y in pts for j, parts in lines if line_distance((x, y), parts) < r)


@pytest.mark.parametrize("cell", [None, 17.0, 5000.0])
def test_pairs_match_brute_force_for_any_cell(spark, scene, cell):
    lines, pts = scene
    found = spatial_join.spatial_pairs(points(spark, pts), line(spark, lines), 30.0, point_id="pid", cell=cell)
    assert sorted((r.pid, r.id) for r in found.collect()) == expected_pairs(scene, 30.0)


def test_pairs_do_not_depend_on_salting(spark, scene, monkeypatch):
    lines, pts = scene
    monkeypatch.setattr(spatial_join, "HOT_KEY_ROWS", 3)
    monkeypatch.setattr(spatial_join, "BROADCAST_ROWS", 10)
    found = spatial_join.spatial_pairs(points(spark, pts), line(spark, lines), 30.0, point_id="pid", cell=400.0)
    assert sorted((r.pid, r.id) for r in found.collect()) == expected_pairs(scene, 30.0)


def test_hot_cell_is_spread(spark, monkeypatch):
    monkeypatch.setattr(spatial_join, "HOT_KEY_ROWS", 10)
    pts = points(spark, [(i, 1.0 + i / 1000, 1.0) for i in range(100)])
    lines = line(spark, [(1, [[(0, 0), (5, 0)]])])
    many = spatial_join.with_point_cell(pts, 120.0)
    few = spatial_join.with_covering_cells(geo.explode_segments(lines), 120.0, 30.0)
    spread, copied = spatial_join.spread_hot_keys(many, few, ["cx", "cy"], ["pid"])
    assert spread.select("salt").distinct().count() == 10
    assert copied.where("cx = 0 and cy = 0").count() == 10


def test_radius_is_open_or_closed(spark):
    lines = line(spark, [(1, [[(0, 0), (10, 0)]]), (2, [[(500, 500), (500, 500)]])])
    pts = points(spark, [(1, 5, 30), (2, 5, 29.999), (3, 500, 530), (4, 500, 520), (5, 9000, 9000)])
    def found(**options):
        rows = spatial_join.spatial_pairs(pts, lines, 30.0, point_id="pid", **options).collect()
        return sorted((r.pid, r.id) for r in rows)

    assert found() == [(2, 1), (4, 2)]
    assert found(closed=True) == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_outer_joins_keep_the_unmatched(spark):
    lines = line(spark, [(1, [[(0, 0), (10, 0)]]), (2, [[(900, 900), (910, 900)]])])
    pts = points(spark, [(1, 5, 1), (2, -700, 0)])
    def run(how):
        rows = spatial_join.point_within_buffer_join(pts, lines, 30.0, point_id="pid", line_id="id", how=how).collect()
        return sorted(((r.pid, r.id) for r in rows), key=str)

    assert run("inner") == [(1, 1)]
    assert run("left") == [(1, 1), (2, None)]
    assert run("right") == [(1, 1), (None, 2)]
    with pytest.raises(ValueError):
        run("cross")


@pytest.mark.parametrize("limit", [0, 250_000])
def test_semi_and_anti(spark, scene, monkeypatch, limit):
    lines, pts = scene
    monkeypatch.setattr(spatial_join, "BROADCAST_ROWS", limit)
    near = {i for i, _ in expected_pairs(scene, 30.0)}
    table, geometry = points(spark, pts), line(spark, lines)
    inside = spatial_join.points_near(table, geometry, 30.0, point_id="pid")
    outside = spatial_join.points_near(table, geometry, 30.0, point_id="pid", negate=True)
    assert {r.pid for r in inside.collect()} == near and inside.count() == len(near)
    assert {r.pid for r in outside.collect()} == {i for i, _, _ in pts} - near


@pytest.mark.parametrize("limit, join", [(0, "SortMergeJoin"), (250_000, "BroadcastHashJoin [cx")])
def test_no_nested_loops_in_plans(spark, scene, monkeypatch, limit, join):
    lines, pts = scene
    monkeypatch.setattr(spatial_join, "BROADCAST_ROWS", limit)
    table, geometry = points(spark, pts), line(spark, lines)
    plans = [
        spatial_join.spatial_pairs(table, geometry, 30.0, point_id="pid"),
        spatial_join.points_near(table, geometry, 30.0, point_id="pid"),
        spatial_join.line_within_buffer_pairs(
            geometry, geometry.withColumnRenamed("id", "oid"), 30.0, inner_id="id", outer_id="oid"
        ),
    ]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text and join in text


def covered(inner, outer, r, steps=400):
    for part in inner:
        for a, b in zip(part, part[1:]):
            for i in range(steps + 1):
                p = (a[0] + (b[0] - a[0]) * i / steps, a[1] + (b[1] - a[1]) * i / steps)
                if line_distance(p, outer) > r:
                    return False
    return True


def test_line_cover_needs_more_than_vertices(spark):
    inner = line(spark, [
        (1, [[(0, 0), (100, 0)]]),  # ends near the outer line, middle far away
        (2, [[(0, 200), (100, 200)]]),  # covered by two segments together
        (3, [[(50, 400), (50, 400)]]),  # collapsed, inside
        (4, [[(0, 600), (100, 600)], [(0, 900), (10, 900)]]),  # one of two parts inside
    ])
    outer = line(spark, [
        (1, [[(0, 0), (50, 80), (100, 0)]]),
        (2, [[(0, 210), (60, 205)], [(60, 195), (100, 190)]]),
        (3, [[(40, 400), (60, 400)]]),
        (4, [[(0, 610), (100, 610)]]),
    ]).withColumnRenamed("id", "oid")
    pairs = spatial_join.line_within_buffer_pairs(inner, outer, 15.0, inner_id="id", outer_id="oid").collect()
    assert sorted((r.id, r.oid) for r in pairs) == [(2, 2), (3, 3)]


@pytest.mark.parametrize("limit", [0, 250_000])
def test_line_cover_against_sampling(spark, monkeypatch, limit):
    monkeypatch.setattr(spatial_join, "BROADCAST_ROWS", limit)
    rng = random.Random(3)
    outer = random_lines(rng, 25, 300.0)
    inner = []
    for i in range(120):  # short lines running beside some outer segment
        part = rng.choice(rng.choice(outer)[1])
        a, b = part[0], part[1]
        t0, t1 = rng.random(), rng.random()
        shift = rng.uniform(-50, 50)
        p = [(a[0] + (b[0] - a[0]) * t + shift, a[1] + (b[1] - a[1]) * t + rng.uniform(-20, 20)) for t in (t0, t1)]
        inner.append((i, [p]))
    want = {(i, j) for i, parts in inner for j, other in outer if covered(parts, other, 30.0)}
    pairs = spatial_join.line_within_buffer_pairs(
        line(spark, inner), line(spark, outer).withColumnRenamed("id", "oid"), 30.0, inner_id="id", outer_id="oid"
    ).collect()
    got = {(r.id, r.oid) for r in pairs}
    # sampling may miss a very short excursion, never the other way round
    assert got <= want and len(want - got) <= 2


@pytest.mark.parametrize("crowd", [0, 300])
def test_nearest_matches_brute_force(spark, crowd):
    rng = random.Random(11)
    lines = random_lines(rng, 40, 4000.0)
    sites = [(i, rng.uniform(-6000, 6000), rng.uniform(-6000, 6000)) for i in range(50)]
    # many sites in one small spot
    sites += [(1000 + i, 100 + rng.random() / 100, 100 + rng.random() / 100) for i in range(crowd)]
    table = spark.createDataFrame([(i, x, y, i * 2.0) for i, x, y in sites], "sid long, x double, y double, vol double")
    found = nearest.nearest_join(line(spark, lines), table, line_id="id", site_id="sid", buffer=25.0)
    got = {r.id: (round(r.distance, 6), r.sid) for r in found.collect()}
    for i, parts in lines:
        want = min((round(max(0.0, line_distance((x, y), parts) - 25.0), 6), s) for s, x, y in sites)
        assert got[i] == want


def test_nearest_tie_takes_the_smallest_id(spark):
    table = spark.createDataFrame([(5, 0.0, 10.0), (3, 0.0, -10.0), (9, 400.0, 0.0)], "sid long, x double, y double")
    found = nearest.nearest_join(line(spark, [(1, [[(-1, 0), (1, 0)]])]), table, line_id="id", site_id="sid")
    assert [(r.sid, r.distance) for r in found.collect()] == [(3, 10.0)]


def components_by_union(ends, reach):
    parent = list(range(len(ends)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(ends):
        for j in range(i):
            if math.dist(a, ends[j]) < reach:
                parent[root(i)] = root(j)
    groups = {}
    for i, e in enumerate(ends):
        groups.setdefault(root(i), set()).add(e)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("extent", [900, 2500])
def test_components_match_union_find(spark, extent):
    rng = random.Random(extent)
    rows = [(i, [[(rng.randint(0, extent), rng.randint(0, extent)), (rng.randint(0, extent), rng.randint(0, extent))]]) for i in range(150)]
    rows.append((900, [[(-5000, -5000), (-4000, -4000), (-5000, -5000)]]))  # closed: no ends
    labelled = intersections.intersection_components(line(spark, rows), 30.0).collect()
    groups = {}
    for r in labelled:
        groups.setdefault(r.component, set()).add((r.x, r.y))
    ends = sorted({v for i, parts in rows if i != 900 for v in ((float(x), float(y)) for x, y in parts[0])})
    assert sorted(map(sorted, groups.values())) == components_by_union(ends, 60.0)


@pytest.mark.parametrize("apart", [57.0, 59.9, 60.5])
def test_components_of_crowded_ends(spark, apart):
    rng = random.Random(int(apart * 10))
    spots = [(0.0, 0.0), (apart, 0.0), (apart + 300, 5.0)]
    rows = [
        (i, [[tuple(c + rng.random() * 2 for c in rng.choice(spots)), tuple(c + rng.random() * 2 for c in rng.choice(spots))]])
        for i in range(250)
    ]
    labelled = intersections.intersection_components(line(spark, rows), 30.0).collect()
    groups = {}
    for r in labelled:
        groups.setdefault(r.component, set()).add((r.x, r.y))
    ends = sorted({v for _, parts in rows for v in parts[0]})
    assert sorted(map(sorted, groups.values())) == components_by_union(ends, 60.0)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    rows = intersections.connected_components(edges).collect()
    assert {r.node: r.component for r in rows} == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_intersection_split_partitions_the_points(spark, scene):
    lines, pts = scene
    table = points(spark, pts)
    inside, outside = intersections.intersection_split(table, line(spark, lines), 30.0, point_id="pid")
    assert inside.count() + outside.count() == len(pts)
    assert inside.select("pid").intersect(outside.select("pid")).isEmpty()


def test_point_geometries_take_part_in_joins(spark):
    spots = spark.createDataFrame([(1, [[(0.0, 0.0)]]), (2, [[(50.0, 0.0)], [(0.0, 30.0), (0.0, 40.0)]])],
                                  "lid int, geometry array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 50.5, 0.0), (3, 1.0, 35.0), (4, 25.0, 0.0)], "pid int, x double, y double")
    pairs = spatial_join.point_within_buffer_join(points, spots, 2.0, point_id="pid", line_id="lid")
    assert sorted((r.pid, r.lid) for r in pairs.collect()) == [(1, 1), (2, 2), (3, 2)]


def test_outer_joins_store_nothing(spark, monkeypatch):
    spots = spark.createDataFrame(
        [(1, [[(0.0, 0.0), (9.0, 0.0)]], "a"), (2, [[(90.0, 0.0), (99.0, 0.0)]], "b")],
        "lid int, geometry array<array<struct<x:double,y:double>>>, wide string")
    points = spark.createDataFrame([(1, 1.0, 1.0, "p"), (2, 500.0, 0.0, "q"), (3, None, None, "r")], "pid int, x double, y double, note string")
    monkeypatch.setattr(spatial_join, "settle", None)  # nothing is written
    for limit in (250_000, 0):  # lines broadcast, and both sides shuffled
        monkeypatch.setattr(spatial_join, "BROADCAST_ROWS", limit)
        left, right = (
            spatial_join.point_within_buffer_join(points, spots, 2.0, point_id="pid", line_id="lid", how=how)
            for how in ("left", "right")
        )
        assert sorted((r.pid, r.note, r.lid, r.wide) for r in left.collect()) == [
            (1, "p", 1, "a"), (2, "q", None, None), (3, "r", None, None)]
        assert sorted(((r.lid, r.wide, r.pid) for r in right.collect())) == [(1, "a", 1), (2, "b", None)]
