"""Street intersections: the discs around street ends, merged where they overlap."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.operators.spatial_join import (
    points_near,
    spatial_pairs,
    spread_hot_keys,
    with_point_cell,
)
from curbline.session import settle

SUB_CELLS = 8


def street_ends(streets: DataFrame) -> DataFrame:
    """Distinct end points ``x``, ``y`` of the streets (closed rings have none)."""
    ends = streets.select(F.inline(geo.boundary_points(F.col("geometry"))))
    return ends.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for an undirected graph given as ``a``, ``b``; the component is its
    smallest node.

    Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014): logarithmically many rounds on long chains, where passing
    the smallest label from neighbour to neighbour needs as many rounds as the chain is long.
    The neighbour minimum is an aggregate combined on the map side and the joins salt nodes with
    very many neighbours, so no node is gathered in one task.
    """
    edges = settle(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while not _is_star_forest(edges):  # logarithmically many rounds
        # large star: every larger neighbour is linked to the smallest neighbour or the node
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        star = both.groupBy("a").agg(
            F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n")
        )
        upward, hubs = spread_hot_keys(
            both.where(F.col("b") > F.col("a")), star.drop("n"), ["a"], ["b"], star
        )
        down = upward.join(hubs, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        star = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        down, hubs = spread_hot_keys(down, star.drop("n"), ["a"], ["b"], star)
        small = (
            down.join(hubs, ["a", "salt"])
            .select(F.inline(F.array(
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            )))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = settle(small, "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node hangs on one other node, and that node hangs on none: nothing left to do."""
    roles = edges.select(
        F.inline(F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("hangs")),
            F.struct(F.col("b").alias("node"), F.lit(0).alias("hangs")),
        ))
    )
    unsettled = (
        roles.groupBy("node")
        .agg(F.sum("hangs").alias("links"), F.min("hangs").alias("least"))
        .where((F.col("links") > 1) | ((F.col("links") == 1) & (F.col("least") == 0)))
    )
    return unsettled.isEmpty()


def _touching_cells(ends: DataFrame, reach: float) -> DataFrame:
    """(a, b) for neighbouring cells holding two ends nearer than ``reach``.

    Each cell is cut into sub-cells, and only the bounding boxes of the sub-cells are paired: at
    most a fixed number per cell, however many ends there are. Boxes wholly within reach decide a
    pair of cells, boxes wholly out of reach decide nothing. The boxes in between are cut again, for
    the cells that no box has decided yet, until single ends remain; the ends of two boxes are never
    all compared.
    """
    boxes = settle(
        ends.groupBy("cx", "cy", "node", "sub").agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
        ),
        "boxes",
    )
    # Neighbours up to two cells away in one half plane, so that each pair of cells meets once.
    offsets = [(i, j) for i in range(0, 3) for j in range(-2, 3) if i > 0 or j > 0]
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])
    moved = boxes.select(
        *[F.col(c).alias(f"o_{c}") for c in ("node", "sub", "x0", "x1", "y0", "y1", "cx", "cy")],
        F.inline(steps),
    ).withColumns({"cx": F.col("o_cx") + F.col("i"), "cy": F.col("o_cy") + F.col("j")})
    near = " + ".join(f"pow(greatest(0D, {c}0 - o_{c}1, o_{c}0 - {c}1), 2)" for c in "xy")
    far = " + ".join(f"pow(greatest({c}1 - o_{c}0, o_{c}1 - {c}0), 2)" for c in "xy")
    paired = boxes.join(moved, ["cx", "cy"]).selectExpr(
        "node as a", "o_node as b", "sub", "o_sub", f"{near} as near", f"{far} as far"
    )
    open_pairs = settle(paired.where(F.col("near") < F.lit(reach * reach)), "box-pairs")
    decided, undecided = _decided(open_pairs, reach)
    points, step = ends.select("node", "sub", "x", "y"), reach / math.sqrt(2.0) / SUB_CELLS
    while not undecided.isEmpty():
        step /= SUB_CELLS
        points = points.withColumn(
            "part", F.struct(*[F.floor(F.col(c) / F.lit(step)).alias(f"p{c}") for c in "xy"]))
        boxes = settle(
            points.groupBy("node", "sub", "part").agg(
                F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
            ),
            "boxes",
        )
        columns = ("node", "sub", "part", "x0", "x1", "y0", "y1")
        here = boxes.select(F.col("node").alias("a"), *columns[1:])
        there = boxes.select(F.col("node").alias("b"), *[F.col(c).alias(f"o_{c}") for c in columns[1:]])
        paired = undecided.join(here, ["a", "sub"]).join(there, ["b", "o_sub"]).selectExpr(
            "a", "b", "part as sub", "o_part as o_sub", f"{near} as near", f"{far} as far"
        )
        open_pairs = settle(paired.where(F.col("near") < F.lit(reach * reach)), "box-pairs")
        now, undecided = _decided(open_pairs, reach)
        decided = settle(decided.unionByName(now), "decided")
        points = points.select("node", F.col("part").alias("sub"), "x", "y")
    return decided.distinct()


def _decided(open_pairs: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes that some pair of boxes decides, and the pairs of boxes of all other nodes."""
    decided = settle(open_pairs.where(F.col("far") < F.lit(reach * reach)).select("a", "b").distinct(), "decided")
    rest = open_pairs.where(F.col("far") >= F.lit(reach * reach)).select("a", "b", "sub", "o_sub")
    return decided, settle(rest.join(decided, ["a", "b"], "left_anti"), "undecided")


def intersection_components(streets: DataFrame, radius: float = 30.0) -> DataFrame:
    """(x, y, component) for every distinct street end.

    Two discs of radius r overlap when their centres are nearer than 2r. Cells with a diagonal
    just below 2r hold only connected ends, so a cell is one node of the graph and no pairs
    are formed inside it. A component is named by its smallest cell.
    """
    reach = 2.0 * radius
    side = reach / math.sqrt(2.0) * (1 - 1e-9)
    sub = [
        f"cast(least({SUB_CELLS - 1}, floor(({axis} / {side!r} - c{axis}) * {SUB_CELLS})) as int)" for axis in "xy"
    ]
    ends = settle(
        with_point_cell(street_ends(streets), side).withColumns(
            {"node": _cell_id("cx", "cy"), "sub": F.expr(f"{sub[0]} * {SUB_CELLS} + {sub[1]}")}
        ),
        "ends",
    )
    labels = connected_components(_touching_cells(ends, reach))
    return ends.join(labels, "node", "left").select(
        "x", "y", F.coalesce("component", "node").alias("component")
    )


def _cell_id(cx: str, cy: str) -> Column:
    """One number per cell: both indices lie well within 31 bits of a planar city grid."""
    return F.col(cx) * F.lit(1 << 32) + F.col(cy)


def intersection_weights(
    streets: DataFrame, radius: float = 30.0, *, street_id: str = "physicalid"
) -> DataFrame:
    """(x, y, component, streets, weight): the weight of an intersection is one over the number
    of streets touching any of its discs. Pass one row per street."""
    ends = settle(intersection_components(streets, radius), "components")
    touching = spatial_pairs(
        ends, streets.select(street_id, "geometry"), radius, point_id=["x", "y"], closed=True
    )
    counts = (
        touching.select("component", street_id)
        .distinct()
        .groupBy("component")
        .agg(F.count(F.lit(1)).alias("streets"))
    )
    return ends.join(counts, "component").select(
        "x", "y", "component", "streets", (F.lit(1.0) / F.col("streets")).alias("weight")
    )


def within_disc(
    points: DataFrame, discs: DataFrame, radius: float, *, point_id: str | list[str]
) -> DataFrame:
    """Pairs of points and discs (centre ``x``, ``y``) with the point strictly inside."""
    return spatial_pairs(points, _discs(discs), radius, point_id=point_id)


def _discs(centres: DataFrame) -> DataFrame:
    """Centres as lines without length."""
    x, y = F.col("x"), F.col("y")
    return centres.withColumn("geometry", geo.straight_line(x, y, x, y)).drop("x", "y")


def away_from_intersections(points: DataFrame, streets: DataFrame, radius: float, *, point_id: str) -> DataFrame:
    """The points outside every street-end disc."""
    return points_near(points, _discs(street_ends(streets)), radius, point_id=point_id, negate=True)


def intersection_split(
    points: DataFrame, streets: DataFrame, radius: float, *, point_id: str
) -> tuple[DataFrame, DataFrame]:
    """(points inside any street-end disc, all other points)."""
    discs = _discs(street_ends(streets))
    return tuple(
        points_near(points, discs, radius, point_id=point_id, negate=negate) for negate in (False, True)
    )
