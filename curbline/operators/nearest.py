"""Nearest site per line, exact, without comparing every line with every site.

Sites are listed in a pyramid of grids, each level twice as coarse as the one before. A line
looks up the finest level at which its start lies in or next to an occupied cell; the distance
to that cell's representative site bounds the search. Only cells within the bound are joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.operators.spatial_join import (
    grid_sizes,
    spread_hot_keys,
    with_covering_cells,
    with_point_cell,
)
from curbline.session import settle

_CELL = ["level", "cx", "cy"]


CROWDED_CELL = 64


def _levels(lines: DataFrame, sites: DataFrame) -> list[float]:
    """Cell sizes: from a few sites per cell up to one cell over everything."""
    corners = lines.select(F.inline(F.flatten("geometry")))
    extent = corners.unionByName(sites.select("x", "y")).agg(
        F.max("x") - F.min("x"), F.max("y") - F.min("y")
    )
    width, height = (float(v or 0.0) for v in extent.first())
    span = max(width, height, 1.0)

    def fullest(size: float) -> int:
        counts = with_point_cell(sites.select("x", "y"), size).groupBy("cx", "cy").count()
        return counts.agg(F.max("count")).first()[0] or 0

    return grid_sizes(span / math.sqrt(max(sites.count(), 1)), span, fullest, CROWDED_CELL)


def _with_level(df: DataFrame, sizes: list[float]) -> DataFrame:
    entries = [F.struct(F.lit(i).alias("level"), F.lit(s).alias("size")) for i, s in enumerate(sizes)]
    return df.select("*", F.inline(F.array(*entries)))


def nearest_join(
    lines: DataFrame,
    sites: DataFrame,
    *,
    line_id: str,
    site_id: str,
    buffer: float = 0.0,
) -> DataFrame:
    """Every line with its nearest site's columns and ``distance`` from the buffered line (0
    inside the buffer). Among equally near sites the smallest ``site_id`` is taken.

    ``sites`` should hold one row per place (aggregate measurements first).
    """
    sites = settle(sites, "sites")
    sizes = _levels(lines, sites)
    listed = with_point_cell(_with_level(sites, sizes), "size").drop("size")
    around = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    occupied = (
        listed.groupBy(*_CELL)
        .agg(F.min(F.struct("x", "y")).alias("site"))
        .select("level", "cx", "cy", "site", F.inline(F.array(*around)))
        .groupBy("level", (F.col("cx") + F.col("i")).alias("cx"), (F.col("cy") + F.col("j")).alias("cy"))
        .agg(F.min("site").alias("site"))
    )
    start = geo.first_vertex(F.col("geometry"))
    anchors = lines.select(F.col(line_id).alias("_line"), start["x"].alias("x"), start["y"].alias("y"))
    spread, copied = spread_hot_keys(
        with_point_cell(_with_level(anchors, sizes), "size"), occupied, _CELL, ["_line"]
    )
    gap = F.sqrt((F.col("x") - F.col("site.x")) ** 2 + (F.col("y") - F.col("site.y")) ** 2)
    search = settle(
        spread.join(copied, [*_CELL, "salt"])
        .groupBy("_line")
        .agg(F.min(F.struct("level", "size", gap.alias("bound"))).alias("s"))
        .select("_line", "s.level", "s.size", F.greatest("s.bound", F.lit(float(buffer))).alias("bound")),
        "search",
    )
    pieces = geo.explode_segments(lines.select(F.col(line_id).alias("_line"), "geometry"))
    pieces = pieces.drop("part", "pos").join(search, "_line")
    reach = with_covering_cells(pieces, "size", "bound").drop("size", "bound")
    used = search.agg(F.max("level")).scalar()
    spread, copied = spread_hot_keys(
        reach, listed.where(F.col("level") <= used), _CELL, ["_line", "x0", "y0"]
    )
    columns = [c for c in sites.columns if c not in ("x", "y", site_id)]
    candidate = F.struct(
        _clipped(F.sqrt(geo.distance_squared("x", "y")), buffer).alias("distance"),
        F.col(site_id),
        *[F.col(c) for c in columns],
    )
    best = (
        spread.join(copied, [*_CELL, "salt"])
        .groupBy("_line")
        .agg(F.min(candidate).alias("b"))
        .select(F.col("_line").alias(line_id), "b.*")
    )
    return lines.drop("geometry").join(best, line_id, "left")


def _clipped(distance: Column, buffer: float) -> Column:
    return F.greatest(F.lit(0.0), distance - F.lit(float(buffer)))
