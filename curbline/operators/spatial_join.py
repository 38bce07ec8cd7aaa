"""Spatial joins as equi-joins on grid cells.

A bare distance condition plans as a nested loop. Here every segment is listed under the
cells its r-neighbourhood touches, every point under its own cell, and the join runs on the
cell, so it is a hash or sort-merge join with the exact distance as residual condition.

Size: the listed segments are counted. Few enough, they are broadcast and the points are not
shuffled at all; otherwise both sides are shuffled by cell.

Skew: cells holding very many points are then split. The number of points per cell is counted
first (combined on the map side); the ``MAX_HOT_KEYS`` fullest cells above ``HOT_KEY_ROWS``
points get salts. That list has a fixed bound, so it may be broadcast, and every cell not on
it holds less than ``1/MAX_HOT_KEYS`` of the points. Points of a hot cell are spread over the
salts, its segments are copied once per salt; the result does not depend on it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.session import settle

HOT_KEY_ROWS = 200_000
MAX_HOT_KEYS = 10_000
MAX_SALTS = 4096
# Limits of a broadcast side: rows, and their size as text, names included.
BROADCAST_ROWS = 250_000
BROADCAST_BYTES = 64 << 20
CELLS_PER_RADIUS = 4.0
# Feet by which a neighbourhood is widened when it is listed under cells and when lines are
# tested for containment, so that rounding cannot lose a pair lying exactly at the radius.
TOLERANCE = 1e-7

_CELL = ["cx", "cy"]
_KEY = ["cx", "cy", "salt"]
_SEGMENT = ["x0", "y0", "x1", "y1"]


def cell_size(radius: float) -> float:
    return CELLS_PER_RADIUS * radius


def with_point_cell(df: DataFrame, size: float | str) -> DataFrame:
    """Add the cell ``cx``, ``cy`` of ``x``, ``y``; ``size`` is a number or a column name."""
    return df.withColumns(
        {
            f"c{axis}": F.expr(f"cast(floor({axis} / cast({size} as double)) as bigint)")
            for axis in ("x", "y")
        }
    )


def with_covering_cells(
    segments: DataFrame, size: float | str, radius: float | str
) -> DataFrame:
    """One row per segment and cell that its ``radius``-neighbourhood may touch.

    Column by column of the grid the segment is clipped to the column widened by the radius,
    so a long segment is listed under a band of cells along it, not under its bounding box.
    ``size`` and ``radius`` are numbers or column names.
    """
    step, pad = f"cast({size} as double)", f"(cast({radius} as double) + {TOLERANCE})"

    def cells(low: str, high: str) -> Column:
        return F.expr(
            f"explode(sequence(cast(floor((least({low}, {high}) - {pad}) / {step}) as bigint), "
            f"cast(floor((greatest({low}, {high}) + {pad}) / {step}) as bigint)))"
        )

    columns = segments.columns
    return (
        segments.withColumn("cx", cells("x0", "x1"))
        .withColumns(
            {
                "_in": F.expr(f"try_divide(cx * {step} - {pad} - x0, x1 - x0)"),
                "_out": F.expr(f"try_divide((cx + 1) * {step} + {pad} - x0, x1 - x0)"),
            }
        )
        # a vertical segment has no clipping range (NULL): it keeps its whole extent
        .withColumns(
            {
                "_ya": F.expr("coalesce(y0 + greatest(0D, least(1D, _in, _out)) * (y1 - y0), y0)"),
                "_yb": F.expr(
                    "if(_in is null, y1, y0 + least(1D, greatest(0D, _in, _out)) * (y1 - y0))"
                ),
            }
        )
        .withColumn("_ya", F.expr("if(_in is null, y0, _ya)"))
        .withColumn("cy", cells("_ya", "_yb"))
        .select(*columns, "cx", "cy")
    )


def hot_keys(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """The fullest keys with their number of salts, from a table of rows ``n`` per key."""
    return (
        counts.where(F.col("n") > HOT_KEY_ROWS)
        .orderBy(F.col("n").desc())
        .limit(MAX_HOT_KEYS)
        .select(
            *key,
            F.least(F.ceil(F.col("n") / F.lit(HOT_KEY_ROWS)), F.lit(MAX_SALTS)).cast("int").alias("salts"),
        )
    )


def spread_hot_keys(
    many: DataFrame,
    few: DataFrame,
    key: Sequence[str],
    salt_by: Sequence[str],
    counts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add ``salt`` to both sides of a join: rows of ``many`` with a hot key are spread over the
    salts, the rows of ``few`` are copied to each. Join on ``[*key, "salt"]``. ``counts`` may
    supply the rows ``n`` of ``many`` per key where they are known already.

    The join is asked to be a sort-merge join: ``few`` is often an exploded table, whose size the
    planner underestimates, and must not be broadcast on that estimate."""
    if counts is None:
        counts = many.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(counts, key))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    spread = (
        many.join(hot, list(key), "left")
        .withColumn("salt", F.pmod(F.xxhash64(*salt_by), salts).cast("int"))
        .drop("salts")
    )
    copied = (
        few.join(hot, list(key), "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("salts")
    )
    return spread, copied.hint("merge")


def broadcast_or_spread(
    many: DataFrame, few: DataFrame, key: Sequence[str], salt_by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``salt``. If ``few``, measured up to the limits, has at most ``BROADCAST_ROWS``
    rows and ``BROADCAST_BYTES`` with all the columns it carries, it is broadcast and ``many`` needs
    neither shuffle nor salts; beyond that both are shuffled with hot keys spread."""
    rows, size = few.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.sum(_row_bytes(few))).first()
    if rows > BROADCAST_ROWS or (size or 0) > BROADCAST_BYTES:
        return spread_hot_keys(many, few, key, salt_by)
    zero = F.lit(0)
    return many.withColumn("salt", zero), F.broadcast(few.withColumn("salt", zero))


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 for a number, the length of a text, and of anything nested written as text."""
    total = F.lit(0)
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            total = total + 8
    return total


def grid_sizes(finest: float, span: float, fullest, bound: int) -> list[float]:
    """Cell sizes doubling from ``finest`` to ``span``. While ``fullest(size)``, the rows of the
    fullest cell, exceeds ``bound``, the finest size is lowered: rows crowded in one spot get
    levels of their own, down to a 2**40th of the span."""
    floor_ = span * 2.0**-40
    while finest > floor_ and fullest(finest) > bound:
        finest = max(finest / 16, floor_)
    steps = math.ceil(math.log2(span / finest)) if span > finest else 0
    return [finest * 2**i for i in range(steps + 1)]


def _as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _point_cells(
    points: DataFrame, lines: DataFrame, radius: float, point_id: Sequence[str], closed: bool,
    cell: float | None,
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides listed by (salted) cell, and the distance condition."""
    size = cell or cell_size(radius)
    pieces = with_covering_cells(geo.explode_segments(lines).drop("part", "pos"), size, radius)
    spread, copied = broadcast_or_spread(with_point_cell(points, size), pieces, _CELL, point_id)
    gap, limit = geo.distance_squared("x", "y"), F.lit(radius * radius)
    return spread, copied, (gap <= limit if closed else gap < limit)


def spatial_pairs(
    points: DataFrame,
    lines: DataFrame,
    radius: float,
    *,
    point_id: str | Sequence[str],
    closed: bool = False,
    cell: float | None = None,
) -> DataFrame:
    """Every (point, line) pair nearer than ``radius``, once per pair, with its ``distance``.

    ``points`` has ``x``, ``y`` and its key; ``lines`` has ``geometry``. All other columns of
    both sides are carried along and must identify the row. A point exactly at the radius
    matches only when ``closed``. A point near several segments of one line is one pair: the
    grouping includes the cell, so it runs on the partitions of the join, without a shuffle.
    """
    spread, copied, near = _point_cells(points, lines, radius, _as_list(point_id), closed, cell)
    return _pairs(spread, copied, near, points, lines)


def _pairs(spread: DataFrame, copied: DataFrame, near: Column, points: DataFrame, lines: DataFrame) -> DataFrame:
    line_columns = [c for c in lines.columns if c != "geometry"]
    return (
        spread.join(copied, _KEY)
        .where(near)
        .groupBy(*_KEY, *points.columns, *line_columns)
        .agg(F.sqrt(F.min(geo.distance_squared("x", "y"))).alias("distance"))
        .drop(*_KEY)
    )


def points_near(
    points: DataFrame,
    lines: DataFrame,
    radius: float,
    *,
    point_id: str | Sequence[str],
    closed: bool = False,
    negate: bool = False,
    cell: float | None = None,
) -> DataFrame:
    """The points with any line nearer than ``radius`` (``negate``: with none).

    A semi or anti join on the cell: a point is settled by its first match, no pairs are formed.
    """
    spread, copied, near = _point_cells(
        points, lines.select("geometry"), radius, _as_list(point_id), closed, cell
    )
    return _settled_by_first(spread, copied, near, "left_anti" if negate else "left_semi")


def _settled_by_first(spread: DataFrame, copied: DataFrame, near: Column, how: str) -> DataFrame:
    other = copied.withColumnsRenamed({c: f"_{c}" for c in _KEY})
    same = near
    for c in _KEY:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return spread.join(other, same, how).drop(*_KEY)


def _attach(
    points: DataFrame,
    lines: DataFrame,
    radius: float,
    point_id: str,
    line_id: str,
    how: str,
    closed: bool,
    cell: float | None,
) -> DataFrame:
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unknown join type {how!r}")
    spread, copied, near = _point_cells(points, lines, radius, [point_id], closed, cell)
    pairs = _pairs(spread, copied, near, points, lines)
    if how == "inner":
        return pairs
    # Rows without a match are found by a pass of their own over the cells, which carries keys only. An outer join on
    # the key would gather all matches of one key in a task, and storing the matches would write them with all columns.
    if how == "left":
        bare = _settled_by_first(spread, copied.select(*_KEY, *_SEGMENT), near, "left_anti")
    else:
        met = spread.select(*_KEY, "x", "y").join(copied.select(*_KEY, *_SEGMENT, line_id), _KEY).where(near)
        bare = lines.drop("geometry").join(met.select(line_id).distinct(), line_id, "left_anti")
    return pairs.unionByName(bare, allowMissingColumns=True)


def point_within_buffer_join(
    points: DataFrame,
    lines: DataFrame,
    radius: float,
    *,
    point_id: str,
    line_id: str,
    how: str = "inner",
    cell: float | None = None,
) -> DataFrame:
    """Points strictly inside the line buffers. ``right`` keeps lines without a point, ``left``
    points without a line. A point may belong to several lines."""
    return _attach(points, lines, radius, point_id, line_id, how, False, cell)


def point_intersects_buffer_join(
    points: DataFrame,
    lines: DataFrame,
    radius: float,
    *,
    point_id: str,
    line_id: str,
    how: str = "right",
    cell: float | None = None,
) -> DataFrame:
    """As ``point_within_buffer_join`` with the buffer's edge included."""
    return _attach(points, lines, radius, point_id, line_id, how, True, cell)


def _with_cover_interval(pairs: DataFrame, radius: float) -> DataFrame:
    """Add ``low`` and ``high``: for segment P(t) = p + t*u (columns a_x0..a_y1), the range of t
    in [0,1] within ``radius`` of segment ab (start x0, y0, unit direction wx, wy, ``length``);
    NULL when there is none.

    The neighbourhood of ab is convex (two discs and a rectangle), so the range is the hull of
    the ranges in the three shapes. P is written in positions along (s) and across (c) ab.
    """
    r = f"{radius + TOLERANCE}D"
    stages = [
        {
            "s0": "(a_x0 - x0) * wx + (a_y0 - y0) * wy",
            "s1": "(a_x1 - a_x0) * wx + (a_y1 - a_y0) * wy",
            "c0": "(a_y0 - y0) * wx - (a_x0 - x0) * wy",
            "c1": "(a_y1 - a_y0) * wx - (a_x1 - a_x0) * wy",
        },
        # a t^2 + 2 b t + c <= 0 inside the disc around either end of ab
        {
            "a": "s1 * s1 + c1 * c1",
            "b_a": "s1 * s0 + c1 * c0",
            "c_a": f"s0 * s0 + c0 * c0 - {r} * {r}",
            "b_b": "s1 * (s0 - length) + c1 * c0",
            "c_b": f"(s0 - length) * (s0 - length) + c0 * c0 - {r} * {r}",
        },
        {
            "root_a": "if(b_a * b_a >= a * c_a, sqrt(b_a * b_a - a * c_a), null)",
            "root_b": "if(b_b * b_b >= a * c_b, sqrt(b_b * b_b - a * c_b), null)",
            "l0": "try_divide(-s0, s1)",
            "l1": "try_divide(length - s0, s1)",
            "w0": f"try_divide(-{r} - c0, c1)",
            "w1": f"try_divide({r} - c0, c1)",
        },
        # Ranges of the three shapes, empty ones as [2, -1]. Without movement (a, s1 or c1 is
        # 0) a position is inside for all t or for none.
        {
            "low_a": "case when a > 0 then coalesce((-b_a - root_a) / a, 2) when c_a <= 0 then 0 else 2 end",
            "high_a": "case when a > 0 then coalesce((-b_a + root_a) / a, -1) when c_a <= 0 then 1 else -1 end",
            "low_b": "case when a > 0 then coalesce((-b_b - root_b) / a, 2) when c_b <= 0 then 0 else 2 end",
            "high_b": "case when a > 0 then coalesce((-b_b + root_b) / a, -1) when c_b <= 0 then 1 else -1 end",
            "low_l": "case when s1 <> 0 then least(l0, l1) when s0 between 0 and length then 0 else 2 end",
            "high_l": "case when s1 <> 0 then greatest(l0, l1) when s0 between 0 and length then 1 else -1 end",
            "low_w": f"case when c1 <> 0 then least(w0, w1) when abs(c0) <= {r} then 0 else 2 end",
            "high_w": f"case when c1 <> 0 then greatest(w0, w1) when abs(c0) <= {r} then 1 else -1 end",
        },
        {
            **{f"from_{e}": f"greatest(low_{e}, 0D)" for e in "ab"},
            **{f"to_{e}": f"least(high_{e}, 1D)" for e in "ab"},
            "from_c": "greatest(low_l, low_w, 0D)",
            "to_c": "least(high_l, high_w, 1D)",
        },
        {
            "low": "least(" + ", ".join(f"if(from_{e} <= to_{e}, from_{e}, null)" for e in "abc") + ")",
            "high": "greatest(" + ", ".join(f"if(from_{e} <= to_{e}, to_{e}, null)" for e in "abc") + ")",
        },
    ]
    for stage in stages:
        pairs = pairs.withColumns({name: F.expr(text) for name, text in stage.items()})
    return pairs


def line_within_buffer_pairs(
    inner: DataFrame,
    outer: DataFrame,
    radius: float,
    *,
    inner_id: str,
    outer_id: str,
    cell: float | None = None,
) -> DataFrame:
    """(inner_id, outer_id) for every inner line lying entirely within ``radius`` of the outer
    line. Both tables need their id and ``geometry``.

    For each segment of the inner line, the stretches near the segments of the outer line are
    sorted and merged; the line is inside when no segment keeps a gap. A vertex test would not
    do: vertices inside a buffer do not imply that the line between them is.
    """
    size = cell or max(cell_size(radius), 128.0)
    a = geo.explode_segments(
        inner.select(
            F.col(inner_id).alias("_inner"),
            F.size(geo.segments(F.col("geometry"))).alias("_total"),
            "geometry",
        )
    )
    a = with_covering_cells(a, size, 0.0).withColumnsRenamed(
        {"x0": "a_x0", "y0": "a_y0", "x1": "a_x1", "y1": "a_y1"}
    )
    b = geo.explode_segments(
        outer.select(F.col(outer_id).alias("_outer"), "geometry")
    ).drop("part", "pos")
    b = with_covering_cells(b, size, radius)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    b = b.withColumn("length", F.sqrt(dx * dx + dy * dy)).withColumns(
        {
            "wx": F.coalesce(F.try_divide(dx, F.col("length")), F.lit(1.0)),
            "wy": F.coalesce(F.try_divide(dy, F.col("length")), F.lit(0.0)),
        }
    )
    spread, copied = broadcast_or_spread(a, b, _CELL, ["_inner", "part", "pos"])
    segment = ["_inner", "_outer", "_total", "part", "pos"]
    # Segments far apart in a cell are dropped by their bounding boxes. Those near each other
    # without common stretch keep a NULL range, which adds nothing below; filtering on the range
    # instead would make the optimizer repeat its whole expression inside the join.
    reach = F.lit(radius + TOLERANCE)
    beside = [
        (F.least(f"a_{c}0", f"a_{c}1") <= F.greatest(f"{c}0", f"{c}1") + reach)
        & (F.greatest(f"a_{c}0", f"a_{c}1") >= F.least(f"{c}0", f"{c}1") - reach)
        for c in ("x", "y")
    ]
    stretches = _with_cover_interval(
        spread.join(copied, _KEY).where(beside[0] & beside[1]), radius
    ).select(*segment, "low", "high")
    # Gaps and islands: a gap opens where a stretch starts beyond everything seen so far. A
    # stretch met in several cells repeats, which leaves the union unchanged.
    before = (
        Window.partitionBy(*segment)
        .orderBy("low")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.coalesce(F.max("high").over(before), F.lit(0.0))
    covered = (
        stretches.withColumn("gap", F.col("low") > reached + F.lit(1e-9))
        .groupBy(*segment)
        .agg(F.bool_or("gap").alias("gap"), F.max("high").alias("high"))
        .where(~F.col("gap") & (F.col("high") >= 1 - 1e-9))
    )
    return (
        covered.groupBy("_inner", "_outer", "_total")
        .agg(F.count(F.lit(1)).alias("_covered"))
        .where(F.col("_covered") == F.col("_total"))
        .select(F.col("_inner").alias(inner_id), F.col("_outer").alias(outer_id))
    )


def line_within_buffer_join(
    inner: DataFrame,
    outer: DataFrame,
    radius: float,
    *,
    inner_id: str,
    outer_id: str,
    how: str = "inner",
    cell: float | None = None,
) -> DataFrame:
    """Attach the outer lines' columns to the inner lines they contain.

    ``left`` keeps inner lines without a container, ``right`` outer lines without content.
    """
    pairs = line_within_buffer_pairs(
        inner.select(inner_id, "geometry"), outer.select(outer_id, "geometry"), radius,
        inner_id=inner_id, outer_id=outer_id, cell=cell,
    )
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unknown join type {how!r}")
    a, b = inner.drop("geometry"), outer.drop("geometry")
    if how == "inner":
        return pairs.join(a, inner_id).join(b, outer_id)
    pairs = settle(pairs, "inside")  # two keys a row, read for the matches and for the lines without one
    rows, key = (a, inner_id) if how == "left" else (b, outer_id)
    bare = rows.join(pairs.select(key).distinct(), key, "left_anti")
    return pairs.join(a, inner_id).join(b, outer_id).unionByName(bare, allowMissingColumns=True)


def spatial_join_aggregate(
    streets: DataFrame,
    points: DataFrame,
    radius: float,
    aggregates: dict[str, str],
    *,
    street_id: str,
    point_id: str,
    cell: float | None = None,
) -> DataFrame:
    """Street table left-joined to the points in its buffers (edge included), one aggregate per
    point column. Grouping runs on the street key; the attributes are re-attached afterwards."""
    from curbline.operators.aggregates import group_agg_named

    needed = list(dict.fromkeys([point_id, "x", "y", *aggregates]))
    pairs = spatial_pairs(
        points.select(*needed), streets.select(street_id, "geometry"), radius,
        point_id=point_id, closed=True, cell=cell,
    )
    found = group_agg_named(pairs, [street_id], aggregates)
    joined = streets.join(found, street_id, "left")
    # sum and count of no values are 0, the other aggregates stay missing
    zero = {c: 0 for c, op in aggregates.items() if op in ("sum", "count")}
    return joined.fillna(zero) if zero else joined
