"""Street-network layers derived from the star-schema test tables.

The test tables hold no geometry, so coordinates are integer arithmetic on keys, exact in every
engine. A square of about 8,000 ft holds the rows of one key block; further blocks lie in
further squares, so the density of the network does not depend on the size of the tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

HORIZON = (datetime(1995, 1, 1), datetime(2001, 9, 1))
AS_OF = datetime(2001, 9, 1)

# Fixed values of the layout: side of a square, squares per row, and rows per square.
SQUARE = 8192
SQUARES_PER_ROW = 1024
BLOCK = {"part": 2000, "orders": 15000, "events": 10000, "customer": 1500, "supplier": 100}


# The columns used here, declared so that no file is opened to infer them.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "events": "event_id bigint",
    "lineitem": "l_suppkey bigint, l_quantity double, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _coordinate(k: str, a: int, b: int, m: int) -> str:
    """(k*k*a + k*b) mod m, reduced early so that large keys do not overflow."""
    return f"(({k} % {m}) * ({k} % {m}) % {m} * {a} + {k} % {m} * {b}) % {m}"


def _origin(k: str, block: int) -> tuple[str, str]:
    square = f"({k} div {block})"
    return f"{square} % {SQUARES_PER_ROW} * {SQUARE}", f"{square} div {SQUARES_PER_ROW} * {SQUARE}"


def _place(k: str, block: int) -> list[str]:
    ox, oy = _origin(k, block)
    return [
        f"cast({ox} + {_coordinate(k, 13, 4099, 8009)} as double) as x",
        f"cast({oy} + {_coordinate(k, 29, 5003, 8011)} as double) as y",
    ]


def _ends(k: str) -> list[str]:
    """Start sx, sy and extent dx, dy of a street."""
    ox, oy = _origin(k, BLOCK["part"])
    return [
        f"cast({ox} + {_coordinate(k, 31, 7919, 8009)} as double) as sx",
        f"cast({oy} + {_coordinate(k, 17, 6151, 8011)} as double) as sy",
        f"cast({k} * 37 % 601 - 300 as double) as dx",
        f"cast({k} * 53 % 601 - 300 as double) as dy",
    ]


def _line(x0: str, y0: str, x1: str, y1: str) -> str:
    """A line of one part with two vertices."""
    return f"array(array(struct({x0} as x, {y0} as y), struct({x1} as x, {y1} as y))) as geometry"


def all_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every centreline row, before the street filter."""
    return _table(spark, sf_dir, "part").selectExpr("*", *_ends("p_partkey")).selectExpr(
        "p_partkey as physicalid",
        _line("sx", "sy", "sx + dx", "sy + dy"),
        "sqrt(dx * dx + dy * dy) as shape_leng",
        "if(p_brand in ('Brand#3', 'Brand#13', 'Brand#23'), '2', '1') as rw_type",
        "if(p_partkey % 17 <> 0, cast(p_size % 40 as double), null) as st_width",
        "if(p_partkey % 5 = 0, cast(p_partkey % 3 + 1 as string), null) as bike_lane",
        "case p_partkey % 3 when 0 then 'TF' when 1 then 'TW' else 'FT' end as trafdir",
        "case p_type when 'ECONOMY' then 'AVE' when 'PROMO' then 'BLVD' when 'STANDARD' then 'ST' "
        "when 'MEDIUM' then 'RD' when 'SMALL' then 'ROAD' end as post_type",
        "if(p_brand = 'Brand#1', 'AVE', null) as pre_type",
        "case p_partkey % 50 when 0 then 'BROADWAY' when 1 then 'BOWERY' else p_name end as st_name",
    )


# Vertices of a path by its kind, the remainder of its key by 4. Part, and x and y as multiples of dx, dy and 1
# from the street's start: a corner, a closed ring, two parts side by side, two parts meeting at an end.
PATH_VERTICES = {
    0: [(0, (0, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 1, 0))],
    1: [(0, (0, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 1, 0)), (0, (0, 0, 0), (0, 1, 0)),
        (0, (0, 0, 0), (0, 0, 0))],
    2: [(0, (0, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 1, 0)), (1, (0, 0, 40), (0, 0, 40)), (1, (0, 1, 40), (-1, 0, 40))],
    3: [(0, (0, 0, 0), (0, 0, 0)), (0, (1, 0, 0), (0, 1, 0)), (1, (1, 0, 0), (0, 1, 0)), (1, (1, -1, 0), (1, 1, 0))],
}
#: Where a third of the crowd stands; the first path begins next to it.
HOT_SITE = (7953, 6172)


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of several segments and parts, some of them closed."""
    def geometry(vertices: list) -> str:
        parts: dict[int, list[str]] = {}
        for part, x, y in vertices:
            place = (f"{start} + {a} * dx + {b} * dy + {c}" for start, (a, b, c) in (("sx", x), ("sy", y)))
            parts.setdefault(part, []).append("struct({} as x, {} as y)".format(*place))
        return f"array({', '.join(f'array({chr(44).join(p)})' for p in parts.values())})"

    kinds = " ".join(f"when {kind} then {geometry(v)}" for kind, v in PATH_VERTICES.items())
    return _table(spark, sf_dir, "part").selectExpr("p_partkey as physicalid", *_ends("p_partkey")).selectExpr(
        "physicalid", f"case physicalid % 4 {kinds} end as geometry"
    )


def crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of which a third stand in one place and a tenth around it, in a cell or two."""
    x, y = HOT_SITE
    return _table(spark, sf_dir, "orders").selectExpr("o_orderkey as point_id", *_place("o_orderkey", BLOCK["orders"])).selectExpr(
        "point_id",
        f"case when point_id % 3 = 0 then {x}D when point_id % 7 = 0 then {x}D + point_id % 50 - 25 else x end as x",
        f"case when point_id % 3 = 0 then {y}D when point_id % 7 = 0 then {y}D + point_id % 40 - 20 else y end as y",
    )


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as collision_id",
        "o_orderdate as crash_date",
        "cast(o_orderkey % 24 as int) as crash_hour",
        *_place("o_orderkey", BLOCK["orders"]),
        "if(o_custkey % 11 <> 0, o_custkey % 3, null) as number_of_pedestrians_injured",
        "cast(o_custkey % 29 = 0 as bigint) as number_of_pedestrians_killed",
    )


def raw_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash records as they are delivered: text dates and times, coordinates partly missing."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as collision_id",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00.000') as crash_date",
        "concat(o_orderkey % 24, ':', lpad(cast(o_orderkey % 60 as string), 2, '0')) as crash_time",
        "if(o_orderkey % 10 <> 0, 40.5D + (o_orderkey * 7919 % 4001) / 10000D, null) as latitude",
        "if(o_orderkey % 10 <> 0, -74.25D + (o_orderkey * 6151 % 5503) / 10000D, null) as longitude",
        "if(o_custkey % 11 <> 0, o_custkey % 3, null) as persons_injured",
        "cast(o_custkey % 29 = 0 as bigint) as persons_killed",
        "o_orderpriority as on_street_name",
        "if(o_orderkey % 4 <> 0, o_orderstatus, null) as cross_street_name",
        "case o_orderkey % 3 when 1 then '  ' when 2 then o_orderpriority end as off_street_name",
    )


def speedhumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hump lines: a street lengthened by a tenth at both ends and shifted sideways."""
    owners = _table(spark, sf_dir, "customer").where("c_mktsegment in ('HOUSEHOLD', 'FURNITURE')")
    parts = _table(spark, sf_dir, "part").selectExpr("p_partkey as c_custkey")
    return (
        owners.join(parts, "c_custkey")
        .selectExpr("c_custkey as hump_id", *_ends("c_custkey"), "c_custkey % 101 - 50 as shift")
        .where("dx <> 0 or dy <> 0")
        .selectExpr(
            "hump_id",
            _line("sx - dx / 10", "sy - dy / 10 + shift", "sx + dx + dx / 10", "sy + dy + dy / 10 + shift"),
            "hump_id % 4 + 1 as humps",
            "sqrt(dx * dx + dy * dy) * 1.2D as shape_leng",
            "timestampadd(DAY, cast(hump_id * 97 % 2400 as int), timestamp_ntz'1995-01-01') as date_insta",
        )
    )


def speedlimits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed-limit lines: the middle half of a street, shifted sideways."""
    return (
        _table(spark, sf_dir, "part")
        .where("p_type in ('ECONOMY', 'LARGE')")
        .selectExpr("p_partkey as limit_id", *_ends("p_partkey"), "p_partkey % 101 - 50 as shift")
        .selectExpr(
            "limit_id",
            _line("sx + dx / 4", "sy + dy / 4 + shift", "sx + dx * 3 / 4", "sy + dy * 3 / 4 + shift"),
            "cast(limit_id % 4 * 5 + 20 as double) as postvz_sl",
        )
    )


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id as tree_id", *_place("event_id", BLOCK["events"])
    )


def parking_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as meter_id", *_place("c_custkey", BLOCK["customer"])
    )


def traffic_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as site_id",
        *_place("l_suppkey", BLOCK["supplier"]),
        "year(l_shipdate) as yr",
        "month(l_shipdate) as m",
        "day(l_shipdate) as d",
        "l_quantity as vol",
    )


def _sql_coordinate(k: str, a: int, b: int, m: int) -> str:
    return f"((({k}) % {m}) * (({k}) % {m}) % {m} * {a} + (({k}) % {m}) * {b}) % {m}"


def _sql_origin(k: str, block: int) -> tuple[str, str]:
    square = f"(({k}) // {block})"
    return f"{square} % {SQUARES_PER_ROW} * {SQUARE}", f"{square} // {SQUARES_PER_ROW} * {SQUARE}"


def _sql_place(k: str, block: int) -> str:
    ox, oy = _sql_origin(k, block)
    return (
        f"CAST({ox} + {_sql_coordinate(k, 13, 4099, 8009)} AS DOUBLE) AS x, "
        f"CAST({oy} + {_sql_coordinate(k, 29, 5003, 8011)} AS DOUBLE) AS y"
    )


def _sql_ends(k: str) -> str:
    ox, oy = _sql_origin(k, BLOCK["part"])
    return (
        f"CAST({ox} + {_sql_coordinate(k, 31, 7919, 8009)} AS DOUBLE) AS sx, "
        f"CAST({oy} + {_sql_coordinate(k, 17, 6151, 8011)} AS DOUBLE) AS sy, "
        f"CAST(({k}) * 37 % 601 - 300 AS DOUBLE) AS dx, CAST(({k}) * 53 % 601 - 300 AS DOUBLE) AS dy"
    )


def sql_distance_squared(p: str, s: str) -> str:
    """Squared distance of point alias ``p`` (x, y) from segment alias ``s`` (x0..y1)."""
    ex, ey = f"({p}.x - {s}.x0)", f"({p}.y - {s}.y0)"
    dx, dy = f"({s}.x1 - {s}.x0)", f"({s}.y1 - {s}.y0)"
    along = f"({ex} * {dx} + {ey} * {dy})"
    return (
        f"CASE WHEN {along} <= 0 THEN {ex} * {ex} + {ey} * {ey} "
        f"WHEN {along} >= {dx} * {dx} + {dy} * {dy} "
        f"THEN ({p}.x - {s}.x1) * ({p}.x - {s}.x1) + ({p}.y - {s}.y1) * ({p}.y - {s}.y1) "
        f"ELSE ({ey} * {dx} - {ex} * {dy}) * ({ey} * {dx} - {ex} * {dy}) / ({dx} * {dx} + {dy} * {dy}) END"
    )


# The same layers for the SQL side. Lines are single segments x0, y0, x1, y1 there.
SQL_LAYERS: dict[str, str] = {
    "all_streets": f"""
        SELECT physicalid, sx AS x0, sy AS y0, sx + dx AS x1, sy + dy AS y1,
               sqrt(dx * dx + dy * dy) AS shape_leng, rw_type, st_width, bike_lane, trafdir,
               post_type, pre_type, st_name
        FROM (SELECT p_partkey AS physicalid, {_sql_ends('p_partkey')},
                CASE WHEN p_brand IN ('Brand#3', 'Brand#13', 'Brand#23') THEN '2' ELSE '1' END AS rw_type,
                CASE WHEN p_partkey % 17 <> 0 THEN CAST(p_size % 40 AS DOUBLE) END AS st_width,
                CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey % 3 + 1 AS VARCHAR) END AS bike_lane,
                CASE p_partkey % 3 WHEN 0 THEN 'TF' WHEN 1 THEN 'TW' ELSE 'FT' END AS trafdir,
                CASE p_type WHEN 'ECONOMY' THEN 'AVE' WHEN 'PROMO' THEN 'BLVD' WHEN 'STANDARD' THEN 'ST'
                     WHEN 'MEDIUM' THEN 'RD' WHEN 'SMALL' THEN 'ROAD' END AS post_type,
                CASE WHEN p_brand = 'Brand#1' THEN 'AVE' END AS pre_type,
                CASE p_partkey % 50 WHEN 0 THEN 'BROADWAY' WHEN 1 THEN 'BOWERY' ELSE p_name END AS st_name
              FROM part)""",
    "streets": "SELECT * FROM all_streets WHERE rw_type = '1' AND shape_leng > 80",
    "crashes": f"""
        SELECT o_orderkey AS collision_id, o_orderdate AS crash_date,
               CAST(o_orderkey % 24 AS INTEGER) AS crash_hour, {_sql_place('o_orderkey', BLOCK['orders'])},
               CASE WHEN o_custkey % 11 <> 0 THEN o_custkey % 3 END AS number_of_pedestrians_injured,
               CAST(o_custkey % 29 = 0 AS BIGINT) AS number_of_pedestrians_killed
        FROM orders""",
    "raw_crashes": """
        SELECT o_orderkey AS collision_id, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000' AS crash_date,
               CAST(o_orderkey % 24 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS crash_time,
               CASE WHEN o_orderkey % 10 <> 0 THEN CAST(40.5 AS DOUBLE) + CAST(o_orderkey * 7919 % 4001 AS DOUBLE) / 10000 END AS latitude,
               CASE WHEN o_orderkey % 10 <> 0 THEN CAST(-74.25 AS DOUBLE) + CAST(o_orderkey * 6151 % 5503 AS DOUBLE) / 10000 END AS longitude,
               CASE WHEN o_custkey % 11 <> 0 THEN o_custkey % 3 END AS persons_injured,
               CAST(o_custkey % 29 = 0 AS BIGINT) AS persons_killed,
               o_orderpriority AS on_street_name,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS cross_street_name,
               CASE o_orderkey % 3 WHEN 1 THEN '  ' WHEN 2 THEN o_orderpriority END AS off_street_name
        FROM orders""",
    "speedhumps": f"""
        SELECT hump_id, sx - dx / 10 AS x0, sy - dy / 10 + shift AS y0,
               sx + dx + dx / 10 AS x1, sy + dy + dy / 10 + shift AS y1, hump_id % 4 + 1 AS humps,
               sqrt(dx * dx + dy * dy) * CAST(1.2 AS DOUBLE) AS shape_leng,
               TIMESTAMP '1995-01-01' + to_days(CAST(hump_id * 97 % 2400 AS INTEGER)) AS date_insta
        FROM (SELECT c_custkey AS hump_id, {_sql_ends('c_custkey')}, c_custkey % 101 - 50 AS shift
              FROM customer JOIN part ON p_partkey = c_custkey
              WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE'))
        WHERE dx <> 0 OR dy <> 0""",
    "speedlimits": f"""
        SELECT limit_id, sx + dx / 4 AS x0, sy + dy / 4 + shift AS y0,
               sx + dx * 3 / 4 AS x1, sy + dy * 3 / 4 + shift AS y1,
               CAST(limit_id % 4 * 5 + 20 AS DOUBLE) AS postvz_sl
        FROM (SELECT p_partkey AS limit_id, {_sql_ends('p_partkey')}, p_partkey % 101 - 50 AS shift
              FROM part WHERE p_type IN ('ECONOMY', 'LARGE'))""",
    "path_vertices": f"""
        SELECT physicalid, part, pos, sx + xa * dx + xb * dy + xc AS x, sy + ya * dx + yb * dy + yc AS y
        FROM (SELECT p_partkey AS physicalid, {_sql_ends('p_partkey')} FROM part)
        JOIN (VALUES {", ".join(
            f"({kind}, {part}, {pos}, {', '.join(map(str, x + y))})"
            for kind, vertices in PATH_VERTICES.items() for pos, (part, x, y) in enumerate(vertices))})
          v(kind, part, pos, xa, xb, xc, ya, yb, yc) ON physicalid % 4 = kind""",
    "path_segments": """
        SELECT * FROM (SELECT physicalid, part, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1
                       FROM path_vertices WINDOW w AS (PARTITION BY physicalid, part ORDER BY pos)) WHERE x1 IS NOT NULL""",
    "path_ends": """
        SELECT physicalid, x, y FROM (
            SELECT physicalid, arg_min(x, pos) AS x, arg_min(y, pos) AS y FROM path_vertices GROUP BY physicalid, part
            UNION ALL SELECT physicalid, arg_max(x, pos), arg_max(y, pos) FROM path_vertices GROUP BY physicalid, part)
        GROUP BY ALL HAVING count(*) % 2 = 1""",
    "crowd": f"""
        SELECT point_id,
               CASE WHEN point_id % 3 = 0 THEN {HOT_SITE[0]} WHEN point_id % 7 = 0 THEN {HOT_SITE[0]} + point_id % 50 - 25 ELSE x END AS x,
               CASE WHEN point_id % 3 = 0 THEN {HOT_SITE[1]} WHEN point_id % 7 = 0 THEN {HOT_SITE[1]} + point_id % 40 - 20 ELSE y END AS y
        FROM (SELECT o_orderkey AS point_id, {_sql_place('o_orderkey', BLOCK['orders'])} FROM orders)""",
    "trees": f"SELECT event_id AS tree_id, {_sql_place('event_id', BLOCK['events'])} FROM events",
    "parking_meters": f"SELECT c_custkey AS meter_id, {_sql_place('c_custkey', BLOCK['customer'])} FROM customer",
    "traffic_volumes": f"""
        SELECT l_suppkey AS site_id, {_sql_place('l_suppkey', BLOCK['supplier'])},
               CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(month(l_shipdate) AS INTEGER) AS m,
               CAST(day(l_shipdate) AS INTEGER) AS d, l_quantity AS vol
        FROM lineitem""",
}

_NEEDS = {"streets": ["all_streets"], "path_segments": ["path_vertices"], "path_ends": ["path_vertices"]}


def with_layers(layers: str | list[str], body: str, **ctes: str) -> str:
    """``body`` with the named layers (and then ``ctes``) in a WITH clause."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in layers.split() if isinstance(layers, str) else layers:
        add(name)
    clauses = [f"{n} AS ({SQL_LAYERS[n]})" for n in wanted] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH RECURSIVE {', '.join(clauses)}\n{body}" if clauses else body
