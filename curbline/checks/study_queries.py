"""Layer loading and the crash studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.feature_queries import WEEKS, rounded, sql_rounded
from curbline.checks.geometry_queries import (
    SITES_SQL,
    _DISCS_CTE,
    _ENDS_CTE,
    _projection_sql,
    limit_points,
    sql_contained,
    sql_near,
)
from curbline.checks.registry import query
from curbline.checks.table_queries import BLANK, H1, UNLOCATED
from curbline.functions import geometry as geo
from curbline.operators.stats import correlation_matrix
from curbline.plans import augmentation as au
from curbline.plans import crash_studies as cs
from curbline.plans import hump_effect as he
from curbline.plans import layers as ly
from curbline.session import settle


@query("load_crash_points", fx.with_layers("raw_crashes", f"""
    SELECT collision_id, persons_injured, {_projection_sql('longitude', 'latitude')},
           CAST(split_part(crash_date, 'T', 1) AS TIMESTAMP) + to_hours(CAST(split_part(crash_time, ':', 1) AS INTEGER))
             + to_minutes(CAST(split_part(crash_time, ':', 2) AS INTEGER)) AS datetime
    FROM raw_crashes WHERE latitude IS NOT NULL AND crash_date >= '1997'"""))
def _(spark, sf_dir):
    points = ly.load_crash_points(
        fx.raw_crashes(spark, sf_dir), from_year=1997, extra_columns=["persons_injured"]
    )
    return rounded(points, {"x": 3, "y": 3})


@query("load_street_lines", fx.with_layers("all_streets", """
    SELECT min(physicalid) AS physicalid, arg_min_null(st_width, physicalid) AS st_width, x0, y0, x1, y1
    FROM all_streets WHERE rw_type = '1' GROUP BY x0, y0, x1, y1"""))
def _(spark, sf_dir):
    lines = ly.load_street_lines(fx.all_streets(spark, sf_dir), ["st_width"])
    a, b = F.col("geometry")[0][0], F.col("geometry")[0][1]
    return lines.select(
        "physicalid", "st_width", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")
    )


@query("load_hump_centroids", fx.with_layers("speedhumps", """
    SELECT CAST(sum(humps) AS DOUBLE) AS humps, min(date_insta) AS date_insta,
           round((x0 + x1) / 2, 6) AS x, round((y0 + y1) / 2, 6) AS y FROM speedhumps GROUP BY x0, y0, x1, y1"""))
def _(spark, sf_dir):
    return rounded(ly.load_hump_centroids(fx.speedhumps(spark, sf_dir)), {"x": 6, "y": 6})


@query("load_limit_centroids", fx.with_layers("speedlimits", """
    SELECT avg(postvz_sl) AS postvz_sl, round((x0 + x1) / 2, 6) AS x, round((y0 + y1) / 2, 6) AS y
    FROM speedlimits GROUP BY x0, y0, x1, y1"""))
def _(spark, sf_dir):
    return rounded(ly.load_limit_centroids(fx.speedlimits(spark, sf_dir)), {"x": 6, "y": 6})


@query("load_tree_points", fx.with_layers("trees", "SELECT tree_id, x, y FROM trees"))
def _(spark, sf_dir):
    return ly.load_tree_points(fx.trees(spark, sf_dir))


# Crashes on hump roads, one row per crash, street and hump line, as the study counts them.
_HUMP_CTES = {
    "contained": sql_contained("all_streets", "physicalid", "speedhumps", "hump_id", 25.0),
    "roads": "SELECT c.physicalid, count(*) AS hump_lines, CAST(max(h.humps) AS DOUBLE) AS humps, "
             "max(h.shape_leng) AS shape_leng, max(h.date_insta) AS date_insta FROM contained c "
             "JOIN speedhumps h ON c.hump_id = h.hump_id GROUP BY 1",
    "pairs": sql_near("crashes", "all_streets", 25.0),
    "found": "SELECT p.physicalid, p.collision_id, p.crash_date, p.shape_leng AS road_leng, r.humps, r.shape_leng, "
             "r.date_insta, coalesce(number_of_pedestrians_injured, 0) AS injured, "
             "coalesce(number_of_pedestrians_killed, 0) AS killed "
             "FROM pairs p JOIN contained c ON c.physicalid = p.physicalid JOIN roads r ON r.physicalid = p.physicalid",
    "first": "SELECT min(crash_date) AS first_crash FROM found",
    "windowed": f"SELECT *, date_insta < crash_date AS after_humps FROM found, first "
                f"WHERE date_insta > first_crash + INTERVAL 365 DAY AND date_insta < {H1} - INTERVAL 365 DAY",
}
_RATE_WEEKS = (
    f"CASE WHEN after_humps THEN {WEEKS.format(a='date_insta', b=H1)} "
    f"ELSE {WEEKS.format(a='first_crash', b='date_insta')} END"
)


def _per_road_ctes(pedestrians: bool) -> dict[str, str]:
    measures = {"collisions": "count(*)"}
    rated = ["collisions"]
    if pedestrians:
        measures = {
            "number_of_pedestrians_injured": "CAST(sum(injured) AS BIGINT)",
            "number_of_pedestrians_killed": "CAST(sum(killed) AS BIGINT)",
            "pedestrians_involved": "CAST(sum(injured + killed) AS BIGINT)",
            "collisions": "count(*)",
        }
        rated = ["collisions", "pedestrians_involved"]
    rows = "windowed WHERE injured + killed > 0" if pedestrians else "windowed"
    sums = ", ".join(f"{m} AS {n}" for n, m in measures.items())
    filled = ", ".join(f"coalesce(c.{n}, 0) AS {n}" for n in measures)
    rates = ", ".join(f"coalesce(c.{n} / c.weeks, 0) AS {n}_per_week" for n in rated)
    return {
        **_HUMP_CTES,
        "counts": f"SELECT physicalid, humps, shape_leng, road_leng, date_insta, after_humps, "
                  f"any_value({_RATE_WEEKS}) AS weeks, {sums} FROM {rows} GROUP BY 1, 2, 3, 4, 5, 6",
        "per_road": f"SELECT r.*, f.after_humps, {filled}, {rates} "
                    "FROM (SELECT DISTINCT physicalid, humps, shape_leng, road_leng, date_insta FROM counts) r "
                    "CROSS JOIN (SELECT false AS after_humps UNION ALL SELECT true) f "
                    "LEFT JOIN counts c ON c.physicalid = r.physicalid AND c.after_humps = f.after_humps",
        "difference": "SELECT b.physicalid, b.humps, b.shape_leng, "
                      + ", ".join(f"b.{n}_per_week AS {n}_per_week_before, a.{n}_per_week AS {n}_per_week_after" for n in rated)
                      + " FROM per_road b JOIN per_road a ON a.physicalid = b.physicalid AND a.humps = b.humps "
                        "AND a.shape_leng = b.shape_leng WHERE a.after_humps AND NOT b.after_humps",
    }


_HUMP_LAYERS = "all_streets speedhumps crashes"
_ROAD_ROUND = {"shape_leng": 6, "road_leng": 6, "collisions_per_week": 6}
_WALK_ROUND = {**_ROAD_ROUND, "pedestrians_involved_per_week": 6}


def _found(spark, sf_dir):
    return he.hump_road_crashes(
        fx.crashes(spark, sf_dir), fx.all_streets(spark, sf_dir), fx.speedhumps(spark, sf_dir), as_of=fx.AS_OF
    )


@query("hump_effect_before_after", fx.with_layers(
    _HUMP_LAYERS, f"SELECT * REPLACE ({sql_rounded(_ROAD_ROUND)}) FROM per_road", **_per_road_ctes(False)))
def _(spark, sf_dir):
    return rounded(he.crashes_per_road(_found(spark, sf_dir), as_of=fx.AS_OF), _ROAD_ROUND)


@query("hump_effect_pedestrians", fx.with_layers(
    _HUMP_LAYERS, f"SELECT * REPLACE ({sql_rounded(_WALK_ROUND)}) FROM per_road", **_per_road_ctes(True)))
def _(spark, sf_dir):
    per_road = he.crashes_per_road(_found(spark, sf_dir), as_of=fx.AS_OF, pedestrians=True)
    return rounded(per_road, _WALK_ROUND)


def difference(spark, sf_dir, pedestrians=False):
    per_road = he.crashes_per_road(_found(spark, sf_dir), as_of=fx.AS_OF, pedestrians=pedestrians)
    return he.crashes_difference(per_road)


_DIFF_ROUND = {"shape_leng": 6, "collisions_per_week_before": 6, "collisions_per_week_after": 6}


@query("crashes_difference", fx.with_layers(
    _HUMP_LAYERS, f"SELECT * REPLACE ({sql_rounded(_DIFF_ROUND)}) FROM difference", **_per_road_ctes(False)))
def _(spark, sf_dir):
    return rounded(difference(spark, sf_dir), _DIFF_ROUND)


@query("simple_regression_slope", fx.with_layers(
    _HUMP_LAYERS, """
    SELECT count(*) AS streets, round(regr_slope(collisions_per_week_after, collisions_per_week_before), 6) AS slope,
           round(regr_intercept(collisions_per_week_after, collisions_per_week_before), 6) AS intercept,
           round(corr(collisions_per_week_after, collisions_per_week_before), 6) AS correlation
    FROM difference""", **_per_road_ctes(False)))
def _(spark, sf_dir):
    return rounded(he.hump_effect(difference(spark, sf_dir)), {"slope": 6, "intercept": 6, "correlation": 6})


_RATES = [f"{r}_per_week_{w}" for r in ("collisions", "pedestrians_involved") for w in ("before", "after")]


@query("correlation_matrix", fx.with_layers(
    _HUMP_LAYERS,
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM difference"
        for a in _RATES for b in _RATES),
    **_per_road_ctes(True)))
def _(spark, sf_dir):
    matrix = correlation_matrix(difference(spark, sf_dir, pedestrians=True), _RATES)
    return rounded(matrix, {"correlation": 6})


def _hourly_points(spark, sf_dir):
    humps = fx.speedhumps(spark, sf_dir)
    centres = humps.select("hump_id", "humps", "date_insta", F.inline(F.array(geo.centroid(F.col("geometry")))))
    crashes = fx.crashes(spark, sf_dir).select(
        "collision_id", "x", "y",
        F.timestamp_add("HOUR", F.col("crash_hour"), F.col("crash_date")).alias("datetime"),
    )
    return centres, crashes


HOURLY_CTES = {
    "limit_points": "SELECT limit_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, postvz_sl FROM speedlimits",
    "hump_points": "SELECT hump_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, humps, date_insta FROM speedhumps",
    "timed": "SELECT collision_id, x, y, crash_date + to_hours(crash_hour) AS datetime FROM crashes",
    "lines": "SELECT min(physicalid) AS physicalid, x0, y0, x1, y1 FROM all_streets GROUP BY x0, y0, x1, y1",
    "limit_pairs": sql_near("limit_points", "lines", 32.0, "<="),
    "hump_pairs": sql_near("hump_points", "lines", 32.0, "<="),
    "crash_pairs": sql_near("timed", "lines", 32.0, "<="),
    "usual": "SELECT postvz_sl FROM limit_pairs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    "months": "SELECT CAST(count(*) AS DOUBLE) AS n FROM (SELECT DISTINCT month(datetime), year(datetime) FROM crash_pairs)",
    "hourly": "SELECT physicalid, CAST(hour(datetime) AS INTEGER) AS hour, count(*) AS n FROM crash_pairs GROUP BY 1, 2",
}


@query("crashes_by_street_hour", fx.with_layers(
    "all_streets speedlimits speedhumps crashes", """
    SELECT s.physicalid, s.rw_type, s.bike_lane, round(s.shape_leng, 6) AS shape_leng, s.trafdir, s.st_width,
           round(coalesce(l.postvz_sl, (SELECT postvz_sl FROM usual)), 6) AS postvz_sl,
           CAST(coalesce(h.humps, 0) AS DOUBLE) AS humps, c.hour,
           round(coalesce(c.n, 0) / (SELECT n FROM months), 6) AS crashes
    FROM all_streets s JOIN lines g ON g.physicalid = s.physicalid
    LEFT JOIN (SELECT physicalid, avg(postvz_sl) AS postvz_sl FROM limit_pairs GROUP BY 1) l ON l.physicalid = s.physicalid
    LEFT JOIN (SELECT physicalid, sum(humps) AS humps FROM hump_pairs GROUP BY 1) h ON h.physicalid = s.physicalid
    LEFT JOIN hourly c ON c.physicalid = s.physicalid""", **HOURLY_CTES))
def _(spark, sf_dir):
    return rounded(hourly_table(spark, sf_dir), {"shape_leng": 6, "postvz_sl": 6, "crashes": 6})


def hourly_table(spark, sf_dir, keep_key=False):
    humps, crashes = _hourly_points(spark, sf_dir)
    profile = settle(
        cs.street_profile(fx.all_streets(spark, sf_dir), limit_points(spark, sf_dir), humps), "profile"
    )
    return cs.crashes_by_street_hour(profile, crashes, keep_key=keep_key)


@query("mid_block_crashes", fx.with_layers(
    "all_streets speedlimits speedhumps crashes trees", """
    SELECT p.collision_id, p.x, p.y, p.datetime, p.physicalid, round(s.shape_leng, 6) AS shape_leng, s.st_width,
           CAST(coalesce(h.humps, 0) AS BIGINT) AS humps, h.date_insta, l.postvz_sl, coalesce(t.n, 0) AS trees
    FROM crash_pairs p JOIN all_streets s ON s.physicalid = p.physicalid
    LEFT JOIN (SELECT physicalid, sum(humps) AS humps, min(date_insta) AS date_insta FROM hump_pairs GROUP BY 1) h
      ON h.physicalid = p.physicalid
    LEFT JOIN (SELECT physicalid, round(avg(postvz_sl), 6) AS postvz_sl FROM limit_pairs GROUP BY 1) l
      ON l.physicalid = p.physicalid
    LEFT JOIN (SELECT physicalid, count(*) AS n FROM tree_pairs GROUP BY 1) t ON t.physicalid = p.physicalid
    WHERE p.collision_id NOT IN (SELECT collision_id FROM at_ends)""",
    **{**HOURLY_CTES,
       "lines": "SELECT min(physicalid) AS physicalid, x0, y0, x1, y1 FROM all_streets WHERE rw_type = '1' "
                "GROUP BY x0, y0, x1, y1",
       "tree_pairs": sql_near("trees", "lines", 32.0, "<="),
       "ends": _ENDS_CTE.replace("FROM streets", "FROM lines"), "discs": _DISCS_CTE,
       "at_ends": sql_near("timed", "discs", 32.0)}))
def _(spark, sf_dir):
    humps, crashes = _hourly_points(spark, sf_dir)
    found = cs.mid_block_crashes(
        crashes, fx.all_streets(spark, sf_dir), 32.0,
        humps=humps, limits=limit_points(spark, sf_dir), trees=fx.trees(spark, sf_dir),
    )
    return rounded(found, {"shape_leng": 6, "postvz_sl": 6})


@query("crash_location_gaps", fx.with_layers("raw_crashes", f"""
    SELECT collision_id, CASE WHEN off_street_name IS NOT NULL AND NOT {BLANK} THEN 'off_street' ELSE 'cross_street' END AS list
    FROM rows WHERE (off_street_name IS NOT NULL AND NOT {BLANK})
       OR (cross_street_name IS NOT NULL AND on_street_name IS NOT NULL)""", rows=UNLOCATED))
def _(spark, sf_dir):
    off, cross = cs.crash_location_gaps(fx.raw_crashes(spark, sf_dir))
    return off.select("collision_id", F.lit("off_street").alias("list")).unionByName(
        cross.select("collision_id", F.lit("cross_street").alias("list"))
    )


AUGMENTATION_CTES = {
    **_per_road_ctes(False),
    "sites": SITES_SQL,
    "hump_lines_geo": "SELECT s.physicalid, s.x0, s.y0, s.x1, s.y1 FROM all_streets s "
                      "WHERE physicalid IN (SELECT physicalid FROM difference)",
    "ranked_sites": f"SELECT s.physicalid, p.vol, row_number() OVER (PARTITION BY s.physicalid ORDER BY "
                    f"greatest(0, sqrt({fx.sql_distance_squared('p', 's')}) - 25), p.site_id) AS n "
                    "FROM hump_lines_geo s CROSS JOIN sites p",
    "limit_found": sql_contained("speedlimits", "limit_id", "hump_lines_geo", "physicalid", 25.0),
    "limit_values": "SELECT c.physicalid, l.postvz_sl FROM limit_found c JOIN speedlimits l ON l.limit_id = c.limit_id",
    "tree_pairs": sql_near("trees", "hump_lines_geo", 40.0),
    "augmented": """
        SELECT d.*, CAST(coalesce(s.bike_lane, '0') AS DOUBLE) AS bike_lane, s.shape_leng AS road_leng, s.st_width,
               v.vol, coalesce(l.postvz_sl, (SELECT postvz_sl FROM limit_values GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))
                 AS speed_limit, coalesce(t.n, 0) AS tree_count
        FROM difference d JOIN all_streets s ON s.physicalid = d.physicalid
        JOIN ranked_sites v ON v.physicalid = d.physicalid AND v.n = 1
        LEFT JOIN (SELECT physicalid, avg(postvz_sl) AS postvz_sl FROM limit_values GROUP BY 1) l ON l.physicalid = d.physicalid
        LEFT JOIN (SELECT physicalid, count(*) AS n FROM tree_pairs GROUP BY 1) t ON t.physicalid = d.physicalid
        WHERE s.st_width IS NOT NULL""",
}
AUGMENTATION_LAYERS = "all_streets speedhumps crashes traffic_volumes speedlimits trees"


def augmented(spark, sf_dir):
    return au.hump_augmentation_dataset(
        settle(difference(spark, sf_dir), "difference"), fx.all_streets(spark, sf_dir),
        fx.traffic_volumes(spark, sf_dir), fx.speedlimits(spark, sf_dir), fx.trees(spark, sf_dir),
    )


_AUG_ROUND = {**_DIFF_ROUND, "road_leng": 6, "vol": 6, "speed_limit": 6}


@query("hump_augmentation_dataset", fx.with_layers(
    AUGMENTATION_LAYERS, f"SELECT * REPLACE ({sql_rounded(_AUG_ROUND)}) FROM augmented", **AUGMENTATION_CTES))
def _(spark, sf_dir):
    return rounded(augmented(spark, sf_dir), _AUG_ROUND)
