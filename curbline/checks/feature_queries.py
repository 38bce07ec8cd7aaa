"""Features per street and the street collision table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.geometry_queries import (
    COMPONENT_CTES,
    RADIUS,
    limit_points,
    sql_contained,
    sql_near,
    streets,
)
from curbline.checks.registry import query
from curbline.checks.table_queries import H0, H1, STREET_TYPES_SQL
from curbline.operators import intervals as iv
from curbline.operators import point_features as pf
from curbline.operators.point_features import PointFeature
from curbline.plans import hump_effect as he
from curbline.plans import street_dataset as sd

SETTINGS = sd.Settings(
    horizon=fx.HORIZON, window=(datetime(1996, 1, 1), datetime(2001, 3, 1)), radius=RADIUS
)

# Interval rows of the streets lying in the buffer of a hump line.
INTERVAL_CTES = {
    "contained": sql_contained("streets", "physicalid", "speedhumps", "hump_id", RADIUS),
    "installed": "SELECT c.physicalid, max(h.date_insta) AS installed FROM contained c "
                 "JOIN speedhumps h ON c.hump_id = h.hump_id GROUP BY 1",
    "intervals": f"""
        SELECT s.physicalid, coalesce(i.installed, {H0}) AS after, {H1} AS until, i.installed IS NOT NULL AS has_humps
        FROM streets s LEFT JOIN installed i ON i.physicalid = s.physicalid
        UNION ALL SELECT physicalid, {H0}, installed, false FROM installed""",
}


def layers(spark, sf_dir) -> sd.Layers:
    return sd.Layers(
        streets=fx.all_streets(spark, sf_dir),
        crashes=fx.crashes(spark, sf_dir),
        speedhumps=fx.speedhumps(spark, sf_dir),
        speedlimits=fx.speedlimits(spark, sf_dir),
        trees=fx.trees(spark, sf_dir),
        traffic_volumes=fx.traffic_volumes(spark, sf_dir),
        parking_meters=fx.parking_meters(spark, sf_dir),
    )


def _flag_options():
    return {
        "feature_id": "hump_id", "date_column": "date_insta", "radius": RADIUS, "horizon": fx.HORIZON,
    }


@query("linear_feature_flag", fx.with_layers("streets speedhumps", "SELECT * FROM intervals", **INTERVAL_CTES))
def interval_rows(spark, sf_dir):
    return iv.linear_feature_flag(
        fx.speedhumps(spark, sf_dir), streets(spark, sf_dir), "has_humps", **_flag_options()
    ).select("physicalid", "after", "until", "has_humps")


@query("add_linear_feature", fx.with_layers(
    "streets speedhumps",
    "SELECT s.physicalid, s.st_name, i.after, i.until, i.has_humps FROM streets s JOIN intervals i "
    "ON i.physicalid = s.physicalid", **INTERVAL_CTES))
def _(spark, sf_dir):
    joined = iv.add_linear_feature(
        streets(spark, sf_dir), fx.speedhumps(spark, sf_dir), "has_humps", **_flag_options()
    )
    return joined.select("physicalid", "st_name", "after", "until", "has_humps")


def _per_street(feature_sql: str, layer: str, points: str | None = None, **ctes: str) -> str:
    """All streets with an aggregate over the points in their buffers."""
    return fx.with_layers(
        f"streets {layer}",
        f"SELECT s.physicalid, {feature_sql} AS value FROM streets s LEFT JOIN pairs p "
        "ON s.physicalid = p.physicalid GROUP BY s.physicalid",
        **{**ctes, "pairs": sql_near(points or layer, "streets", RADIUS)},
    )


def _aggregate(spark, sf_dir, points, decimals=None, **options):
    lines = streets(spark, sf_dir).select("physicalid", "geometry")
    table = pf.point_feature_aggregate(PointFeature("value", points, radius=RADIUS, **options), lines)
    return table if decimals is None else table.withColumn("value", F.round("value", decimals))


@query("point_feature_uniform", _per_street("CAST(count(p.tree_id) AS DOUBLE)", "trees"))
def _(spark, sf_dir):
    return _aggregate(spark, sf_dir, fx.trees(spark, sf_dir), collapse=False, point_id="tree_id")


@query("point_feature_aggregate", _per_street("CAST(count(p.collision_id) AS DOUBLE)", "crashes"))
def _(spark, sf_dir):
    return _aggregate(spark, sf_dir, fx.crashes(spark, sf_dir))


@query("point_feature_value_mean", _per_street("round(avg(p.vol), 6)", "traffic_volumes"))
def _(spark, sf_dir):
    return _aggregate(
        spark, sf_dir, fx.traffic_volumes(spark, sf_dir), 6, method="value", value_column="vol", operation="mean"
    )


@query("point_feature_value_max", _per_street("max(p.vol)", "traffic_volumes"))
def _(spark, sf_dir):
    return _aggregate(
        spark, sf_dir, fx.traffic_volumes(spark, sf_dir), method="value", value_column="vol", operation="max"
    )


@query("point_feature_value_sum", _per_street("coalesce(sum(p.vol), 0.0::DOUBLE)", "traffic_volumes"))
def _(spark, sf_dir):
    return _aggregate(
        spark, sf_dir, fx.traffic_volumes(spark, sf_dir), method="value", value_column="vol", operation="sum"
    )


_INSIDE = {
    **COMPONENT_CTES,
    "weighted_discs": "SELECT l.x AS x0, l.y AS y0, l.x AS x1, l.y AS y1, l.root, 1.0::DOUBLE / s.streets AS weight "
                      "FROM labelled l JOIN sizes s ON l.root = s.root",
    "inside": "SELECT collision_id, min(weight) AS weight FROM ("
              + sql_near("crashes", "weighted_discs", RADIUS) + ") GROUP BY 1",
}


@query("point_feature_weighted", _per_street(
    "round(coalesce(sum(p.w), 0), 6)", "crashes", "weighted",
    **_INSIDE, weighted="SELECT c.collision_id, c.x, c.y, coalesce(i.weight, 1.0::DOUBLE) AS w FROM crashes c "
                        "LEFT JOIN inside i ON c.collision_id = i.collision_id"))
def _(spark, sf_dir):
    return _aggregate(spark, sf_dir, fx.crashes(spark, sf_dir), 6, method="weighted")


@query("point_feature_binary", _per_street(
    "coalesce(sum(p.w), 0.0::DOUBLE)", "crashes", "weighted",
    **_INSIDE, weighted="SELECT c.collision_id, c.x, c.y, CASE WHEN i.weight IS NULL THEN 1.0::DOUBLE ELSE 0 END AS w "
                        "FROM crashes c LEFT JOIN inside i ON c.collision_id = i.collision_id"))
def _(spark, sf_dir):
    return _aggregate(spark, sf_dir, fx.crashes(spark, sf_dir), method="binary")


_CRASH_PAIRS = sql_near("crashes", "streets", RADIUS)


@query("point_feature_split_by_date", fx.with_layers(
    "streets speedhumps crashes",
    "SELECT i.physicalid, i.after, i.until, CAST(count(p.collision_id) AS DOUBLE) AS crashes FROM intervals i "
    "LEFT JOIN pairs p ON p.physicalid = i.physicalid AND p.crash_date > i.after AND p.crash_date <= i.until "
    "GROUP BY 1, 2, 3",
    **INTERVAL_CTES, pairs=_CRASH_PAIRS))
def _(spark, sf_dir):
    rows = iv.add_linear_feature(
        streets(spark, sf_dir), fx.speedhumps(spark, sf_dir), "has_humps", **_flag_options()
    )
    feature = PointFeature(
        "crashes", fx.crashes(spark, sf_dir), date_column="crash_date", split_by_date=True, radius=RADIUS
    )
    return pf.point_feature_aggregate(feature, rows, ["physicalid", "after", "until"])


@query("add_point_feature", fx.with_layers(
    "streets parking_meters",
    "SELECT s.physicalid, s.st_name, CAST(count(p.meter_id) AS DOUBLE) AS meters FROM streets s "
    "LEFT JOIN pairs p ON p.physicalid = s.physicalid GROUP BY 1, 2",
    pairs=sql_near("parking_meters", "streets", RADIUS)))
def _(spark, sf_dir):
    feature = PointFeature(
        "meters", fx.parking_meters(spark, sf_dir), radius=RADIUS, collapse=False, point_id="meter_id"
    )
    return pf.add_point_feature(streets(spark, sf_dir), feature).select("physicalid", "st_name", "meters")


@query("add_multiple_features", fx.with_layers(
    "streets speedlimits trees",
    "SELECT s.physicalid, max(p.postvz_sl) AS speed_limit, any_value(t.n) AS n_trees FROM streets s "
    "LEFT JOIN pairs p ON p.physicalid = s.physicalid "
    "LEFT JOIN (SELECT s.physicalid, CAST(count(p.tree_id) AS DOUBLE) AS n FROM streets s LEFT JOIN tree_pairs p "
    "ON p.physicalid = s.physicalid GROUP BY 1) t ON t.physicalid = s.physicalid GROUP BY s.physicalid",
    points="SELECT limit_id, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, postvz_sl FROM speedlimits",
    pairs=sql_near("points", "streets", RADIUS), tree_pairs=sql_near("trees", "streets", RADIUS)))
def _(spark, sf_dir):
    lines = streets(spark, sf_dir).select("physicalid", "geometry")
    features = [
        PointFeature("speed_limit", limit_points(spark, sf_dir), method="value", value_column="postvz_sl",
                     operation="max", radius=RADIUS),
        PointFeature("n_trees", fx.trees(spark, sf_dir), radius=RADIUS, collapse=False, point_id="tree_id"),
    ]
    return pf.add_point_features(lines, features, ["physicalid"]).drop("geometry")


WEEKS = "(CAST(date_diff('second', {a}, {b}) AS DOUBLE) / 604800)"
DATASET_CTES = {
    **INTERVAL_CTES,
    "kept": "SELECT * FROM intervals WHERE until > TIMESTAMP '1996-01-01' AND after < TIMESTAMP '2001-03-01'",
    "crash_pairs": _CRASH_PAIRS,
    "tree_pairs": sql_near("trees", "streets", RADIUS),
    "meter_pairs": sql_near("parking_meters", "streets", RADIUS),
    "volume_pairs": sql_near("traffic_volumes", "streets", RADIUS),
    "limit_pairs": sql_contained("speedlimits", "limit_id", "streets", "physicalid", RADIUS),
    "collisions": "SELECT k.physicalid, k.after, count(*) AS n FROM kept k JOIN crash_pairs p ON p.physicalid = k.physicalid "
                  "AND p.crash_date > k.after AND p.crash_date <= k.until GROUP BY 1, 2",
    "dataset": f"""
        SELECT k.physicalid, k.has_humps, s.bike_lane IS NOT NULL AS has_bike_lane, s.st_width, s.shape_leng,
               {STREET_TYPES_SQL},
               coalesce(c.n, 0) / {WEEKS.format(a='k.after', b='k.until')} AS collision_rate,
               CAST(coalesce(t.n, 0) AS DOUBLE) AS n_trees, coalesce(l.postvz_sl, 25) AS speed_limit,
               v.vol AS traffic_volume, CAST(coalesce(m.n, 0) AS DOUBLE) AS n_parking_meters,
               coalesce(c.n, 0) / {WEEKS.format(a='k.after', b='k.until')} / s.shape_leng AS collision_rate_per_length,
               v.vol IS NOT NULL AS has_volume_meas, coalesce(m.n, 0) > 0 AS has_parking_meters
        FROM kept k JOIN streets s ON s.physicalid = k.physicalid
        LEFT JOIN collisions c ON c.physicalid = k.physicalid AND c.after = k.after
        LEFT JOIN (SELECT physicalid, count(*) AS n FROM tree_pairs GROUP BY 1) t ON t.physicalid = k.physicalid
        LEFT JOIN (SELECT physicalid, count(*) AS n FROM meter_pairs GROUP BY 1) m ON m.physicalid = k.physicalid
        LEFT JOIN (SELECT physicalid, avg(vol) AS vol FROM volume_pairs GROUP BY 1) v ON v.physicalid = k.physicalid
        LEFT JOIN (SELECT p.physicalid, max(f.postvz_sl) AS postvz_sl FROM limit_pairs p
                   JOIN speedlimits f ON f.limit_id = p.limit_id GROUP BY 1) l ON l.physicalid = k.physicalid
        WHERE s.st_width > 0""",
}
DATASET_LAYERS = "streets crashes speedhumps speedlimits trees traffic_volumes parking_meters"
ROUNDED = {"shape_leng": 6, "collision_rate": 6, "traffic_volume": 6, "collision_rate_per_length": 9}


def dataset(spark, sf_dir):
    return sd.street_collision_dataset(layers(spark, sf_dir), SETTINGS)


def rounded(df, decimals=None):
    wanted = ROUNDED if decimals is None else decimals
    return df.withColumns({c: F.round(c, n) for c, n in wanted.items() if c in df.columns})


def sql_rounded(names: dict[str, int]) -> str:
    return ", ".join(f"round({c}, {n}) AS {c}" for c, n in names.items())


@query("street_collision_dataset", fx.with_layers(
    DATASET_LAYERS,
    f"SELECT * REPLACE ({sql_rounded(ROUNDED)}) FROM dataset", **DATASET_CTES))
def _(spark, sf_dir):
    return rounded(dataset(spark, sf_dir).drop("geometry"))


_X = "(((({id}) % 2147483647) * 1103515245 + {seed}) % 2147483647)"
_SQUARE = f"({_X} * {_X} % 2147483647)"
HASH = f"({_SQUARE} * {_SQUARE} % 2147483647) * {_X} % 2147483647"
_RANKED = (
    "SELECT *, row_number() OVER (ORDER BY "
    + HASH.format(id="physicalid * 2 + CAST(has_humps AS BIGINT)", seed=316203477)
    + ", physicalid * 2 + CAST(has_humps AS BIGINT)) AS place, count(*) OVER () AS total FROM dataset"
)


@query("street_collision_split", fx.with_layers(
    DATASET_LAYERS,
    "SELECT physicalid, has_humps, round(collision_rate, 6) AS collision_rate, place <= ceil(total * 0.2) AS is_test "
    "FROM ranked", **DATASET_CTES, ranked=_RANKED))
def _(spark, sf_dir):
    from curbline.session import settle

    train, test = sd.split_dataset(settle(dataset(spark, sf_dir), "dataset"), seed=316203477)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.select("physicalid", "has_humps", F.round("collision_rate", 6).alias("collision_rate"), "is_test")


@query("hump_effect_from_dataset", fx.with_layers(
    DATASET_LAYERS,
    """SELECT a.physicalid, round(b.collision_rate_per_length * 1000, 6) AS collisions_per_week_before,
              round(a.collision_rate_per_length * 1000, 6) AS collisions_per_week_after
       FROM dataset a JOIN dataset b ON a.physicalid = b.physicalid WHERE a.has_humps AND NOT b.has_humps""",
    **DATASET_CTES))
def _(spark, sf_dir):
    pairs = he.hump_effect_from_dataset(dataset(spark, sf_dir))
    return rounded(pairs, {"collisions_per_week_before": 6, "collisions_per_week_after": 6})


@query("hump_effect_slope", fx.with_layers(
    DATASET_LAYERS,
    """SELECT count(*) AS streets, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
              round(corr(y, x), 6) AS correlation
       FROM (SELECT b.collision_rate_per_length * 1000 AS x, a.collision_rate_per_length * 1000 AS y
             FROM dataset a JOIN dataset b ON a.physicalid = b.physicalid WHERE a.has_humps AND NOT b.has_humps)""",
    **DATASET_CTES))
def _(spark, sf_dir):
    effect = he.hump_effect(he.hump_effect_from_dataset(dataset(spark, sf_dir)))
    return rounded(effect, {"slope": 6, "intercept": 6, "correlation": 6})
