"""Feature preparation, splits, models and evaluation."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.feature_queries import (
    DATASET_CTES,
    DATASET_LAYERS,
    HASH,
    dataset,
    rounded,
)
from curbline.checks.geometry_queries import SITES_SQL
from curbline.checks.registry import query
from curbline.checks.solver_sql import feature_ctes, least_squares_ctes, scores_sql, tree_ctes
from curbline.checks.study_queries import (
    AUGMENTATION_CTES,
    AUGMENTATION_LAYERS,
    HOURLY_CTES,
    augmented,
    hourly_table,
)
from curbline.functions import transforms as tr
from curbline.operators import knn, linear, models, prep, splits, stats
from curbline.operators import relational as rel
from curbline.operators.ensembles import fit_forest
from curbline.operators.nearest import nearest_join
from curbline.plans import hump_effect as he
from curbline.plans import modelling as mo
from curbline.plans import street_dataset as sd
from curbline.plans.augmentation import volume_sites
from curbline.session import scratch_path
from curbline.sources.sinks import materialize

LABEL = "collision_rate"


def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


# --- splits and folds

_ORDER_HASH = HASH.format(id="o_orderkey", seed=42)


@query("train_test_split", f"""
    SELECT o_orderkey, place <= ceil(total * 0.2) AS is_test FROM (
        SELECT o_orderkey, row_number() OVER (ORDER BY {_ORDER_HASH}, o_orderkey) AS place, count(*) OVER () AS total
        FROM orders)""")
def _(spark, sf_dir):
    return splits.with_test_flag(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey")


@query("train_test_split_threshold", f"SELECT o_orderkey, {_ORDER_HASH} < {int(splits.PRIME * 0.2)} AS is_test FROM orders")
def _(spark, sf_dir):
    return splits.with_test_flag(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", exact=False)


@query("stratified_split", f"""
    SELECT o_orderkey, o_orderpriority, place <= ceil(total * 0.2) AS is_test FROM (
        SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS total,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_ORDER_HASH}, o_orderkey) AS place
        FROM orders)""")
def _(spark, sf_dir):
    return splits.with_test_flag(
        orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), "o_orderkey", strata=["o_orderpriority"]
    )


@query("kfold", f"""
    SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY {_ORDER_HASH}, o_orderkey) - 1 AS INTEGER) AS fold FROM orders""")
def _(spark, sf_dir):
    return splits.with_fold(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey")


@query("kfold_hash", f"SELECT o_orderkey, CAST(({_ORDER_HASH}) % 5 AS INTEGER) AS fold FROM orders")
def _(spark, sf_dir):
    return splits.with_fold(orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", exact=False)


# --- feature preparation

@query("impute_mean", fx.with_layers("all_streets", """
    SELECT physicalid, round(coalesce(st_width, (SELECT avg(st_width) FROM all_streets)), 6) AS st_width FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width")
    return rounded(prep.fit_impute_mean(rows, ["st_width"]).transform(rows), {"st_width": 6})


@query("impute_mean_sentinel", fx.with_layers("all_streets", """
    SELECT physicalid, round(CASE WHEN st_width = 0 THEN (SELECT avg(st_width) FROM all_streets WHERE st_width <> 0)
        ELSE st_width END, 6) AS st_width FROM all_streets WHERE st_width IS NOT NULL"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width").dropna()
    filled = prep.fit_impute_mean(rows, ["st_width"], missing_value=0.0).transform(rows)
    return rounded(filled, {"st_width": 6})


@query("impute_constant", fx.with_layers("all_streets", """
    SELECT physicalid, coalesce(st_width, 16) AS st_width, coalesce(bike_lane, '0') AS bike_lane FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "bike_lane")
    return prep.impute_constant(rows, {"st_width": 16.0, "bike_lane": "0"})


def _indicators(column: str, values) -> str:
    return ", ".join(f"CAST(coalesce({column} = '{v}', false) AS INTEGER) AS \"{column}_{v}\"" for v in values)


@query("one_hot", fx.with_layers("all_streets", f"""
    SELECT physicalid, {_indicators('trafdir', ('FT', 'TF', 'TW'))},
           {_indicators('post_type', ('AVE', 'BLVD', 'RD', 'ROAD', 'ST'))} FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "trafdir", "post_type")
    return prep.one_hot(rows, ["trafdir", "post_type"])


@query("one_hot_fixed", fx.with_layers("all_streets", f"""
    SELECT physicalid, {_indicators('bike_lane', ('1', '2'))}, {_indicators('trafdir', ('TF', 'NV'))} FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "bike_lane", "trafdir")
    return prep.one_hot_fixed(rows, {"bike_lane": ["1", "2"], "trafdir": ["TF", "NV"]})


@query("standard_scale", fx.with_layers("all_streets", """
    SELECT physicalid, round((st_width - mw) / sw, 6) AS st_width, round((shape_leng - ml) / sl, 6) AS shape_leng
    FROM all_streets, (SELECT avg(st_width) AS mw, stddev_pop(st_width) AS sw, avg(shape_leng) AS ml,
                              stddev_pop(shape_leng) AS sl FROM all_streets)"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "shape_leng")
    scaled = prep.fit_scaler(rows, ["st_width", "shape_leng"]).transform(rows)
    return rounded(scaled, {"st_width": 6, "shape_leng": 6})


@query("column_transform", fx.with_layers("all_streets", """
    SELECT physicalid, trafdir, round(ln(1 + st_width), 6) AS log_width, round(1 / (1 + shape_leng), 9) AS inv_leng
    FROM all_streets"""))
def _(spark, sf_dir):
    shaped = prep.column_transform(
        fx.all_streets(spark, sf_dir),
        {"log_width": "log1p(st_width)", "inv_leng": "1 / (1 + shape_leng)"}, passthrough=["physicalid", "trafdir"],
    )
    return rounded(shaped, {"log_width": 6, "inv_leng": 9})


@query("quadratic_features", fx.with_layers("all_streets", """
    SELECT physicalid, st_width, round(shape_leng, 6) AS shape_leng, st_width * st_width AS st_width_sq,
           round(st_width * shape_leng, 6) AS st_width_x_shape_leng, round(shape_leng * shape_leng, 6) AS shape_leng_sq
    FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "shape_leng")
    return rounded(
        prep.quadratic_features(rows, ["st_width", "shape_leng"]),
        {"shape_leng": 6, "st_width_x_shape_leng": 6, "shape_leng_sq": 6},
    )


@query("feature_preprocessor", fx.with_layers(
    AUGMENTATION_LAYERS, """
    SELECT physicalid, round(collisions_per_week_before, 6) AS collisions_per_week_before, bike_lane > 0 AS has_bike_lane,
           round(tree_count / road_leng, 6) AS trees_per_leng, round(tree_count / (1 + vol), 6) AS trees_per_vol,
           round(speed_limit, 6) AS speed_limit FROM augmented""", **AUGMENTATION_CTES))
def _(spark, sf_dir):
    prepared = tr.feature_preprocessor(augmented(spark, sf_dir))
    return rounded(prepared, {c: 6 for c in ("collisions_per_week_before", "trees_per_leng", "trees_per_vol", "speed_limit")})


# --- the model table: the street table with the nearest site's volume, rows keyed, split and folded

def model_table(spark, sf_dir):
    """Stored once per session, as the studies read the stored street table."""
    def build():
        table = sd.with_row_id(dataset(spark, sf_dir))
        # a street may only have a row after its humps: one line per street, whatever its flag
        lines = table.select("physicalid", "geometry").dropDuplicates(["physicalid"])
        volumes = nearest_join(
            lines, volume_sites(fx.traffic_volumes(spark, sf_dir)), line_id="physicalid", site_id="site_id", buffer=25.0
        ).select("physicalid", F.col("vol").alias("traffic_volume"))
        joined = table.drop("traffic_volume", "geometry").join(volumes, "physicalid")
        return joined.withColumn("has_volume_meas", F.lit(True))

    parameters = {"sf_dir": sf_dir, "session": spark.sparkContext.applicationId}
    stored = materialize(spark, "model-rows", build, parameters=parameters)
    return materialize(
        spark, "model-table",
        lambda: splits.with_fold(splits.with_test_flag(stored, "row_id"), "row_id"), parameters=parameters,
    )


def train_and_test(spark, sf_dir):
    table = model_table(spark, sf_dir)
    return table.where(~F.col("is_test")), table.where(F.col("is_test"))


_ROW_HASH = HASH.format(id="row_id", seed=42)
MODEL_CTES = {
    **DATASET_CTES,
    "sites": SITES_SQL,
    "bare": "SELECT physicalid, x0, y0, x1, y1 FROM streets WHERE physicalid IN "
            "(SELECT physicalid FROM dataset)",
    "near_sites": f"SELECT s.physicalid, p.vol, row_number() OVER (PARTITION BY s.physicalid ORDER BY "
                  f"greatest(0, sqrt({fx.sql_distance_squared('p', 's')}) - 25), p.site_id) AS n FROM bare s CROSS JOIN sites p",
    "keyed": "SELECT d.* REPLACE (v.vol AS traffic_volume, true AS has_volume_meas), "
             "d.physicalid * 2 + CAST(d.has_humps AS BIGINT) AS row_id "
             "FROM dataset d JOIN near_sites v ON v.physicalid = d.physicalid AND v.n = 1",
    "model": f"SELECT *, row_number() OVER (ORDER BY {_ROW_HASH}, row_id) <= ceil(count(*) OVER () * 0.2) AS is_test, "
             f"CAST(ntile(5) OVER (ORDER BY {_ROW_HASH}, row_id) - 1 AS INTEGER) AS fold FROM keyed",
    "train": "SELECT * FROM model WHERE NOT is_test",
    "test": "SELECT * FROM model WHERE is_test",
}


def model_sql(body: str, **ctes: str) -> str:
    return fx.with_layers(DATASET_LAYERS, body, **MODEL_CTES, **ctes)


@query("subset_with_volume", fx.with_layers(
    DATASET_LAYERS, "SELECT physicalid, has_humps, round(traffic_volume, 6) AS traffic_volume FROM dataset WHERE has_volume_meas",
    **DATASET_CTES))
def _(spark, sf_dir):
    subset = mo.with_volume(dataset(spark, sf_dir)).select("physicalid", "has_humps", "traffic_volume")
    return rounded(subset, {"traffic_volume": 6})


@query("mean_baseline", model_sql(
    "SELECT row_id, round((SELECT avg(collision_rate) FROM train), 6) AS prediction FROM test"))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return rounded(models.fit_mean(train, LABEL).transform(test).select("row_id", "prediction"), {"prediction": 6})


@query("cross_val_score", model_sql("""
    SELECT a.fold, round(avg(pow(a.collision_rate - m.mean, 2)), 6) AS mse, round(avg(abs(a.collision_rate - m.mean)), 6) AS mae,
           round(1 - sum(pow(a.collision_rate - m.mean, 2)) / nullif(var_pop(a.collision_rate) * count(*), 0), 6) AS r2
    FROM model a JOIN (SELECT f.fold, avg(b.collision_rate) AS mean FROM (SELECT DISTINCT fold FROM model) f
                       JOIN model b ON b.fold <> f.fold GROUP BY 1) m ON m.fold = a.fold GROUP BY 1"""))
def _(spark, sf_dir):
    scores = models.cross_val_score(
        model_table(spark, sf_dir), LABEL, "fold", lambda df: models.fit_mean(df, LABEL)
    )
    return rounded(scores, {"mse": 6, "mae": 6, "r2": 6})


@query("cross_val_linear", model_sql("""
    SELECT a.fold, round(avg(pow(a.collision_rate - m.b - m.s * a.shape_leng, 2)), 6) AS mse,
           round(1 - sum(pow(a.collision_rate - m.b - m.s * a.shape_leng, 2)) / nullif(var_pop(a.collision_rate) * count(*), 0), 6) AS r2
    FROM model a JOIN (SELECT f.fold, regr_slope(b.collision_rate, b.shape_leng) AS s,
                              regr_intercept(b.collision_rate, b.shape_leng) AS b
                       FROM (SELECT DISTINCT fold FROM model) f JOIN model b ON b.fold <> f.fold GROUP BY 1) m
      ON m.fold = a.fold GROUP BY 1"""))
def _(spark, sf_dir):
    scores = linear.cross_val_linear(model_table(spark, sf_dir), ["shape_leng"], LABEL, "fold")
    return rounded(scores, {"mse": 6, "r2": 6})


#: The features of the linear models as SQL reads them.
_LINEAR_SQL = {n: e.replace("log1p(", "ln(1 + ").replace("cast(", "CAST(") for n, e in models.LINEAR_FEATURES.items()}


@query("cross_val_linear_all", model_sql(
    scores_sql("ls_scored"), **least_squares_ctes("model", "row_id", _LINEAR_SQL, "collision_rate")))
def _(spark, sf_dir):
    """Cross-validation of the linear pipeline with all features of the study."""
    features = list(models.LINEAR_FEATURES.values())
    scores = linear.cross_val_linear(model_table(spark, sf_dir), features, LABEL, "fold")
    return rounded(scores, {"mse": 6, "r2": 6})


@query("cross_val_quadratic", model_sql(
    scores_sql("ls_scored", 5), **least_squares_ctes("model", "row_id", models.quadratic_terms(_LINEAR_SQL), "collision_rate")))
def _(spark, sf_dir):
    """Cross-validation of the pipeline with all monomials of degree 1 and 2."""
    features = list(models.quadratic_terms(models.LINEAR_FEATURES).values())
    scores = linear.cross_val_linear(model_table(spark, sf_dir), features, LABEL, "fold")
    return rounded(scores, {"mse": 5, "r2": 5})


@query("linear_regression_all", model_sql(
    "SELECT k AS row_id, round(prediction, 6) AS prediction FROM ls_scored WHERE g = 1",
    **least_squares_ctes("model", "row_id", _LINEAR_SQL, "collision_rate", "is_test")))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return rounded(models.fit_linear(train, LABEL).transform(test).select("row_id", "prediction"), {"prediction": 6})


_TWO = {"log_leng": "log1p(shape_leng)", "trees": "n_trees"}
_TWO_CTES = {
    "z": "SELECT *, ln(1 + shape_leng) AS u, n_trees AS v FROM train",
    "s": "SELECT avg(u) AS mu, avg(v) AS mv, avg(collision_rate) AS my, var_pop(u) AS uu, var_pop(v) AS vv, "
         "covar_pop(u, v) AS uv, covar_pop(u, collision_rate) AS uy, covar_pop(v, collision_rate) AS vy FROM z",
    "w": "SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS bu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS bv FROM s",
}


@query("linear_regression", model_sql(
    "SELECT row_id, round(my + bu * (ln(1 + shape_leng) - mu) + bv * (n_trees - mv), 6) AS prediction FROM test, w",
    **_TWO_CTES))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return rounded(models.fit_linear(train, LABEL, _TWO).transform(test).select("row_id", "prediction"), {"prediction": 6})


@query("coefficient_table", model_sql(
    "SELECT 'log_leng' AS feature, round(bu * sqrt(uu), 6) AS coefficient FROM w "
    "UNION ALL SELECT 'trees', round(bv * sqrt(vv), 6) FROM w", **_TWO_CTES))
def _(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    table = models.coefficient_table(models.fit_linear(train, LABEL, _TWO), _TWO, spark)
    return rounded(table, {"coefficient": 6})


@query("predict", model_sql(
    "SELECT row_id, round(collision_rate, 6) AS collision_rate, round(b + s * shape_leng, 6) AS prediction FROM test, "
    "(SELECT regr_slope(collision_rate, shape_leng) AS s, regr_intercept(collision_rate, shape_leng) AS b FROM train)"))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = models.fit_linear(train, LABEL, {"shape_leng": "shape_leng"})
    return rounded(mo.predict(fitted, test, label=LABEL), {LABEL: 6, "prediction": 6})


@query("save_load_model", model_sql(
    "SELECT row_id, round(b + s * shape_leng, 6) AS prediction FROM test, "
    "(SELECT regr_slope(collision_rate, shape_leng) AS s, regr_intercept(collision_rate, shape_leng) AS b FROM train)"))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    folder = scratch_path(spark, "models")
    models.save_model(models.fit_linear(train, LABEL, {"shape_leng": "shape_leng"}), folder, "linear", spark)
    loaded = models.load_model(folder, "linear", spark)
    return rounded(loaded.transform(test).select("row_id", "prediction"), {"prediction": 6})


_SCORED = "SELECT *, 0.001::DOUBLE * shape_leng AS prediction FROM model"


def _scored(spark, sf_dir):
    return model_table(spark, sf_dir).withColumn("prediction", F.col("shape_leng") * 0.001)


_METRICS = {
    "mse": "avg(pow(collision_rate - prediction, 2))",
    "mae": "avg(abs(collision_rate - prediction))",
    "r2": "1 - sum(pow(collision_rate - prediction, 2)) / nullif(sum(pow(collision_rate - mean, 2)), 0)",
}


def _metric(name):
    sql = f"SELECT has_humps, round({_METRICS[name]}, 6) AS {name} FROM " \
          "(SELECT *, avg(collision_rate) OVER (PARTITION BY has_humps) AS mean FROM scored) GROUP BY 1"

    @query(name, model_sql(sql, scored=_SCORED))
    def run(spark, sf_dir):
        scores = stats.evaluate(_scored(spark, sf_dir), LABEL, keys=["has_humps"])
        return rounded(scores.select("has_humps", name), {name: 6})


for _name in _METRICS:
    _metric(_name)


@query("residuals", model_sql("SELECT row_id, round(prediction - collision_rate, 6) AS residual FROM scored", scored=_SCORED))
def _(spark, sf_dir):
    return rounded(stats.residuals(_scored(spark, sf_dir), LABEL).select("row_id", "residual"), {"residual": 6})


_FEATURE_COLUMNS = ["log_width", "has_humps", "is_av", "n_trees", "speed_limit"]


@query("correlation_of_features", model_sql(
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM logged"
        for a in _FEATURE_COLUMNS for b in _FEATURE_COLUMNS),
    logged="SELECT *, ln(1 + st_width) AS log_width FROM model"))
def _(spark, sf_dir):
    logged = model_table(spark, sf_dir).withColumn("log_width", F.log1p("st_width"))
    return rounded(stats.correlation_matrix(logged, _FEATURE_COLUMNS), {"correlation": 6})


# --- lasso

_ALPHAS = [i / 1000 for i in range(1, 21)]
_SOFT_CTES = {
    "folds": "SELECT DISTINCT fold FROM model UNION ALL SELECT -1",
    "m": "SELECT f.fold, avg(shape_leng) AS mx, stddev_pop(shape_leng) AS sx, avg(collision_rate) AS my, "
         "covar_pop(shape_leng, collision_rate) / stddev_pop(shape_leng) AS c "
         "FROM folds f JOIN model t ON t.fold <> f.fold GROUP BY 1",
    "alphas": "SELECT CAST(i AS DOUBLE) / 1000 AS alpha FROM range(1, 21) t(i)",
    "fits": "SELECT *, sign(c) * greatest(abs(c) - alpha, 0) AS w FROM m, alphas",
    "errors": "SELECT f.alpha, f.fold, avg(pow(t.collision_rate - f.my - f.w * (t.shape_leng - f.mx) / f.sx, 2)) AS mse "
              "FROM fits f JOIN model t ON (f.fold = -1 OR t.fold = f.fold) GROUP BY 1, 2",
}


@query("lasso_path", model_sql("""
    SELECT f.alpha, round(f.w, 6) AS w_shape_leng, round(e.mse, 6) AS train_mse, round(v.mse, 6) AS val_mse
    FROM fits f JOIN errors e ON e.alpha = f.alpha AND e.fold = -1
    JOIN (SELECT alpha, avg(mse) AS mse FROM errors WHERE fold >= 0 GROUP BY 1) v ON v.alpha = f.alpha
    WHERE f.fold = -1""", **_SOFT_CTES))
def _(spark, sf_dir):
    path = linear.lasso_path(model_table(spark, sf_dir), ["shape_leng"], LABEL, "fold", _ALPHAS)
    return rounded(
        path.select("alpha", "w_shape_leng", "train_mse", "val_mse"), {"w_shape_leng": 6, "train_mse": 6, "val_mse": 6}
    )


@query("lasso", model_sql("""
    SELECT row_id, round(my + w * (shape_leng - mx) / sx, 5) AS prediction FROM test, (
        SELECT *, sign(c) * greatest(abs(c) - 0.005, 0) AS w FROM (
            SELECT avg(shape_leng) AS mx, stddev_pop(shape_leng) AS sx, avg(collision_rate) AS my,
                   covar_pop(shape_leng, collision_rate) / stddev_pop(shape_leng) AS c FROM train))"""))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = models.fit_lasso(train, LABEL, 0.005, {"shape_leng": "shape_leng"})
    return rounded(fitted.transform(test).select("row_id", "prediction"), {"prediction": 5})


@query("lasso_path_all_features")
def _(spark, sf_dir):
    table = linear.lasso_path(
        model_table(spark, sf_dir), list(models.LINEAR_FEATURES.values()), mo.LABEL, "fold",
        np.linspace(1e-11, 1e-5, 300),
    )
    names = ["alpha", *models.LINEAR_FEATURES, "train_r2", "val_r2", "train_mse", "val_mse"]
    return table.toDF(*names)


@query("quadratic_regression")
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return mo.predict(models.fit_quadratic(train, LABEL), test, label=LABEL)


def moments(fitted, rows, label, features):
    """``feature n moment``: the mean of residual times scaled feature, zero where least squares are met."""
    scaled = dict(zip(features, prep.fit_scaler(rows, list(features.values())).expressions()))
    residual = F.col("prediction") - F.col(label)
    entries = [
        F.struct(F.lit(n).alias("feature"), F.count(F.lit(1)).alias("n"),
                 (F.round(F.avg(residual * F.expr(e)), 4) + 0.0).alias("moment"))
        for n, e in {"1": "1D", **scaled}.items()
    ]
    return fitted.transform(rows).agg(F.array(*entries).alias("m")).select(F.inline("m"))


def _zero_moments(features, rows: str) -> str:
    names = ", ".join(f"('{n}')" for n in ["1", *features])
    return f"SELECT feature, (SELECT count(*) FROM {rows}) AS n, 0.0::DOUBLE AS moment FROM (VALUES {names}) t(feature)"


@query("linear_regression_moments", model_sql(_zero_moments(models.LINEAR_FEATURES, "train")))
def _(spark, sf_dir):
    """All features of the study; the residuals are orthogonal to each of them."""
    train, _ = train_and_test(spark, sf_dir)
    return moments(models.fit_linear(train, LABEL), train, LABEL, models.LINEAR_FEATURES)


@query("quadratic_regression_moments", model_sql(_zero_moments(models.quadratic_terms(models.LINEAR_FEATURES), "train")))
def _(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    terms = models.quadratic_terms(models.LINEAR_FEATURES)
    return moments(models.fit_quadratic(train, LABEL), train, LABEL, terms)


def optimality(table, features, label, path):
    """``step n violation``: how far each fit of a lasso path is from the conditions of the optimum."""
    scaled = prep.fit_scaler(table, features).expressions()
    zs = [f"z{i}" for i in range(len(features))]
    mean = table.agg(F.avg(label)).scalar()
    rows = table.select((F.col(label) - mean).alias("y"), *[F.expr(e).alias(z) for e, z in zip(scaled, zs)])
    fits = table.sparkSession.createDataFrame(
        [(i, float(r[0]), [float(w) for w in r[1 : len(features) + 1]]) for i, r in enumerate(path.collect())],
        "step long, alpha double, w array<double>",
    )
    fitted = sum((F.col(z) * F.col("w")[i] for i, z in enumerate(zs)), F.lit(0.0))
    # only numbers are aggregated: with the fit's array among them, every row of every step would be sorted
    sums = rows.join(F.broadcast(fits)).withColumn("e", F.col("y") - fitted).groupBy("step").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col("e") * F.col(z)).alias(z) for z in zs],
    ).join(F.broadcast(fits), "step")
    gaps = [
        F.when(F.col("w")[i] == 0, F.greatest(F.abs(z) - F.col("alpha"), F.lit(0.0)))
        .otherwise(F.abs(F.col(z) - F.signum(F.col("w")[i]) * F.col("alpha"))) for i, z in enumerate(zs)
    ]
    return sums.select("step", "n", (F.round(F.greatest(*gaps), 9) + 0.0).alias("violation"))


@query("lasso_path_optimality", model_sql(
    "SELECT i AS step, (SELECT count(*) FROM model) AS n, 0.0::DOUBLE AS violation FROM range(0, 300) t(i)"))
def _(spark, sf_dir):
    """All features, 300 alphas: how far each fit is from the conditions of the optimum. The mean product of residual
    and scaled feature is the alpha, with the coefficient's sign, or within it where the coefficient is 0."""
    table = model_table(spark, sf_dir)
    features, alphas = list(models.LINEAR_FEATURES.values()), np.linspace(1e-11, 1e-5, 300)
    return optimality(table, features, mo.LABEL, linear.lasso_path(table, features, mo.LABEL, "fold", alphas))


# --- nearest neighbours

_KNN_COLUMNS = ("st_width", "shape_leng", "traffic_volume")


def _knn_ctes(train: str, queries: str, on: str, k_max: int) -> dict[str, str]:
    """Brute force: all pairs, scaled by the training table's mean and population deviation."""
    numbers = ", ".join(
        f"avg(ln(1 + {c})) AS m{i}, stddev_pop(ln(1 + {c})) AS d{i}" for i, c in enumerate(_KNN_COLUMNS)
    )
    vector = ", ".join(f"(ln(1 + {c}) - m{i}) / d{i} AS f{i}" for i, c in enumerate(_KNN_COLUMNS))
    square = " + ".join(f"(q.f{i} - t.f{i}) * (q.f{i} - t.f{i})" for i in range(3))
    return {
        "scale": f"SELECT {numbers} FROM {train}",
        "kt": f"SELECT row_id, fold, collision_rate AS y, {vector} FROM {train}, scale",
        "kq": f"SELECT row_id, fold, collision_rate AS y, {vector} FROM {queries}, scale",
        "kp": f"SELECT q.row_id, q.fold, q.y AS truth, t.row_id AS id, t.y, sqrt({square}) AS d FROM kq q JOIN kt t ON {on}",
        "kr": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, id) AS n FROM kp) WHERE n <= {k_max}",
        "ks": "SELECT *, sum(y) OVER r / n AS uniform, "
              "CASE WHEN min(d) OVER r = 0 THEN sum(CASE WHEN d = 0 THEN y ELSE 0 END) OVER r / "
              "sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER r "
              "ELSE sum(y / nullif(d, 0)) OVER r / sum(1 / nullif(d, 0)) OVER r END AS distance "
              "FROM kr WINDOW r AS (PARTITION BY row_id ORDER BY n ROWS UNBOUNDED PRECEDING)",
        "predicted": "SELECT row_id, fold, truth, n, 'uniform' AS weights, uniform AS prediction FROM ks "
                     "UNION ALL SELECT row_id, fold, truth, n, 'distance', distance FROM ks",
    }


@query("knn_regression", model_sql(
    "SELECT row_id, CAST(n AS INTEGER) AS k, weights, round(prediction, 6) AS prediction FROM predicted WHERE n IN (5, 15, 25)",
    **_knn_ctes("train", "test", "true", 25)))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = knn.fit_knn(train, models.KNN_FEATURES, LABEL, row_id="row_id", k_max=25)
    predicted = knn.knn_predict(fitted, test, query_id="row_id", ks=[5, 15, 25])
    return rounded(predicted, {"prediction": 6})


_KS = list(range(5, 500, 10))


@query("knn_grid_search", model_sql(
    "SELECT CAST(n AS INTEGER) AS k, weights, round(avg(mse), 6) AS val_mse FROM ("
    "SELECT n, weights, fold, avg(pow(truth - prediction, 2)) AS mse FROM predicted WHERE n % 10 = 5 GROUP BY 1, 2, 3) "
    "GROUP BY 1, 2",
    **_knn_ctes("model", "model", "q.fold <> t.fold", 495)))
def _(spark, sf_dir):
    table = models.grid_search_knn(model_table(spark, sf_dir), LABEL, row_id="row_id", fold="fold", ks=_KS)
    return rounded(table.select("k", "weights", "val_mse"), {"val_mse": 6})


_TEST_KNN = {  # the neighbours of the test rows, beside those of the search
    f"test_{name}": re.sub(r"\b(scale|kt|kq|kp|kr|ks|predicted)\b", r"test_\1", text)
    for name, text in _knn_ctes("train", "test", "true", 495).items()
}


@query("best_knn", model_sql(
    "SELECT p.row_id, b.k, b.weights, round(p.prediction, 6) AS prediction FROM test_predicted p JOIN best b "
    "ON p.n = b.k AND p.weights = b.weights",
    **_knn_ctes("model", "model", "q.fold <> t.fold", 495), **_TEST_KNN,
    best="SELECT CAST(n AS INTEGER) AS k, weights FROM (SELECT n, weights, fold, avg(pow(truth - prediction, 2)) AS mse "
         "FROM predicted WHERE n % 10 = 5 GROUP BY 1, 2, 3) GROUP BY 1, 2 ORDER BY avg(mse), k, weights LIMIT 1"))
def _(spark, sf_dir):
    """The best k and weighting of the search, refitted, stored, loaded again and applied to the test rows."""
    train, test = train_and_test(spark, sf_dir)
    results = models.grid_search_knn(model_table(spark, sf_dir), LABEL, row_id="row_id", fold="fold", ks=_KS)
    chosen, fitted = models.best_knn(train, LABEL, results, row_id="row_id")
    folder = scratch_path(spark, "models")
    models.save_model(fitted, folder, "knn", spark)
    loaded = models.load_model(folder, "knn", spark)
    predicted = knn.knn_predict(loaded, test, query_id="row_id", ks=[chosen["k"]], weights=[chosen["weights"]])
    return rounded(predicted, {"prediction": 6})


_SIDE = "SELECT n AS k, weights, avg(mse) AS mse FROM (SELECT n, weights, {fold} AS fold, avg(pow(truth - prediction, 2)) AS mse " \
        "FROM {table} WHERE n % 10 = 5 GROUP BY 1, 2, 3) GROUP BY 1, 2"
_SEEN_CTES = {
    # every row is asked once for each fold it does not belong to, and finds the rows outside that fold
    "skq": "SELECT q.row_id * 5 + f.fold AS row_id, f.fold, q.y, q.f0, q.f1, q.f2 FROM kq q JOIN (SELECT DISTINCT fold FROM model) f "
           "ON f.fold <> q.fold",
    **{
        {"kp": "skp", "kr": "skr", "ks": "sks", "predicted": "seen"}[name]:
            text.replace("FROM kq q", "FROM skq q").replace("FROM kp", "FROM skp").replace("FROM kr", "FROM skr").replace("FROM ks", "FROM sks")
        for name, text in _knn_ctes("model", "model", "q.fold <> t.fold", 495).items() if name in ("kp", "kr", "ks", "predicted")
    },
    "val": _SIDE.format(fold="fold", table="predicted"),
    "fitted": _SIDE.format(fold="fold", table="seen"),
}


@query("cv_results_table", model_sql(
    "SELECT CAST(v.k AS INTEGER) AS k, " + ", ".join(
        f"round(max(CASE WHEN weights = '{w}' THEN {t}.mse END), 6) AS {w}_{n}_mse" for w in knn.WEIGHTS for n, t in (("val", "v"), ("train", "t"))
    ) + " FROM val v JOIN fitted t USING (k, weights) GROUP BY 1",
    **{**_knn_ctes("model", "model", "q.fold <> t.fold", 495), **_SEEN_CTES}))
def _(spark, sf_dir):
    table = models.grid_search_knn(
        model_table(spark, sf_dir), LABEL, row_id="row_id", fold="fold", ks=_KS, train_scores=True
    )
    wide = table.groupBy("k").pivot("weights", list(knn.WEIGHTS)).agg(
        F.first("val_mse").alias("val_mse"), F.first("train_mse").alias("train_mse")
    )
    return rounded(wide, {f"{w}_{n}_mse": 6 for w in knn.WEIGHTS for n in ("val", "train")})


# --- trees, searches, comparisons

@query("random_forest")
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return mo.predict(fit_forest(train, LABEL, models.RAW_FEATURES), test, label=LABEL)


@query("gradient_boosting")
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    return mo.predict(models.fit_trees(train, models.boosted_trees(LABEL)), test, label=LABEL)


@query("feature_importances")
def _(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    return models.feature_importances(fit_forest(train, LABEL, models.RAW_FEATURES), models.RAW_FEATURES, spark)


@query("grid_search")
def _(spark, sf_dir):
    """The forest search of the study, with its whole grid."""
    return models.forest_search(model_table(spark, sf_dir), LABEL, fold="fold").results.orderBy("val_mse")


# A tree of depth 1 on a flag is the mean per flag, whatever grows it.
_FLAG = {"has_humps": "cast(has_humps as double)", "constant": "1D"}
_FLAG_MEANS = "SELECT has_humps, avg(collision_rate) AS mean FROM train GROUP BY 1"


def _stump(name, estimator):
    @query(name, model_sql("SELECT row_id, round(mean, 6) AS prediction FROM test JOIN flags USING (has_humps)", flags=_FLAG_MEANS))
    def run(spark, sf_dir):
        train, test = train_and_test(spark, sf_dir)
        fitted = models.fit_trees(train, estimator(), _FLAG)
        return rounded(fitted.transform(test).select("row_id", "prediction"), {"prediction": 6})


_stump("random_forest_stump", lambda: models.random_forest(LABEL, trees=1, max_depth=1, bootstrap=False))
_stump("gradient_boosting_stump", lambda: models.boosted_trees(LABEL, trees=2, max_depth=1))


@query("feature_importances_stump", model_sql(
    "SELECT 'has_humps' AS feature, 1.0::DOUBLE AS importance, count(*) AS n FROM train UNION ALL SELECT 'constant', 0.0, count(*) FROM train"))
def _(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    fitted = models.fit_trees(train, models.random_forest(LABEL, trees=1, max_depth=1, bootstrap=False), _FLAG)
    return models.feature_importances(fitted, _FLAG, spark).withColumn("n", F.lit(train.count()).cast("long"))


# Trees of depth 2 on features of few values: every split can be tried.
_FEW_VALUES = {
    "has_humps": "cast(has_humps as double)", "is_av": "cast(is_av as double)",
    "trees": "cast(least(n_trees, 4) as double)", "limit": "cast(floor(speed_limit / 5) as double)",
    "length": "cast(floor(least(shape_leng, 1000) / 100) as double)",
}
_TREE_CTES = {
    **feature_ctes("model", "row_id", _FEW_VALUES, "is_test"),
    "target": "SELECT row_id AS k, collision_rate AS y FROM train",
    **tree_ctes("one", "target", 2, 5),
}


@query("random_forest_depth2", model_sql(
    "SELECT k AS row_id, round(prediction, 6) AS prediction FROM one_tree JOIN test ON row_id = k", **_TREE_CTES))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = fit_forest(train, LABEL, _FEW_VALUES, trees=1, max_depth=2, min_leaf=5, bootstrap=False)
    return rounded(fitted.transform(test).select("row_id", "prediction"), {"prediction": 6})


@query("feature_importances_depth2", model_sql(
    "SELECT name AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM one_splits), 6) AS importance FROM (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_FEW_VALUES)) + ") names(f, name) LEFT JOIN one_splits USING (f) GROUP BY 1",
    **_TREE_CTES))
def _(spark, sf_dir):
    train, _ = train_and_test(spark, sf_dir)
    fitted = fit_forest(train, LABEL, _FEW_VALUES, trees=1, max_depth=2, min_leaf=5, bootstrap=False)
    return rounded(models.feature_importances(fitted, _FEW_VALUES, spark), {"importance": 6})


@query("gradient_boosting_depth2", model_sql(
    "SELECT row_id, round(a.prediction + 0.1 * b.prediction + 0.1 * c.prediction, 6) AS prediction FROM test "
    "JOIN first_tree a ON a.k = row_id JOIN second_tree b ON b.k = row_id JOIN third_tree c ON c.k = row_id",
    **{
        **feature_ctes("model", "row_id", _FEW_VALUES, "is_test"),
        "target": "SELECT row_id AS k, collision_rate AS y FROM train",
        **tree_ctes("first", "target", 2, 1),
        # the next tree is grown on the slope of the squared error
        "rest": "SELECT k, 2 * (y - prediction) AS y FROM target JOIN first_tree USING (k)",
        **tree_ctes("second", "rest", 2, 1),
        "rest2": "SELECT t.k, 2 * (t.y - a.prediction - 0.1 * b.prediction) AS y FROM target t JOIN first_tree a ON a.k = t.k "
                 "JOIN second_tree b ON b.k = t.k",
        **tree_ctes("third", "rest2", 2, 1),
    }))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = models.fit_trees(train, models.boosted_trees(LABEL, trees=3, max_depth=2), _FEW_VALUES)
    return rounded(fitted.transform(test).select("row_id", "prediction"), {"prediction": 6})


@query("grid_search_stump", model_sql("""
    SELECT depth AS "maxDepth", round(avg(val), 6) AS val_mse, round(avg(seen), 6) AS train_mse FROM (
        SELECT depth, left_out, avg(CASE WHEN fold = left_out THEN pow(collision_rate - guess, 2) END) AS val,
               avg(CASE WHEN fold <> left_out THEN pow(collision_rate - guess, 2) END) AS seen
        FROM guesses GROUP BY 1, 2) GROUP BY 1""",
    folds5="SELECT DISTINCT fold AS left_out FROM model",
    by_flag="SELECT left_out, has_humps, avg(collision_rate) AS mean FROM folds5 JOIN model ON fold <> left_out GROUP BY 1, 2",
    overall="SELECT left_out, avg(collision_rate) AS mean FROM folds5 JOIN model ON fold <> left_out GROUP BY 1",
    guesses="SELECT 1.0::DOUBLE AS depth, left_out, fold, collision_rate, mean AS guess FROM model JOIN by_flag USING (has_humps) "
            "UNION ALL SELECT 0.0, left_out, fold, collision_rate, mean FROM model CROSS JOIN overall"))
def _(spark, sf_dir):
    search = models.grid_search(
        model_table(spark, sf_dir), LABEL, models.random_forest(LABEL, trees=1, bootstrap=False), {"maxDepth": [0, 1]}, fold="fold",
        features=_FLAG, train_scores=True,
    )
    return rounded(search.results, {"val_mse": 6, "train_mse": 6})


_SUITE = mo.SuiteSettings()


@query("model_training_suite")
def _(spark, sf_dir):
    """All five models are trained, stored and loaded again; their predictions side by side."""
    train, test = train_and_test(spark, sf_dir)
    folder = scratch_path(spark, "models")
    table = test.select("row_id")
    for kind, model in mo.train_suite(train, settings=_SUITE).items():
        models.save_model(model, folder, kind, spark)
        loaded = models.load_model(folder, kind, spark)
        predicted = mo.predict(loaded, test).select("row_id", F.col("prediction").alias(kind))
        table = table.join(predicted, "row_id")
    return table


@query("model_comparison")
def _(spark, sf_dir):
    """From the table to the leaderboard in one plan: split, five models trained, stored, loaded and scored."""
    table = model_table(spark, sf_dir).drop("is_test", "fold")
    return mo.train_and_compare(table, scratch_path(spark, "models"), settings=_SUITE)[1]


@query("model_comparison_measured")
def _(spark, sf_dir):
    """As ``model_comparison`` on the streets whose volume was measured."""
    table = sd.with_row_id(dataset(spark, sf_dir)).drop("geometry")
    return mo.train_and_compare(table, scratch_path(spark, "models"), settings=_SUITE)[1]


@query("model_leaderboard", model_sql("""
    SELECT * FROM (
        SELECT 'baseline' AS model, round(avg(pow(collision_rate - (SELECT avg(collision_rate) FROM train), 2)), 6) AS mse FROM test
        UNION ALL SELECT 'linear', round(avg(pow(collision_rate - b - s * shape_leng, 2)), 6) FROM test, (
            SELECT regr_slope(collision_rate, shape_leng) AS s, regr_intercept(collision_rate, shape_leng) AS b FROM train)
        UNION ALL SELECT 'knn', round(avg(pow(truth - prediction, 2)), 6) FROM predicted WHERE n = 25 AND weights = 'distance'
        UNION ALL SELECT kind, round(avg(pow(collision_rate - mean, 2)), 6)
        FROM test JOIN flags USING (has_humps), (VALUES ('random_forest'), ('boosting')) t(kind) GROUP BY 1)""",
    **_knn_ctes("train", "test", "true", 25), flags=_FLAG_MEANS))
def _(spark, sf_dir):
    train, test = train_and_test(spark, sf_dir)
    fitted = {
        "baseline": models.fit_mean(train, LABEL),
        "linear": models.fit_linear(train, LABEL, {"shape_leng": "shape_leng"}),
        "knn": knn.fit_knn(train, models.KNN_FEATURES, LABEL, row_id="row_id", k_max=25),
        "random_forest": models.fit_trees(train, models.random_forest(LABEL, trees=1, max_depth=1, bootstrap=False), _FLAG),
        "boosting": models.fit_trees(train, models.boosted_trees(LABEL, trees=2, max_depth=1), _FLAG),
    }
    return rounded(mo.model_leaderboard(fitted, test, label=LABEL), {"mse": 6})


@query("hourly_crash_model")
def _(spark, sf_dir):
    return mo.hourly_crash_model(hourly_table(spark, sf_dir, keep_key=True))


@query("hourly_crash_model_fit", fx.with_layers("all_streets speedlimits speedhumps crashes", """
    SELECT count(*) AS n, 5 + count(DISTINCT rw_type) + count(DISTINCT bike_lane) + count(DISTINCT trafdir) AS features,
           0.0::DOUBLE AS largest_moment
    FROM all_streets s JOIN lines g ON g.physicalid = s.physicalid LEFT JOIN hourly c ON c.physicalid = s.physicalid
    WHERE shape_leng IS NOT NULL AND st_width IS NOT NULL""",
    **HOURLY_CTES))
def _(spark, sf_dir):
    """The hourly model on all rows: none of its features has anything left to explain."""
    rows = hourly_table(spark, sf_dir).dropna(subset=["shape_leng", "st_width", "postvz_sl", "crashes"])
    rows = materialize(spark, "hourly", lambda: rows, parameters={"sf_dir": sf_dir, "session": spark.sparkContext.applicationId})
    features = mo.hourly_features(rows)
    found = moments(models.fit_linear(rows, "crashes", features), rows, "crashes", features)
    return found.agg(
        F.max("n").alias("n"), F.lit(len(features)).cast("long").alias("features"), F.max(F.abs("moment")).alias("largest_moment"))


@query("predict_hump_effect", fx.with_layers(
    DATASET_LAYERS, """
    SELECT d.physicalid, round(d.collision_rate_per_length * 1000, 6) AS rate,
           round(d.collision_rate_per_length * 1000 * s + b, 6) AS expected_rate
    FROM dataset d, (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS b FROM pairs)
    WHERE d.physicalid NOT IN (SELECT physicalid FROM pairs)""",
    **DATASET_CTES,
    pairs="SELECT a.physicalid, b.collision_rate_per_length * 1000 AS x, a.collision_rate_per_length * 1000 AS y "
          "FROM dataset a JOIN dataset b ON a.physicalid = b.physicalid WHERE a.has_humps AND NOT b.has_humps"))
def _(spark, sf_dir):
    from curbline.session import settle

    table = settle(dataset(spark, sf_dir), "dataset").withColumn("rate_1000", F.col("collision_rate_per_length") * 1000)
    expected = mo.predict_hump_effect(he.hump_effect_from_dataset(table), table, "rate_1000")
    return rounded(expected, {"rate": 6, "expected_rate": 6})


#: The features of the hump effect as SQL reads them.
_HUMP_SQL = {
    **{c: c for c in mo.HUMP_EFFECT_COLUMNS},
    "has_bike_lane": "coalesce(bike_lane > 0, false)", "vol_per_leng": "vol / road_leng",
    "trees_per_leng": "tree_count / road_leng", "trees_per_vol": "tree_count / (vol + 1)",
}
_HUMP_ROWS = """SELECT *, collisions_per_week_before AS x, collisions_per_week_after AS y FROM augmented
    WHERE collisions_per_week_before IS NOT NULL AND collisions_per_week_after IS NOT NULL AND tree_count IS NOT NULL
      AND road_leng <> 0 AND vol IS NOT NULL AND speed_limit IS NOT NULL"""


def _hump_fits(rows: str, fold: str, kinds=mo.HUMP_EFFECT_MODELS) -> dict[str, str]:
    """The least-squares CTEs of each model, under its name."""
    ctes = {}
    for name, features in kinds.items():
        ctes |= least_squares_ctes(rows, "physicalid", {c: _HUMP_SQL[c] for c in features}, "y", fold, prefix=name)
    return ctes


_HUMP_HASH = HASH.format(id="physicalid", seed=42)


def hump_sql(body: str, **ctes: str) -> str:
    return fx.with_layers(AUGMENTATION_LAYERS, body, **AUGMENTATION_CTES, hump_rows=_HUMP_ROWS, **ctes)


def augmented_once(spark, sf_dir):
    return materialize(
        spark, "augmented", lambda: augmented(spark, sf_dir),
        parameters={"sf_dir": sf_dir, "session": spark.sparkContext.applicationId},
    )


# every row twice: once to fit on, once to be predicted
_TWICE = "SELECT *, 0 AS part FROM hump_rows UNION ALL SELECT * REPLACE (-1 - physicalid AS physicalid), 1 AS part FROM hump_rows"


@query("hump_effect_model", hump_sql(
    "SELECT -1 - k AS physicalid, round(prediction, 6) AS prediction FROM five_features_scored WHERE g = 1",
    twice=_TWICE, **_hump_fits("twice", "part", {"five_features": mo.HUMP_EFFECT_FEATURES})))
def _(spark, sf_dir):
    """Five-feature model of the rate after humps, applied to the streets it was fitted on."""
    table = augmented_once(spark, sf_dir)
    fitted = mo.fit_hump_effect(table)
    predicted = fitted.transform(mo.hump_effect_rows(table)).select("physicalid", "prediction")
    return rounded(predicted, {"prediction": 6})


@query("hump_effect_coefficients", hump_sql(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, n.feature, round(f.b, 6) AS coefficient, "
        f"(SELECT round(avg(pow(y - prediction, 2)), 6) FROM {name}_scored WHERE g = 1) AS train_mse "
        f"FROM {name}_fit f JOIN (VALUES {', '.join(f'({i}, {chr(39)}{c}{chr(39)})' for i, c in enumerate(features, 1))}) n(i, feature) "
        f"ON n.i = f.i WHERE f.g = 1" for name, features in mo.HUMP_EFFECT_MODELS.items()),
    twice=_TWICE, **_hump_fits("twice", "part")))
def _(spark, sf_dir):
    """Coefficients of the extended models of the hump effect, and their errors on the rows they are fitted on."""
    return rounded(mo.hump_effect_coefficients(augmented_once(spark, sf_dir)), {"coefficient": 6, "train_mse": 6})


@query("hump_effect_model_moments", hump_sql(_zero_moments(mo.HUMP_EFFECT_FEATURES, "hump_rows")))
def _(spark, sf_dir):
    table = augmented_once(spark, sf_dir)
    rows, features = mo.hump_effect_rows(table), {c: f"cast({c} as double)" for c in mo.HUMP_EFFECT_FEATURES}
    return moments(mo.fit_hump_effect(table), rows, mo.HUMP_EFFECT_LABEL, features)


_HUMP_PARTED = f"SELECT *, row_number() OVER (ORDER BY {_HUMP_HASH}, physicalid) <= ceil(count(*) OVER () * 0.2) AS is_test FROM hump_rows"


@query("hump_effect_holdout", hump_sql(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, mse, r2 FROM ({scores_sql(f'{name}_scored')}) WHERE fold = 1" for name in mo.HUMP_EFFECT_MODELS),
    parted=_HUMP_PARTED, **_hump_fits("parted", "is_test")))
def _(spark, sf_dir):
    return rounded(mo.hump_effect_holdout(augmented_once(spark, sf_dir)), {"mse": 6, "r2": 6})


@query("hump_effect_holdout_line", hump_sql("""
    SELECT 'line' AS model, round(avg(pow(y - b - s * x, 2)), 6) AS mse,
           round(1 - sum(pow(y - b - s * x, 2)) / nullif(var_pop(y) * count(*), 0), 6) AS r2
    FROM parted, (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS b FROM parted WHERE NOT is_test) WHERE is_test""",
    parted=_HUMP_PARTED))
def _(spark, sf_dir):
    line = {"line": mo.HUMP_EFFECT_MODELS["line"]}
    return rounded(mo.hump_effect_holdout(augmented_once(spark, sf_dir), line), {"mse": 6, "r2": 6})


_HUMP_FOLDS = f"SELECT *, CAST(ntile(5) OVER (ORDER BY {_HUMP_HASH}, physicalid) - 1 AS INTEGER) AS fold FROM hump_rows"


@query("hump_effect_cv", hump_sql(
    " UNION ALL ".join(f"SELECT '{name}' AS model, * FROM ({scores_sql(f'{name}_scored')})" for name in mo.HUMP_EFFECT_MODELS),
    folded=_HUMP_FOLDS, **_hump_fits("folded", "fold")))
def _(spark, sf_dir):
    return rounded(mo.hump_effect_cv(augmented_once(spark, sf_dir)), {"mse": 6, "r2": 6})


@query("hump_effect_cv_line", hump_sql("""
    SELECT 'line' AS model, a.fold, round(avg(pow(a.y - m.b - m.s * a.x, 2)), 6) AS mse,
           round(1 - sum(pow(a.y - m.b - m.s * a.x, 2)) / nullif(var_pop(a.y) * count(*), 0), 6) AS r2
    FROM folded a JOIN (SELECT f.fold, regr_slope(b.y, b.x) AS s, regr_intercept(b.y, b.x) AS b
                        FROM (SELECT DISTINCT fold FROM folded) f JOIN folded b ON b.fold <> f.fold GROUP BY 1) m
      ON m.fold = a.fold GROUP BY 2""", folded=_HUMP_FOLDS))
def _(spark, sf_dir):
    line = {"line": mo.HUMP_EFFECT_MODELS["line"]}
    return rounded(mo.hump_effect_cv(augmented_once(spark, sf_dir), line), {"mse": 6, "r2": 6})


# The alphas of the hump study.
_HUMP_ALPHAS = np.linspace(0.000001, 0.01, 1000)


@query("hump_lasso_path")
def _(spark, sf_dir):
    """Five features, 1,000 alphas: the best row and the ten on either side of it."""
    path = mo.hump_lasso_path(augmented_once(spark, sf_dir), _HUMP_ALPHAS)
    return rel.rows_around_min(path, "alpha", "val_mse", 10)


@query("hump_lasso_path_extended")
def _(spark, sf_dir):
    """All columns, 1,000 alphas: the best row and the ten on either side of it."""
    path = mo.hump_lasso_path(augmented_once(spark, sf_dir), _HUMP_ALPHAS, mo.HUMP_EFFECT_MODELS["extended_lane_flag"])
    return rel.rows_around_min(path, "alpha", "val_mse", 10)


@query("hump_lasso_path_optimality", hump_sql(
    "SELECT i AS step, (SELECT count(*) FROM hump_rows) AS n, 0.0::DOUBLE AS violation FROM range(0, 1000) t(i)"))
def _(spark, sf_dir):
    """All columns, 1,000 alphas: how far each fit is from the conditions of the optimum."""
    table, features = augmented_once(spark, sf_dir), mo.HUMP_EFFECT_MODELS["extended_lane_flag"]
    rows = mo.hump_effect_rows(table, features)
    path = mo.hump_lasso_path(table, _HUMP_ALPHAS, features)
    return optimality(rows, [f"cast({c} as double)" for c in features], mo.HUMP_EFFECT_LABEL, path)


@query("hump_lasso_path_line", hump_sql("""
    SELECT f.i AS step, round(f.w, 6) AS w, round(e.mse, 6) AS train_mse, round(v.mse, 6) AS val_mse
    FROM fits f JOIN errors e ON e.i = f.i AND e.fold = -1
    JOIN (SELECT i, avg(mse) AS mse FROM errors WHERE fold >= 0 GROUP BY 1) v ON v.i = f.i
    WHERE f.fold = -1""",
    folded=_HUMP_FOLDS,
    parts="SELECT DISTINCT fold FROM folded UNION ALL SELECT -1",
    m="SELECT p.fold, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, covar_pop(x, y) / stddev_pop(x) AS c "
      "FROM parts p JOIN folded t ON t.fold <> p.fold GROUP BY 1",
    alphas="SELECT i, 0.000001 + i * (0.01 - 0.000001) / 999 AS alpha FROM range(0, 1000) t(i)",
    fits="SELECT *, sign(c) * greatest(abs(c) - alpha, 0) AS w FROM m, alphas",
    errors="SELECT f.i, f.fold, avg(pow(t.y - f.my - f.w * (t.x - f.mx) / f.sx, 2)) AS mse "
           "FROM fits f JOIN folded t ON (f.fold = -1 OR t.fold = f.fold) GROUP BY 1, 2"))
def _(spark, sf_dir):
    path = mo.hump_lasso_path(augmented_once(spark, sf_dir), _HUMP_ALPHAS, mo.HUMP_EFFECT_MODELS["line"])
    step = F.round((F.col("alpha") - 0.000001) / ((0.01 - 0.000001) / 999)).cast("long")
    named = path.select(step.alias("step"), F.col("w_collisions_per_week_before").alias("w"), "train_mse", "val_mse")
    return rounded(named, {"w": 6, "train_mse": 6, "val_mse": 6})


def legacy_table(spark, sf_dir):
    """Streets with the columns the older cleaning expects."""
    k = F.col("physicalid")
    return fx.all_streets(spark, sf_dir).drop("geometry").select(
        "*", F.floor(F.col("shape_leng") / 100).cast("int").alias("percentile"),
        (k % 9).cast("double").alias("n_trees"), (k % 4).cast("double").alias("n_parking_meters"),
        F.when(k % 3 == 0, (k % 700).cast("double")).alias("traffic_volume"),
        F.when(k % 4 == 0, (k % 3 * 5 + 20).cast("double")).alias("speed_limit"),
    ).withColumns({
        "bike_lane": F.coalesce("bike_lane", F.lit("nan")), "st_width": F.coalesce("st_width", F.lit(0.0)),
    })


_LEGACY_OUT = ["log_trees", "log_leng", "log_width", "log_traffic_volume", "inv_trees", "leng_per_tree", "width_per_tree"]


@query("legacy_cleaning", fx.with_layers("all_streets", """
    SELECT physicalid, is_test, bike_lane <> 'nan' AS has_bike_lane, traffic_volume IS NOT NULL AS has_volume_meas,
           n_parking_meters > 0 AS has_parking, coalesce(speed_limit, 25) AS speed_limit,
           round(vol, 6) AS traffic_volume, round(width, 6) AS st_width,
           round(ln(1 + n_trees), 6) AS log_trees, round(ln(1 + shape_leng), 6) AS log_leng,
           round(ln(1 + width), 6) AS log_width, round(ln(1 + vol), 6) AS log_traffic_volume,
           round(1 / (1 + ln(1 + n_trees)), 6) AS inv_trees, round(ln(1 + shape_leng) / (1 + n_trees), 6) AS leng_per_tree,
           round(ln(1 + width) / (1 + n_trees), 6) AS width_per_tree
    FROM (SELECT *, coalesce(traffic_volume, (SELECT avg(traffic_volume) FROM parted WHERE NOT is_test)) AS vol,
                 CASE WHEN st_width = 0 THEN (SELECT avg(st_width) FROM parted WHERE NOT is_test AND st_width <> 0)
                      ELSE st_width END AS width FROM parted)""",
    legacy="""SELECT * REPLACE (coalesce(bike_lane, 'nan') AS bike_lane, coalesce(st_width, 0) AS st_width),
                     CAST(floor(shape_leng / 100) AS INTEGER) AS percentile, CAST(physicalid % 9 AS DOUBLE) AS n_trees,
                     CAST(physicalid % 4 AS DOUBLE) AS n_parking_meters,
                     CASE WHEN physicalid % 3 = 0 THEN CAST(physicalid % 700 AS DOUBLE) END AS traffic_volume,
                     CASE WHEN physicalid % 4 = 0 THEN CAST(physicalid % 3 * 5 + 20 AS DOUBLE) END AS speed_limit
              FROM all_streets""",
    parted=f"SELECT *, row_number() OVER (PARTITION BY percentile ORDER BY {HASH.format(id='physicalid', seed=42)}, physicalid) "
           "<= ceil(count(*) OVER (PARTITION BY percentile) * 0.2) AS is_test FROM legacy"))
def _(spark, sf_dir):
    cleaned = mo.legacy_cleaning(legacy_table(spark, sf_dir), row_id="physicalid")
    table = cleaned.select(
        "physicalid", "is_test", "has_bike_lane", "has_volume_meas", "has_parking", "speed_limit", "traffic_volume",
        "st_width", *_LEGACY_OUT,
    )
    return rounded(table, {c: 6 for c in ("traffic_volume", "st_width", *_LEGACY_OUT)})
