"""Training and comparing the regression models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.transforms import feature_preprocessor, log1p_columns, per_tree_ratios
from curbline.operators import knn, models
from curbline.operators.ensembles import StoredForest, few_partitions, fit_forest, side_by_side
from curbline.operators.linear import cross_val_linear, lasso_path, least_squares
from curbline.operators.prep import categories_of, fit_impute_mean
from curbline.operators.relational import is_present_flag, positive_flag, street_type_flags
from curbline.operators.sparse_linear import cross_val_categories, fit_categories
from curbline.operators.splits import stratified_split, train_test_split, with_fold
from curbline.operators.stats import evaluate, mse
from curbline.session import settle

FittedModel = PipelineModel | StoredForest | knn.KnnModel

LABEL = "collision_rate_per_length"
DEFAULT_SPEED_LIMIT = 25.0
DEFAULT_HOUR = 16


@dataclass(frozen=True)
class SuiteSettings:
    k: int = 25
    knn_weights: str = "distance"
    forest_trees: int = 100
    forest_min_leaf: int = 5
    forest_depth: int = 30
    boosting_trees: int = 100
    boosting_depth: int = 5
    boosting_rate: float = 0.1


def with_volume(dataset: DataFrame) -> DataFrame:
    """The modelling subset: streets with a traffic volume."""
    return dataset.where(F.col("has_volume_meas"))


def train_suite(
    train: DataFrame, *, row_id: str = "row_id", label: str = LABEL, settings: SuiteSettings = SuiteSettings()
) -> dict[str, FittedModel]:
    """The five kinds of models, fitted side by side on the same rows: boosting waits for its own steps most of the time."""
    s = settings
    boosted = models.boosted_trees(
        label, trees=s.boosting_trees, max_depth=s.boosting_depth, rate=s.boosting_rate
    )
    fits = {
        "baseline": lambda: models.fit_mean(train, label),
        "linear": lambda: models.fit_linear(train, label),
        "knn": lambda: knn.fit_knn(train, models.KNN_FEATURES, label, row_id=row_id, k_max=s.k),
        "random_forest": lambda: fit_forest(
            train, label, models.RAW_FEATURES, trees=s.forest_trees, min_leaf=s.forest_min_leaf, max_depth=s.forest_depth
        ),
        "boosting": lambda: models.fit_trees(train.coalesce(few_partitions(train, len(models.RAW_FEATURES))), boosted),
    }
    fitted = side_by_side(lambda kind: fits[kind](), fits, len(fits), train.sparkSession)
    return dict(zip(fits, fitted))


def predict(
    model: FittedModel, df: DataFrame, *, row_id: str = "row_id", label: str = LABEL,
    weights: str = "distance",
) -> DataFrame:
    """``row_id``, label and ``prediction`` of any of the models."""
    if isinstance(model, knn.KnnModel):
        found = knn.knn_predict(model, df, query_id=row_id, weights=[weights])
        return df.select(row_id, label).join(found.select(row_id, "prediction"), row_id)
    return model.transform(df).select(row_id, label, "prediction")


def model_leaderboard(
    fitted: dict[str, FittedModel], test: DataFrame, *, row_id: str = "row_id", label: str = LABEL,
    weights: str = "distance",
) -> DataFrame:
    """Hold-out MSE per model, best first."""
    scores = None
    for name, model in fitted.items():
        scored = predict(model, test, row_id=row_id, label=label, weights=weights).agg(mse(label).alias("mse"))
        scored = scored.select(F.lit(name).alias("model"), "mse")
        scores = scored if scores is None else scores.unionByName(scored)
    return scores.orderBy("mse")


def train_and_compare(
    dataset: DataFrame, folder: str, *, row_id: str = "row_id", label: str = LABEL, seed: int = 42,
    settings: SuiteSettings = SuiteSettings(),
) -> tuple[dict[str, FittedModel], DataFrame]:
    """From the street table to the leaderboard: streets with a volume are split, the five models are
    trained on the larger part, stored in ``folder``, loaded again and scored on the smaller part. Without such
    streets there are no models and the leaderboard is empty."""
    spark = dataset.sparkSession
    train, test = train_test_split(settle(with_volume(dataset), "with-volume"), row_id, seed=seed)
    train, loaded = settle(train, "train"), {}
    if train.isEmpty():
        return loaded, spark.createDataFrame([], "model string, mse double")
    for kind, model in train_suite(train, row_id=row_id, label=label, settings=settings).items():
        models.save_model(model, folder, kind, spark)
        loaded[kind] = models.load_model(folder, kind, spark)
    return loaded, model_leaderboard(loaded, settle(test, "test"), row_id=row_id, label=label, weights=settings.knn_weights)


def legacy_cleaning(
    dataset: DataFrame, *, row_id: str, strata: str = "percentile", seed: int = 42
) -> DataFrame:
    """Stratified split with the derived columns of the older study, both parts with ``is_test``.

    Means are taken from the training part only and used for both parts. ``bike_lane`` is text
    with 'nan' for none; widths of 0 count as missing.
    """
    flagged = street_type_flags(
        positive_flag(is_present_flag(dataset, "traffic_volume", "has_volume_meas"), "n_parking_meters", "has_parking")
    ).withColumn("has_bike_lane", F.col("bike_lane") != "nan")
    train, test = stratified_split(flagged, row_id, [strata], seed=seed)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    both = settle(both, "legacy")
    known = both.where(~F.col("is_test"))
    filled = fit_impute_mean(known, ["traffic_volume"]).transform(both)
    filled = fit_impute_mean(known, ["st_width"], missing_value=0.0).transform(filled)
    filled = filled.fillna({"speed_limit": DEFAULT_SPEED_LIMIT})
    logged = log1p_columns(filled, ["n_trees", "shape_leng", "st_width", "traffic_volume"]).withColumnsRenamed(
        {"log_n_trees": "log_trees", "log_shape_leng": "log_leng", "log_st_width": "log_width"}
    )
    return per_tree_ratios(logged).withColumn(
        "inv_trees", F.try_divide(F.lit(1.0), F.col("log_trees") + 1)
    )


HOURLY_NUMBERS = {
    "hour": f"cast(coalesce(hour, {DEFAULT_HOUR}) as double)",
    "humps": "coalesce(humps, 0D)",
    **{c: f"cast({c} as double)" for c in ("shape_leng", "st_width", "postvz_sl")},
}
HOURLY_CATEGORIES = ("rw_type", "bike_lane", "trafdir")


def hourly_features(hourly: DataFrame, most: int | None = None) -> dict[str, str]:
    """Name to expression: numbers with their fills, one indicator per road type, lane and
    direction. ``most`` refuses categories of more values; ``hourly_crash_model`` makes no indicators."""
    features = dict(HOURLY_NUMBERS)
    for column in HOURLY_CATEGORIES:
        for value in categories_of(hourly, column, most):
            quoted = str(value).replace("'", "''")
            features[f"{column}_{value}"] = f"if({column} <=> '{quoted}', 1D, 0D)"
    return features


def hourly_crash_model(hourly: DataFrame, *, label: str = "crashes", seed: int = 42) -> DataFrame:
    """Least squares on crashes per street and hour against the mean: cross-validated MSE on the
    training part and MSE on the hold-out part. ``hourly`` needs ``street``, the key of the street
    row, since raw streets repeat ``physicalid``; rows with a missing number are left out. Road type, lane and
    direction may have any number of values."""
    keyed = hourly.dropna(subset=["shape_leng", "st_width", "postvz_sl", label]).withColumn(
        "row_id", F.pmod(F.xxhash64("street", F.coalesce("hour", F.lit(24))), F.lit(1 << 53))
    )
    train, test = train_test_split(settle(keyed, "hourly"), "row_id", seed=seed)
    train = settle(with_fold(train, "row_id", seed=seed), "hourly-train")
    numbers = list(HOURLY_NUMBERS.values())
    baseline_cv = models.cross_val_score(train, label, "fold", lambda df: models.fit_mean(df, label))
    linear_cv = cross_val_categories(train, numbers, HOURLY_CATEGORIES, label, "fold")
    rows = None
    for name, cv, model in (
        ("baseline", baseline_cv, models.fit_mean(train, label)),
        ("linear", linear_cv, fit_categories(train, numbers, HOURLY_CATEGORIES, label)),
    ):
        held_out = model.transform(test).agg(mse(label).alias("test_mse"))
        row = cv.agg(F.avg("mse").alias("cv_mse")).join(held_out).select(
            F.lit(name).alias("model"), "cv_mse", "test_mse"
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


HUMP_EFFECT_FEATURES = (
    "collisions_per_week_before", "has_bike_lane", "trees_per_leng", "trees_per_vol", "speed_limit",
)
#: All street columns and the ratios made of them.
HUMP_EFFECT_COLUMNS = (
    "collisions_per_week_before", "bike_lane", "road_leng", "st_width", "vol", "speed_limit", "tree_count",
    "vol_per_leng", "trees_per_leng", "trees_per_vol",
)


HUMP_EFFECT_LABEL = "collisions_per_week_after"
#: The models of the hump effect: the line on the rate before, the five chosen features, all columns, and all with the
#: lane as a flag.
HUMP_EFFECT_MODELS = {
    "line": HUMP_EFFECT_FEATURES[:1],
    "five_features": HUMP_EFFECT_FEATURES,
    "extended": HUMP_EFFECT_COLUMNS,
    "extended_lane_flag": ("has_bike_lane", *(c for c in HUMP_EFFECT_COLUMNS if c != "bike_lane")),
}


def hump_effect_rows(augmented: DataFrame, features: Sequence[str] = HUMP_EFFECT_FEATURES) -> DataFrame:
    """The features and the rate after of the streets with humps, complete rows only."""
    prepared = feature_preprocessor(augmented, keep=[HUMP_EFFECT_LABEL, *_beside_the_five(features)])
    return prepared.select("physicalid", *features, HUMP_EFFECT_LABEL).dropna()


def _beside_the_five(features: Sequence[str]) -> list[str]:
    return [c for c in features if c not in HUMP_EFFECT_FEATURES]


def _all_features(kinds: dict[str, Sequence[str]]) -> list[str]:
    """Each feature of the models once, so that they are fitted on the same rows."""
    return list(dict.fromkeys(c for features in kinds.values() for c in features))


def _as_numbers(features: Sequence[str]) -> dict[str, str]:
    return {c: f"cast({c} as double)" for c in features}


def fit_hump_effect(augmented: DataFrame, features: Sequence[str] = HUMP_EFFECT_FEATURES) -> PipelineModel:
    """Least squares of the rate after on the features of the streets with humps."""
    return models.fit_linear(hump_effect_rows(augmented, features), HUMP_EFFECT_LABEL, _as_numbers(features))


def hump_effect_coefficients(
    augmented: DataFrame, kinds: dict[str, Sequence[str]] = HUMP_EFFECT_MODELS
) -> DataFrame:
    """``model feature coefficient train_mse``: least squares on the unscaled features, largest magnitude first."""
    rows = settle(hump_effect_rows(augmented, _all_features(kinds)), "hump-rows")
    tables = None
    for name, features in kinds.items():
        table = least_squares(rows, _as_numbers(features), HUMP_EFFECT_LABEL).withColumn("model", F.lit(name))
        tables = table if tables is None else tables.unionByName(table)
    return tables.select("model", "feature", "coefficient", "train_mse").orderBy("model", F.abs("coefficient").desc())


def hump_effect_holdout(
    augmented: DataFrame, kinds: dict[str, Sequence[str]] = HUMP_EFFECT_MODELS, *, seed: int = 42
) -> DataFrame:
    """Hold-out ``mse`` and ``r2`` of each model, fitted on 80 % of the streets."""
    rows = settle(hump_effect_rows(augmented, _all_features(kinds)), "hump-rows")
    train, test = train_test_split(rows, "physicalid", seed=seed)
    scores = None
    for name, features in kinds.items():
        fitted = models.fit_linear(train, HUMP_EFFECT_LABEL, _as_numbers(features))
        row = evaluate(fitted.transform(test), HUMP_EFFECT_LABEL).select(F.lit(name).alias("model"), "mse", "r2")
        scores = row if scores is None else scores.unionByName(row)
    return scores


def hump_effect_cv(
    augmented: DataFrame, kinds: dict[str, Sequence[str]] = HUMP_EFFECT_MODELS, *, seed: int = 42
) -> DataFrame:
    """Cross-validated ``mse`` and ``r2`` per model and fold, one pass per model."""
    rows = settle(with_fold(hump_effect_rows(augmented, _all_features(kinds)), "physicalid", seed=seed), "hump-folds")
    scores = None
    for name, features in kinds.items():
        part = cross_val_linear(rows, list(_as_numbers(features).values()), HUMP_EFFECT_LABEL, "fold")
        part = part.withColumn("model", F.lit(name))
        scores = part if scores is None else scores.unionByName(part)
    return scores


def hump_lasso_path(
    augmented: DataFrame, alphas: Sequence[float], features: Sequence[str] = HUMP_EFFECT_FEATURES, *, seed: int = 42
) -> DataFrame:
    """The lasso path of the hump effect; ``rows_around_min`` gives its best row and the rows around it."""
    rows = settle(with_fold(hump_effect_rows(augmented, features), "physicalid", seed=seed), "hump-folds")
    path = lasso_path(rows, list(_as_numbers(features).values()), HUMP_EFFECT_LABEL, "fold", alphas)
    return path.toDF("alpha", *[f"w_{f}" for f in features], *path.columns[-4:])


def predict_hump_effect(pairs: DataFrame, streets: DataFrame, rate: str) -> DataFrame:
    """``physicalid``, the rate now and the rate expected with humps, for streets without humps:
    the line fitted on the before/after ``pairs`` of streets that got them."""
    line = pairs.agg(
        F.struct(
            F.regr_slope("collisions_per_week_after", "collisions_per_week_before").alias("slope"),
            F.regr_intercept("collisions_per_week_after", "collisions_per_week_before").alias("intercept"),
        )
    ).scalar()
    bare = streets.join(pairs.select("physicalid"), "physicalid", "left_anti")
    return bare.select(
        "physicalid", F.col(rate).alias("rate"),
        (F.col(rate) * line["slope"] + line["intercept"]).alias("expected_rate"),
    )
