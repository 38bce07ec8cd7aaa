"""Registered queries against their SQL."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from curbline.checks.registry import ORACLES
from tests.oracle import connect, difference

# models that the few rows of the smallest data set do not determine, and more neighbours than it has rows
NEEDS_MORE_ROWS = {
    "knn_grid_search", "cv_results_table", "best_knn", "hump_effect_coefficients", "hump_effect_holdout", "hump_effect_cv",
    "cross_val_quadratic",
}


@pytest.fixture(scope="module")
def duck():
    return {}


@pytest.mark.parametrize("name", sorted(ORACLES, key=lambda n: n in NEEDS_MORE_ROWS))
def test_query_equals_sql(spark, sf_dir, duck, name):
    folder = os.path.join(os.path.dirname(sf_dir), "sf0.01") if name in NEEDS_MORE_ROWS else sf_dir
    found = queries()[name](spark, folder).toPandas()
    tables = duck.setdefault(folder, connect(folder))
    assert difference(found, tables.execute(oracle_sql()[name]).df()) is None


def test_no_measured_volume_gives_an_empty_leaderboard(spark, sf_dir):
    assert queries()["model_comparison_measured"](spark, sf_dir).collect() == []


def test_entry_and_registry(spark):
    named, sqls = queries(), oracle_sql()
    assert set(sqls) <= set(named) and len(named) > 120
    table = entry(spark)
    assert {"physicalid", "has_humps", "collision_rate"} <= set(table.columns)
