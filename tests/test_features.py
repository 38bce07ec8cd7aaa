from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curbline.operators import intervals, point_features, relational
from curbline.operators.point_features import PointFeature
from tests.test_geometry import line

T = datetime
HORIZON = (T(2012, 7, 1), T(2024, 4, 1))


@pytest.fixture(scope="module")
def streets(spark):
    """Street 1 split at 2018-01-01, street 2 whole, street 3 far from everything."""
    rows = line(spark, [(1, [[(0, 0), (100, 0), (200, 0)]]), (2, [[(0, 40), (100, 40)]]), (3, [[(9000, 0), (9100, 0)]])])
    dates = spark.createDataFrame([(1, T(2018, 1, 1)), (2, None), (3, None)], "id long, t timestamp_ntz")
    split = intervals.validity_split(rows.join(dates, "id"), "t", "has", horizon=HORIZON)
    return split.withColumnRenamed("id", "physicalid")


def crashes(spark):
    rows = [
        (1, 100.0, 5.0, T(2017, 5, 5), 2.0),
        (2, 100.0, 5.0, T(2018, 1, 1), 4.0),  # on the installation day: before
        (3, 100.0, 5.0, T(2018, 1, 2), None),
        (4, 150.0, -5.0, None, 8.0),  # undated
        (5, 50.0, 20.0, T(2019, 1, 1), 16.0),  # near streets 1 and 2
    ]
    return spark.createDataFrame(rows, "cid long, x double, y double, t timestamp_ntz, v double")


def run(spark, streets, **options):
    keys = ["physicalid", "after", "until"]
    feature = PointFeature("value", crashes(spark), **options)
    rows = point_features.point_feature_aggregate(feature, streets, keys).collect()
    return {(r.physicalid, r.after.year): r.value for r in rows}


def test_validity_rows(streets):
    rows = sorted((r.physicalid, r.after, r.until, r.has) for r in streets.drop("geometry").collect())
    assert rows == [
        (1, T(2012, 7, 1), T(2018, 1, 1), False),
        (1, T(2018, 1, 1), T(2024, 4, 1), True),
        (2, T(2012, 7, 1), T(2024, 4, 1), False),
        (3, T(2012, 7, 1), T(2024, 4, 1), False),
    ]


@pytest.mark.parametrize("place", [{"collapse": True}, {"collapse": False, "point_id": "cid"}])
def test_methods_and_operations(spark, streets, place):
    dated = {"date_column": "t", "split_by_date": True}
    value = {"method": "value", "value_column": "v"}
    assert run(spark, streets, **place) == {(1, 2012): 5, (1, 2018): 5, (2, 2012): 1, (3, 2012): 0}
    assert run(spark, streets, **dated, **place) == {(1, 2012): 2, (1, 2018): 2, (2, 2012): 1, (3, 2012): 0}
    assert run(spark, streets, **value, operation="max", **place) == {
        (1, 2012): 16, (1, 2018): 16, (2, 2012): 16, (3, 2012): None
    }
    assert run(spark, streets, **value, operation="mean", **place) == {
        (1, 2012): 7.5, (1, 2018): 7.5, (2, 2012): 16, (3, 2012): None
    }
    # outside the interval a value counts as 0, inside a missing value is skipped
    assert run(spark, streets, **value, **dated, operation="mean", **place) == {
        (1, 2012): 6 / 5, (1, 2018): 16 / 4, (2, 2012): 16, (3, 2012): 0
    }
    assert run(spark, streets, **value, **dated, operation="max", **place) == {
        (1, 2012): 4, (1, 2018): 16, (2, 2012): 16, (3, 2012): 0
    }


def test_sum_over_streets_equals_pairs(spark, streets):
    from curbline.operators.spatial_join import spatial_pairs

    lines = streets.select("physicalid", "geometry").dropDuplicates(["physicalid"])
    pairs = spatial_pairs(crashes(spark).select("cid", "x", "y"), lines, 30.0, point_id="cid").count()
    total = point_features.point_feature_aggregate(PointFeature("n", crashes(spark)), lines).agg(F.sum("n")).first()[0]
    assert pairs == total == 6


def test_weighted_and_binary(spark):
    lines = line(spark, [(1, [[(0, 0), (200, 0)]]), (2, [[(210, 0), (400, 0)]])]).withColumnRenamed("id", "physicalid")
    pts = spark.createDataFrame([(100.0, 1.0), (205.0, 1.0), (395.0, 0.0)], "x double, y double")
    def value(method):
        rows = point_features.point_feature_aggregate(PointFeature("v", pts, method=method), lines).collect()
        return {r.physicalid: r.v for r in rows}

    # the middle crossing touches both streets (weight 1/2), the right end one street (weight 1)
    assert value("weighted") == {1: 1.5, 2: 1.5}
    assert value("binary") == {1: 1.0, 2: 0.0}


def test_arguments_are_checked_early(spark):
    pts = crashes(spark)
    with pytest.raises(ValueError):
        PointFeature("v", pts, method="nearest")
    with pytest.raises(ValueError):
        PointFeature("v", pts, operation="median")
    with pytest.raises(TypeError):
        PointFeature("v", pts, method="value")
    with pytest.raises(TypeError):
        PointFeature("v", pts, split_by_date=True)
    with pytest.raises(ValueError):
        intervals.linear_feature_flag(pts, pts, "f", feature_id="cid", date_column="t", predicate="touches")


def test_linear_feature_takes_the_newest_date(spark):
    lines = line(spark, [(1, [[(0, 0), (100, 0)]]), (2, [[(0, 500), (100, 500)]])])
    humps = line(spark, [(1, [[(-10, 5), (110, 5)]]), (2, [[(-10, -5), (110, -5)]]), (3, [[(0, 500), (40, 500)]])])
    dates = spark.createDataFrame([(1, T(2015, 1, 1)), (2, T(2016, 1, 1)), (3, T(2017, 1, 1))], "id long, d timestamp_ntz")
    rows = intervals.linear_feature_flag(
        humps.join(dates, "id").withColumnRenamed("id", "hid"), lines.withColumnRenamed("id", "physicalid"),
        "has", feature_id="hid", date_column="d",
    )
    got = sorted((r.physicalid, r.after.year, r.until.year, r.has) for r in rows.collect())
    assert got == [(1, 2012, 2016, False), (1, 2016, 2024, True), (2, 2012, 2024, False)]


def test_interval_join_counts_only_inside(spark):
    rows = spark.createDataFrame([(1, T(2012, 1, 1), T(2013, 1, 1)), (1, T(2013, 1, 1), T(2014, 1, 1)), (2, T(2012, 1, 1), T(2014, 1, 1))],
                                 "k long, after timestamp_ntz, until timestamp_ntz")
    events = spark.createDataFrame([(1, T(2012, 1, 1)), (1, T(2013, 1, 1)), (1, T(2013, 1, 1)), (1, T(2013, 5, 1)), (1, None), (7, T(2013, 1, 1))],
                                   "k long, t timestamp_ntz")
    got = intervals.interval_join(rows, events, "k", "t", keys=["k", "after", "until"], name="n").collect()
    assert sorted((r.k, r.after.year, r.n) for r in got) == [(1, 2012, 2), (1, 2013, 1), (2, 2012, 0)]


def test_blank_names(spark):
    df = spark.createDataFrame([(1, "  "), (2, ""), (3, None), (4, " x ")], "id long, off_street_name string")
    assert [r.id for r in relational.off_street_rows(df).orderBy("id").collect()] == [2, 4]


def test_first_row_per_key_ignores_partitioning(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id * 7919 % 1000 as v", "cast(id as string) as s")
    want = {r.k: r.s for r in df.collect() if r.v == min(x.v for x in df.collect() if x.k == r.k)}
    for n in (1, 5):
        got = relational.drop_duplicates_first(df.repartition(n), ["k"], ["v"]).collect()
        assert {r.k: r.s for r in got} == want
