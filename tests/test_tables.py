import math
import random
import statistics
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.operators import aggregates, prep, relational, splits, stats


def test_quantiles_match_numpy(spark):
    rng = random.Random(5)
    a = [rng.gauss(0, 100) for _ in range(501)]
    b = [float(rng.choice([1, 1, 1, 2, 900])) for _ in range(500)] + [None]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.column, r.share): r.value for r in aggregates.exact_quantiles(df, ["a", "b"], shares).collect()}
    for name, values in (("a", a), ("b", [v for v in b if v is not None])):
        for s in shares:
            assert got[name, s] == pytest.approx(np.quantile(values, s))


def test_describe_exact_and_estimated(spark):
    df = spark.range(1, 101).selectExpr("cast(id as double) as v", "if(id > 1, 5D, null) as c")
    row = {r.column: r for r in aggregates.describe(df, ["v", "c"]).collect()}
    assert (row["v"].q25, row["v"].q50, row["v"].max) == (25.75, 50.5, 100.0)
    assert (row["c"]["count"], row["c"]["std"], row["c"].q75) == (99, 0.0, 5.0)
    rough = {r.column: r for r in aggregates.describe(df, ["v"], exact=False).collect()}
    assert abs(rough["v"].q50 - 50) <= 1


def test_sums_of_nothing_are_zero_means_are_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 3.0)], "k long, v double")
    row = aggregates.group_agg_named(df, ["k"], {"v": "sum"}, rename={"v": "total"}, keep_null_keys=False).collect()
    assert [(r.k, r.total) for r in row] == [(1, 0.0)]
    assert aggregates.group_agg_named(df, ["k"], {"v": "mean"}).where("k = 1").first().v is None
    with pytest.raises(ValueError):
        aggregates.group_agg_named(df, ["k"], {"v": "median"})


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(v,) for v in (3, 3, 1, 1, 2, None, None, None)], "v long")
    assert spark.range(1).select(aggregates.mode_value(df, "v")).first()[0] == 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9.99, 10)], "v double")
    got = {r.bin: r["count"] for r in aggregates.histogram(df, "v", 10).collect()}
    assert got == {0: 1, 1: 1, 9: 2}
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [(r.bin, r["count"]) for r in aggregates.histogram(same, "v", 10).collect()] == [(0, 2)]


@pytest.mark.parametrize("n", [1, 4, 5, 998, 1003])
def test_split_and_folds_have_exact_sizes(spark, n):
    df = spark.range(n).repartition(7)
    flagged = splits.with_test_flag(df, "id")
    assert flagged.where("is_test").count() == -(-n // 5)
    folds = {r.fold: r["count"] for r in splits.with_fold(df, "id").groupBy("fold").count().collect()}
    assert [folds.get(i, 0) for i in range(5)] == [n // 5 + (i < n % 5) for i in range(5)]


def test_split_is_stable_and_shuffles_no_rows(spark):
    df = spark.range(5000)
    a = splits.with_test_flag(df, "id")
    b = splits.with_test_flag(df.repartition(3), "id")
    assert a.where("is_test").select("id").exceptAll(b.where("is_test").select("id")).isEmpty()
    main = a._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in main and "Window" not in main
    other = splits.with_test_flag(df, "id", seed=7)
    assert not a.where("is_test").select("id").exceptAll(other.where("is_test").select("id")).isEmpty()


def test_stratified_sizes(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, id % 3) as s")
    train, test = splits.stratified_split(df, "id", ["s"])
    sizes = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    tests = {r.s: r["count"] for r in test.groupBy("s").count().collect()}
    assert tests == {s: -(-c // 5) for s, c in sizes.items()}
    assert train.count() + test.count() == 1000


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id long, c string")
    rows = {r.id: (r.c_a, r.c_b) for r in prep.one_hot(df, ["c"]).collect()}
    assert rows == {1: (0, 1), 2: (1, 0), 3: (0, 0)}
    fixed = prep.one_hot_fixed(df, {"c": ["z"]}).collect()
    assert {r.c_z for r in fixed} == {0}


def test_scaler_uses_population_deviation(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "v double, k double")
    scaled = prep.fit_scaler(df, ["v", "k"]).transform(df).collect()
    m, d = statistics.mean(values), statistics.pstdev(values)
    assert sorted(r.v for r in scaled) == pytest.approx([(v - m) / d for v in values])
    assert {r.k for r in scaled} == {0.0}


def test_statistics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "y double, prediction double")
    row = stats.evaluate(df, "y").first()
    assert (row.mse, row.mae) == pytest.approx((2 / 3, 2 / 3))
    assert row.r2 == pytest.approx(1 - 2 / sum((y - 7 / 3) ** 2 for y in (1, 2, 4)))
    matrix = stats.correlation_matrix(df.withColumn("flag", F.col("y") > 1.5), ["y", "flag"]).collect()
    assert {(r.a, r.b): round(r.correlation, 6) for r in matrix} == {
        ("y", "y"): 1.0, ("flag", "flag"): 1.0, ("y", "flag"): 0.755929, ("flag", "y"): 0.755929
    }


def test_spread_join_keeps_every_row(spark, monkeypatch):
    from curbline.operators import spatial_join

    monkeypatch.setattr(spatial_join, "HOT_KEY_ROWS", 50)
    df = spark.range(1000).selectExpr("if(id < 400, 1, id) as k", "id as v", "id as w")
    got = relational.replace_by_group_values(df, "k", ["v"])
    assert got.count() == 1000 and got.where("k = 1").select("v").distinct().first()[0] == 399


def test_rows_around_min(spark):
    df = spark.range(100).selectExpr("id", "abs(id - 37) as v")
    assert [r.id for r in relational.rows_around_min(df, "id", "v", 3).orderBy("id").collect()] == [34, 35, 36, 37, 38, 39]


def test_before_after_join_keeps_every_pair_of_a_repeated_key(spark):
    rows = [(1, False, 1.0), (1, False, 2.0), (1, True, 10.0), (1, True, 20.0), (2, False, 3.0), (3, True, None), (3, False, 1.0)]
    df = spark.createDataFrame(rows, "key int, flag boolean, value double")
    pairs = relational.before_after_left_join(df, "key", "flag", "value", ("before", "after"))
    assert sorted(map(tuple, pairs.collect())) == [(1, b, a) for b in (1.0, 2.0) for a in (10.0, 20.0)]
    single = df.where("value IN (1, 10) AND key = 1")
    assert relational.before_after_left_join(single, "key", "flag", "value", ("before", "after"), unique=True).collect() == [(1, 1.0, 10.0)]


def test_quantiles_next_to_an_outlier(spark):
    values = [float(v) for v in np.random.default_rng(3).normal(0, 1, 5000)] + [1e300, -1e300, 1e300]
    df = spark.createDataFrame([(v, 7.0) for v in values], "a double, b double")
    shares = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.column, r.share): r.value for r in aggregates.exact_quantiles(df, ["a", "b"], shares).collect()}
    for share in shares:
        assert got["a", share] == pytest.approx(np.quantile(values, share), rel=1e-12)
        assert got["b", share] == 7.0


def test_images_sort_as_numbers(spark):
    rng = random.Random(12)
    values = [0.0, -0.0, 5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, float("inf")]
    values += [math.ldexp(m, e) for e in range(-1073, 1024, 7) for m in (0.5, 0.5 + 2.0**-53, 1 - 2.0**-53)]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(62)))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v * s,) for v in values for s in (1, -1)], "v double")
    for r in df.withColumn("image", aggregates.ordered_image(F.col("v"))).collect():
        assert aggregates.number_of_image(r.image) == r.v
        assert r.image == (-1 if r.v < 0 else 1) * struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]


def test_quantiles_with_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1.0, -inf, nan, None), (2.0, 1.0, nan, None), (nan, inf, nan, None), (None, inf, None, None)],
        "a double, b double, c double, d double")
    got = {(r.column, r.share): r.value for r in aggregates.exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.5, 1.0]).collect()}
    assert got == {("a", 0.0): 1.0, ("a", 0.5): 1.5, ("a", 1.0): 2.0, ("b", 0.0): -inf, ("b", 0.5): inf, ("b", 1.0): inf}
    row = {r.column: r for r in aggregates.describe(df, ["a", "c"]).collect()}
    assert (row["a"]["count"], row["a"]["mean"], row["a"].q50, row["a"].max) == (2, 1.5, 1.5, 2.0)
    assert (row["c"]["count"], row["c"]["mean"], row["c"].q50) == (0, None, None)
    rough = aggregates.describe(df, ["a"], exact=False).collect()[0]
    assert (rough["count"], rough.max) == (2, 2.0)


def test_quantile_passes_do_not_depend_on_the_values(spark, monkeypatch):
    calls, inner = [], aggregates._next_digit
    monkeypatch.setattr(aggregates, "_next_digit", lambda *a: calls.append(a[2]) or inner(*a))
    df = spark.createDataFrame([(float(i) ** 9 - 1e-300 * i,) for i in range(-300, 300)], "v double")
    values = [r.v for r in df.collect()]
    got = {r.share: r.value for r in aggregates.exact_quantiles(df, ["v"], [0.1, 0.9]).collect()}
    assert calls == [48, 32, 16, 0]
    assert got == {s: pytest.approx(np.quantile(values, s), rel=1e-12) for s in (0.1, 0.9)}


def test_one_hot_limit_is_the_callers(spark):
    df = spark.createDataFrame([(str(i),) for i in range(12)], "c string")
    with pytest.raises(ValueError):
        prep.one_hot(df, ["c"], most=10)
    assert len(prep.one_hot(df, ["c"], most=None).columns) == 12
