import re

import numpy as np
from pyspark.sql import functions as F

from curbline.checks import model_queries
from curbline.operators import linear


def test_the_steps_of_a_path_are_not_sorted(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 2)) * [1, 3] + 5
    y = x @ [2.0, -1.0] + rng.normal(size=200)
    table = spark.createDataFrame([(*map(float, v), float(t), i % 4) for i, (v, t) in enumerate(zip(x, y))], "a double, b double, y double, fold int")
    path = linear.lasso_path(table, ["a", "b"], "y", "fold", [0.1, 0.5, 2.5])
    found = model_queries.optimality(table, ["a", "b"], "y", path)
    rows = {r.step: (r.n, r.violation) for r in found.collect()}
    assert rows == {step: (200, 0.0) for step in range(3)}
    assert not re.search(r"\b(SortAggregate|ObjectHashAggregate|Sort)\b", found._jdf.queryExecution().executedPlan().toString())
    # a path that is off by 0.1 is seen
    off = model_queries.optimality(table, ["a", "b"], "y", path.withColumn("w_a", F.col("w_a") + 0.1))
    assert off.agg(F.min("violation")).first()[0] > 0.05
