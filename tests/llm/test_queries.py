"""Registered queries of this package against their SQL."""

import pytest

from __spark_entry__ import oracle_sql, queries
from curbline.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    found = queries()[name](spark, sf_dir).toPandas()
    assert difference(found, connect(sf_dir).execute(oracle_sql()[name]).df()) is None


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14)) and "pipeline" in QUERIES
