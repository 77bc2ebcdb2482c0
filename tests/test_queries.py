"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.oracle import normal, sql_rows


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == [
        "clientId", "name", "location", "orderId", "amount", "date", "totalAmountByClient",
    ]
    assert df.count() == 1500


# The text operators have tests of their own.
CORE = [name for name in driver.queries() if name not in driver.LLM_QUERIES]


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    got = df.collect()
    names, expected = sql_rows(driver.oracle_sql()[name], sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert normal([tuple(r) for r in got], df.columns) == normal(expected, names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
