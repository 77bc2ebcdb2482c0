"""Queries with SQL against DuckDB, as the core queries are tested."""

from __future__ import annotations

import pytest

from tallybrook.llm.queries import QUERIES, SQL
from tests.oracle import normal, sql_rows

# op12 has this test beside its others
NAMES = sorted(set(SQL) - {"op12_spelling_variants"})


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names, want = sql_rows(SQL[name], sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(want, names)
