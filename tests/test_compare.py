"""Two-way difference."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallybrook.operators import compare
from tallybrook.operators.compare import diff, diff_counts, same_rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id INT, t STRING")


def tagged(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_duplicates_count(spark):
    once, twice = frame(spark, [(1, "a")]), frame(spark, [(1, "a"), (1, "a")])
    assert not same_rows(once, twice)
    assert tagged(diff(once, twice)) == [(1, "a", "right")]
    assert tagged(diff_counts(twice, once)) == [(1, "a", "left", 1)]


def test_order_and_nulls_do_not_matter(spark):
    a = frame(spark, [(1, "a"), (None, None), (2, None)])
    b = frame(spark, [(2, None), (1, "a"), (None, None)])
    assert same_rows(a, b)
    assert diff(a, b).count() == 0


@pytest.mark.parametrize("chunk", [1, 3, 1_000_000])
def test_many_copies_are_written_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(compare, "_COPIES_PER_CHUNK", chunk)
    left = frame(spark, [(1, "a")] * 10 + [(2, "b")] * 2)
    right = frame(spark, [(1, "a")] * 3 + [(3, "c")] * 4)
    assert Counter(tuple(r) for r in diff(left, right).collect()) == {
        (1, "a", "left"): 7, (2, "b", "left"): 2, (3, "c", "right"): 4,
    }


def test_different_columns(spark):
    with pytest.raises(ValueError, match="columns differ"):
        diff_counts(spark.range(1), frame(spark, []))


ROWS = st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a"])), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_equals_except_all_both_ways(spark, left, right):
    a, b = frame(spark, left), frame(spark, right)
    got = Counter(tuple(r) for r in diff(a, b).collect())
    want = Counter({(*r, "left"): n for r, n in (Counter(left) - Counter(right)).items()})
    want.update({(*r, "right"): n for r, n in (Counter(right) - Counter(left)).items()})
    assert got == want
    assert Counter(tuple(r) for r in a.exceptAll(b).collect()) == Counter(left) - Counter(right)
    assert same_rows(a, b) == (not want)


def test_any_column_names(spark):
    left = spark.createDataFrame([(1, "a", 1, 2), (1, "a", 1, 2)], "side int, copies string, _sign int, c0 int")
    right = spark.createDataFrame([(1, "a", 1, 2), (2, "b", 1, 2)], left.schema)
    counts = diff_counts(left, right, side="where", copies="n")
    assert counts.columns == [*left.columns, "where", "n"]
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 1, 2, "left", 1), (2, "b", 1, 2, "right", 1)]
    assert sorted(map(tuple, diff(left, right, side="where").collect())) == [
        (1, "a", 1, 2, "left"), (2, "b", 1, 2, "right"),
    ]
    assert not same_rows(left, right)
    for call in (diff, diff_counts):
        with pytest.raises(ValueError, match="other name"):
            call(left, right)
