"""Differences by bucket digests: the same rows as the plain difference, fewer of them moved."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.compare import diff, diff_counts
from tallybrook.operators.digests import (
    bucket_digests,
    differing_buckets,
    digest_diff,
    digest_diff_counts,
    same_digests,
)

SCHEMA = "id int, name string, amount double, tags array<string>, at struct<x:int,y:string>"


def rows(df):
    return Counter(map(str, df.collect()))


def some_rows(seed, n=300):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([*values, None])
    return [
        (pick(1, 2, 3), pick("", "a", "b"), pick(0.0, -0.0, float("nan"), 2.5),
         pick([], [None], ["a", None], [None, "a"]), pick((1, None), (None, "1"), (None, None)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_same_rows_as_the_plain_difference(spark, buckets):
    left, right = (spark.createDataFrame(some_rows(s), SCHEMA).repartition(3) for s in (1, 2))
    assert rows(digest_diff_counts(left, right, buckets=buckets)) == rows(diff_counts(left, right))
    assert rows(digest_diff(left, right, buckets=buckets)) == rows(diff(left, right))
    assert not same_digests(left, right, buckets=buckets)


def test_equal_up_to_order_and_partitions(spark):
    data = some_rows(3) * 2
    left = spark.createDataFrame(data, SCHEMA).repartition(4)
    right = spark.createDataFrame(random.Random(1).sample(data, len(data)), SCHEMA).coalesce(1)
    assert same_digests(left, right)
    assert digest_diff(left, right).isEmpty()


@pytest.mark.parametrize("change", [
    lambda d: d[:-1], lambda d: [*d, d[0]], lambda d: [*d[1:], d[1]],
])
def test_one_row_more_less_or_other(spark, change):
    data = some_rows(4, 50)
    left, right = spark.createDataFrame(data, SCHEMA), spark.createDataFrame(change(data), SCHEMA)
    assert rows(digest_diff_counts(left, right)) == rows(diff_counts(left, right))
    assert same_digests(left, right) == (not rows(diff(left, right)))


@pytest.mark.parametrize("kind, a, b", [
    ("x int, y int", (1, None), (None, 1)),
    ("x string, y string", ("ab", "c"), ("a", "bc")),
    ("x array<int>", ([1, None],), ([None, 1],)),
    ("x array<int>", ([],), (None,)),
    ("x array<array<int>>", ([[1], []],), ([[], [1]],)),
    ("x struct<a:int,b:int>", ((1, None),), ((None, 1),)),
    ("x struct<a:int>", ((None,),), (None,)),
    ("x array<struct<a:int,b:string>>", ([(None, "1")],), ([(1, None)],)),
])
def test_nulls_count_where_they_stand(spark, kind, a, b):
    left, right = spark.createDataFrame([a], kind), spark.createDataFrame([b], kind)
    assert not same_digests(left, right)
    assert same_digests(left, left)
    assert rows(digest_diff(left, right)) == rows(diff(left, right))


def test_types_are_those_of_the_union(spark):
    left, right = spark.sql("SELECT 1 AS x, 2L AS y"), spark.sql("SELECT 1L AS x, 2 AS y")
    assert same_digests(left, right)
    assert digest_diff(left, right).isEmpty()


def test_empty_sides_and_names_in_use(spark):
    some = spark.createDataFrame([(1, 2, 3)], "bucket int, `a.b` int, c0 int")
    assert rows(digest_diff_counts(some, some.limit(0))) == rows(diff_counts(some, some.limit(0)))
    assert digest_diff(some.limit(0), some.limit(0)).isEmpty()
    assert rows(digest_diff(some, some.withColumn("c0", F.lit(9)))) == rows(diff(some, some.withColumn("c0", F.lit(9))))


def test_wrong_arguments(spark):
    with pytest.raises(ValueError, match="columns differ"):
        same_digests(spark.range(1), spark.range(1).toDF("x"))
    with pytest.raises(ValueError, match="maps"):
        bucket_digests(spark.sql("SELECT map(1, 2) AS m"))


def shuffled_rows(df):
    """Rows written to shuffles by all exchanges of the plan that was run."""
    df.collect()
    seen, total = set(), []

    def walk(node):
        name = node.nodeName()
        if name in ("AdaptiveSparkPlan",):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name in ("Exchange",) and node.id() not in seen:
            seen.add(node.id())
            metrics = node.metrics()
            total.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(total)


def test_equal_tables_shuffle_digests_alone(spark):
    table = spark.range(200_000).selectExpr("id", "concat('name ', id) AS name")
    other = table.repartition(5)
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    other = other.checkpoint()
    equal = digest_diff_counts(table, other, buckets=64)
    plan = equal._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan
    assert shuffled_rows(equal) <= 2 * 64 * 12
    changed = other.where("id != 77")
    few = digest_diff_counts(table, changed, buckets=64)
    assert [tuple(r) for r in few.collect()] == [(77, "name 77", "left", 1)]
    assert shuffled_rows(few) < 2 * 64 * 12 + 3 * 200_000 / 64


def test_digest_rows_are_at_most_the_buckets(spark):
    table = spark.range(10_000).union(spark.range(5))
    assert bucket_digests(table, 16).count() == 16
    assert differing_buckets(table, spark.range(10_000), 16).count() <= 5
