"""Bloom filters ahead of a join, and tables kept in buckets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.enrich import enrich_orders
from tallybrook.operators.prefilter import _filter, may_match
from tallybrook.sources.buckets import open_bucketed, write_bucketed
from tests.test_digests import rows
from tests.test_plans import final_plan


def exchanges(df):
    """(rows, bytes) that each exchange of the plan that was run wrote."""
    df.collect()
    out = {}

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange":
            metrics = node.metrics()
            out[node.id()] = tuple(metrics.apply(m).value() for m in ("shuffleRecordsWritten", "shuffleBytesWritten"))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return list(out.values())


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "date", "decimal(20,3)", "double"])
@pytest.mark.parametrize("bits", [64, 1 << 14])
def test_no_row_with_a_partner_is_lost(spark, kind, bits):
    as_kind = F.expr(f"cast(timestamp_seconds(86400 * id) as {kind})" if kind == "date" else f"cast(id as {kind})")
    keys = spark.range(0, 300, 3).select(as_kind.alias("k"))
    left = spark.range(1000).select(as_kind.alias("k"), "id").unionByName(spark.sql(f"SELECT cast(NULL AS {kind}) AS k, 1L AS id"))
    kept = may_match(left, keys, "k", bits=bits)
    assert rows(kept.join(keys, "k")) == rows(left.join(keys, "k"))
    assert kept.where("k is null").isEmpty()
    if bits > 64:
        assert kept.count() < 100 + 30


def test_filter_is_one_row_of_fixed_size(spark):
    for n in (0, 5, 10_000):
        (row,) = _filter(spark.range(n).withColumnRenamed("id", "k"), F.col("k"), 1 << 12).collect()
        assert len(row["words"]) == 64
        assert (n > 0) == any(row["words"])


def test_no_key_at_all(spark):
    left = spark.range(10)
    assert may_match(left, left.limit(0), "id").isEmpty()
    assert may_match(left.limit(0), left, "id").isEmpty()
    assert may_match(left, spark.sql("SELECT cast(NULL AS BIGINT) AS other"), "id", "other").isEmpty()


def test_widths_may_differ_but_not_types(spark):
    left, right = spark.sql("SELECT 1 AS `a.k`"), spark.sql("SELECT 1L AS k")
    assert may_match(left, right, "a.k", "k").count() == 1
    with pytest.raises(ValueError, match="types bigint and string"):
        may_match(right, spark.sql("SELECT '1' AS k"), "k")
    for bits in (63, 100, 1 << 40):
        with pytest.raises(ValueError, match="power of two"):
            may_match(right, right, "k", bits=bits)


@pytest.fixture
def half_unknown(spark):
    clients = spark.range(2000).selectExpr("id AS clientId", "concat('c', id) AS name")
    orders = spark.range(40_000).selectExpr(
        "id AS orderId", "CASE WHEN id % 2 = 0 THEN id % 1999 ELSE 1000000 + id END AS clientId", "id / 8 AS amount"
    )
    return clients, orders


@pytest.mark.parametrize("strategy", ["auto", "clients", "sliced", "buckets"])
def test_enrichment_is_the_same_with_a_filter(half_unknown, strategy):
    plain = enrich_orders(*half_unknown)
    assert rows(enrich_orders(*half_unknown, strategy=strategy, bloom_bits=1 << 16)) == rows(plain)


def test_fewer_bytes_are_shuffled(spark, half_unknown):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        plain = max(exchanges(enrich_orders(*half_unknown)))
        filtered = max(exchanges(enrich_orders(*half_unknown, bloom_bits=1 << 16)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plain[0] >= 40_000 and filtered[0] < 0.6 * plain[0]
    assert filtered[1] < 0.7 * plain[1]


class TestBuckets:
    @pytest.fixture
    def place(self, tmp_path):
        return str(tmp_path / "kept it's")

    @pytest.fixture
    def no_broadcast(self, spark):
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(name, -1)
        yield
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)

    def test_clients_do_not_move(self, spark, half_unknown, place, no_broadcast):
        clients, orders = half_unknown
        kept = write_bucketed(clients, "kept_clients", place, "clientId", 4)
        enriched = enrich_orders(kept, orders, strategy="buckets")
        assert rows(enriched) == rows(enrich_orders(clients, orders))
        plan = final_plan(enriched)
        # orders move twice: summed up per task, and themselves
        assert plan.count("Exchange hashpartitioning") == 2
        assert all(written > 2000 or written == 0 for written, _ in exchanges(enriched))
        assert "Bucketed: true" in plan

    def test_opened_by_another_session(self, spark, half_unknown, place, no_broadcast):
        clients, orders = half_unknown
        write_bucketed(clients, "kept_once", place, "clientId", 4)
        spark.sql("DROP TABLE kept_once")
        again = open_bucketed(spark, "kept_again", place, clients.schema, "clientId", 4)
        assert rows(again) == rows(clients)
        assert final_plan(enrich_orders(again, orders, strategy="buckets")).count("Exchange hashpartitioning") == 2

    def test_a_bucket_is_one_file(self, spark, half_unknown, place, tmp_path):
        write_bucketed(half_unknown[0], "kept_files", place, "clientId", 8)
        assert len(list(tmp_path.rglob("part-*.parquet"))) == 8
        write_bucketed(half_unknown[0].limit(3), "kept_files", place, "clientId", 2)
        assert spark.table("kept_files").count() == 3

    def test_null_and_repeated_ids(self, spark, place):
        rng = random.Random(1)
        ids = [rng.choice([None, 1, 2, 3]) for _ in range(60)]
        clients = spark.createDataFrame([(i, "n") for i in ids], "clientId int, name string")
        orders = spark.createDataFrame([(k, i, 1.5) for k, i in enumerate(ids)], "orderId int, clientId int, amount double")
        kept = write_bucketed(clients, "kept_nulls", place, "clientId", 4)
        assert rows(enrich_orders(kept, orders, strategy="buckets")) == rows(enrich_orders(clients, orders))

    def test_wrong_number(self, spark, place):
        with pytest.raises(ValueError, match="0 buckets"):
            write_bucketed(spark.range(1), "kept_none", place, "id", 0)
