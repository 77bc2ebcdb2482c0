"""Enrichment: every strategy against the plain window query."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallybrook import schemas
from tallybrook.operators import enrich
from tallybrook.operators.enrich import enrich_orders, measured_bytes
from tests.oracle import normal

STRATEGIES = ["auto", "clients", "orders", "buckets", "sliced"]
ORDERS = "orderId INT, clientId INT, amount DOUBLE, date STRING"
DAY = "2024-03-01"


def frames(spark, clients, orders, partitions=3):
    c = spark.createDataFrame(clients, schemas.CLIENTS).repartition(partitions)
    o = spark.createDataFrame(orders, ORDERS).repartition(partitions)
    return c, o


def by_window(clients, orders):
    """The plain form, fine for a few rows: a window over the joined rows."""
    joined = clients.join(orders, "clientId", "left")
    total = F.sum("amount").over(Window.partitionBy("clientId"))
    return joined.withColumn("totalAmountByClient", total)


def rows(df):
    return normal([tuple(r) for r in df.collect()], df.columns)


@pytest.fixture(scope="module")
def shops(spark):
    """Four shops: two orders, three orders, one order of amount 0, none."""
    return frames(
        spark,
        [(70, "Quill", "pier"), (35, "Rook", None), (51, "Sable", "gate"), (18, "Tarn", "pier")],
        [(5001, 35, 0.25, "2022-11-30"), (5002, 70, 64.0, None), (5003, 35, 1024.5, "2022-11-30"),
         (5004, 51, 0.0, "2022-12-01"), (5005, 70, -16.0, "2022-11-02"), (5006, 35, 7.75, None)],
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
class TestEachStrategy:
    def test_one_row_per_order_and_lone_client(self, shops, strategy):
        ids = [r.orderId for r in enrich_orders(*shops, strategy=strategy).collect()]
        assert sorted(ids, key=str) == [5001, 5002, 5003, 5004, 5005, 5006, None]

    def test_output_columns_and_types(self, shops, strategy):
        out = enrich_orders(*shops, strategy=strategy)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in schemas.ENRICHED_ORDERS
        ]

    def test_total_on_every_row_of_a_client(self, shops, strategy):
        out = enrich_orders(*shops, strategy=strategy).collect()
        totals = {(r.clientId, r.orderId): r.totalAmountByClient for r in out}
        assert totals == {
            (35, 5001): 1032.5, (35, 5003): 1032.5, (35, 5006): 1032.5,
            (70, 5002): 48.0, (70, 5005): 48.0, (51, 5004): 0.0, (18, None): None,
        }

    def test_client_without_orders_is_kept(self, shops, strategy):
        (lone,) = enrich_orders(*shops, strategy=strategy).filter("clientId = 18").collect()
        assert tuple(lone) == (18, "Tarn", "pier", None, None, None, None)

    def test_no_orders_at_all(self, spark, strategy):
        c, o = frames(spark, [(61, "Umber", "mill"), (None, "Vale", "mill")], [])
        assert rows(enrich_orders(c, o, strategy=strategy)) == rows(by_window(c, o))

    def test_no_clients_at_all(self, spark, strategy):
        c, o = frames(spark, [], [(11, 1, 5.0, DAY)])
        assert enrich_orders(c, o, strategy=strategy).count() == 0

    def test_edge_rows(self, spark, strategy):
        c, o = frames(
            spark,
            [(None, "n1", "A"), (None, "n2", None), (1, "dup", "A"), (1, "dup", "A"),
             (2, "nulls", "B"), (3, "none", "B"), (4, "part", None)],
            [(10, None, 7.0, DAY), (11, 1, 1.5, DAY), (12, 1, 2.5, DAY), (13, 2, None, DAY),
             (14, 2, None, DAY), (15, 77, 9.0, DAY), (16, 4, None, DAY), (17, 4, 3.0, None)],
        )
        expected = rows(by_window(c, o))
        assert rows(enrich_orders(c, o, strategy=strategy, slice_rows=1)) == expected
        totals = {
            r.clientId: r.totalAmountByClient
            for r in enrich_orders(c, o, strategy=strategy).collect()
        }
        assert totals == {None: None, 1: 8.0, 2: None, 3: None, 4: 3.0}


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("case", ["hot_orders", "hot_copies", "hot_both", "null_ids", "unknown"])
def test_a_third_of_the_rows_in_one_group(spark, strategy, case):
    rng = random.Random(case)
    clients = [(i, f"c{i}", f"l{i % 3}") for i in range(60)]
    orders = [
        (i, rng.randrange(80), float(rng.randrange(1000)) / 4, f"2024-01-{1 + i % 9:02}")
        for i in range(400)
    ]
    same_order = (900, 7, 2.25, DAY)
    if case in ("hot_orders", "hot_both"):
        orders += [(1000 + i, 7, 1.5, DAY) for i in range(100)] + [same_order] * 100
    if case in ("hot_copies", "hot_both"):
        clients += [(7, "copy", "l0")] * 30
    if case == "null_ids":
        clients += [(None, "null", "l0")] * 30
        orders += [(2000 + i, None, 1.0, DAY) for i in range(200)]
    if case == "unknown":
        orders += [(3000 + i, 12345, 1.0, DAY) for i in range(200)]
    c, o = frames(spark, clients, orders, partitions=5)
    got = enrich_orders(c, o, strategy=strategy, slice_rows=10)
    assert rows(got) == rows(by_window(c, o))


def shape_of(clients, orders):
    return enrich._Shape(clients, orders, "clientId", "amount", "totalAmountByClient")


def slots_of(spark, clients, orders, slice_rows):
    """Pairs per slot, as the sliced join makes them."""
    shape = shape_of(*frames(spark, clients, orders, partitions=20))
    seen = []
    real = enrich._in_slots
    try:
        enrich._in_slots = lambda *a: seen.append(real(*a)) or seen[-1]
        enrich._sliced(shape, slice_rows)
    finally:
        enrich._in_slots = real
    named, placed = (df.groupBy("clientId", "_slot").count() for df in seen)
    pairs = named.withColumnRenamed("count", "n").join(placed, ["clientId", "_slot"])
    return [r.n * r["count"] for r in pairs.collect()]


def test_slots_hold_about_a_slice_of_pairs(spark):
    """A third of all orders, half of those exact copies, for one client; copies of another."""
    orders = [(i, 7, 1.0, DAY) for i in range(500)] + [(9, 7, 2.0, DAY)] * 500
    orders += [(i, i % 100, 1.0, DAY) for i in range(2000)]
    clients = [(7, "c7", "l"), (8, "c8", "l")] + [(9, "c9", "l")] * 60
    pairs = slots_of(spark, clients, orders, 100)
    assert sum(pairs) == 1020 + 20 + 60 * 20
    assert max(pairs) < 300


def test_many_ids_just_above_the_bound_are_all_cut(spark):
    orders = [(i, i % 150, 1.0, DAY) for i in range(3300)]
    pairs = slots_of(spark, [(i, "c", "l") for i in range(150)], orders, 20)
    assert sum(pairs) == 3300
    assert max(pairs) < 22


def test_nothing_is_sliced_without_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(enrich, "_in_slots", None)
    c, o = frames(spark, [(i, "a", "l") for i in range(9)], [(i, i, 1.0, DAY) for i in range(9)])
    assert enrich_orders(c, o, strategy="sliced", slice_rows=2).count() == 9


@pytest.mark.parametrize("strategy", ["clients", "orders"])
def test_wanted_broadcast_that_does_not_fit_gives_way(shops, strategy):
    plan = lambda **k: enrich_orders(*shops, strategy=strategy, **k)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan().lower()
    assert "broadcast" not in plan(broadcast_limit=10).lower()
    assert rows(enrich_orders(*shops, strategy=strategy, broadcast_limit=10)) == rows(by_window(*shops))


def test_no_job_runs_before_the_caller_acts(spark, shops):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    enrich_orders(*shops)
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


@pytest.mark.parametrize("strategy", ["auto", "sliced"])
def test_csv_is_read_twice_at_most(spark, tmp_path, strategy):
    c, o = frames(spark, [(i, "c" * 40, "l") for i in range(2000)], [(i, i % 50, 1.0, DAY) for i in range(9000)])
    for name, df in (("c", c), ("o", o)):
        df.write.csv(f"{tmp_path}/{name}")
    c = spark.read.schema(c.schema).csv(f"{tmp_path}/c")
    o = spark.read.schema(o.schema).csv(f"{tmp_path}/o")
    size = sum(f.stat().st_size for f in tmp_path.rglob("part-*.csv"))
    stats = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = stats()
    rows_out = enrich_orders(c, o, strategy=strategy, slice_rows=100).count()
    assert rows_out == 9000 + 1950
    # the totals written between are small
    assert stats() - before < 2.5 * size


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_maps_and_names_in_any_case(spark, strategy):
    c = spark.createDataFrame([(3, "x"), (None, "y"), (4, "z"), (3, "x")], "CLIENTID int, Name string")
    o = spark.createDataFrame(
        [(i, 3 if i % 3 else None, 1.5, {"k": i}, [{"m": 1}]) for i in range(12)],
        "orderid int, clientid int, Amount double, tags map<string,int>, more array<map<string,int>>",
    )
    out = enrich_orders(c, o, strategy=strategy, slice_rows=2)
    assert out.columns == ["CLIENTID", "Name", "orderid", "Amount", "tags", "more", "totalAmountByClient"]
    got = sorted(((r.CLIENTID, r.Name, r.orderid, r.tags and r.tags["k"], r.totalAmountByClient) for r in out.collect()), key=str)
    ids = [i for i in range(12) if i % 3]
    want = [(3, "x", i, i, 24.0) for i in ids] * 2 + [(None, "y", None, None, None), (4, "z", None, None, None)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("decimal", ["DECIMAL(20,10)", "DECIMAL(38,18)"])
def test_totals_keep_all_digits(spark, strategy, decimal):
    c = spark.createDataFrame([(1, "once"), (2, "twice"), (2, "twice")], "clientId int, name string")
    o = spark.sql(
        f"SELECT id AS orderId, int(1 + id % 2) AS clientId, CAST('1.1234567891' AS {decimal}) + 0 AS amount FROM range(6)"
    ).selectExpr("orderId", "clientId", f"CAST(amount AS {decimal}) AS amount")
    out = enrich_orders(c, o, strategy=strategy, slice_rows=2)
    plain = by_window(c, o)
    assert out.schema["totalAmountByClient"].dataType == plain.schema["totalAmountByClient"].dataType
    key = lambda df: sorted(map(str, df.select("clientId", "orderId", "totalAmountByClient").collect()))
    assert key(out) == key(plain)


def test_measured_bytes_counts_text_and_refuses_nested(spark):
    short = spark.createDataFrame([("a",)], "t STRING")
    long = spark.createDataFrame([("a" * 1000,)], "t STRING")
    assert measured_bytes(long) - measured_bytes(short) == 999
    assert measured_bytes(spark.createDataFrame([(None,)], "t STRING")) < measured_bytes(short)
    assert measured_bytes(spark.createDataFrame([([1],)], "t ARRAY<INT>")) is None


def test_other_column_names_and_decimal_amounts(spark):
    c = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 2), ('b', 3) AS t(id, grade)")
    o = spark.sql("SELECT * FROM VALUES ('a', 1.50BD), ('a', 2.25BD) AS t(id, paid)")
    for strategy in STRATEGIES:
        out = enrich_orders(c, o, key="id", amount="paid", total="sum", strategy=strategy)
        assert out.columns == ["id", "grade", "paid", "sum"]
        assert out.schema["sum"].dataType.simpleString() == "decimal(13,2)"
        assert sorted((r.id, r.grade, str(r.paid), str(r.sum)) for r in out.collect()) == [
            ("a", 1, "1.50", "7.50"), ("a", 1, "2.25", "7.50"),
            ("a", 2, "1.50", "7.50"), ("a", 2, "2.25", "7.50"), ("b", 3, "None", "None"),
        ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_key_types_may_differ(spark, strategy):
    c = spark.createDataFrame([(1, "Wren", "quay"), (2, "Xyst", "quay")], schemas.CLIENTS)
    o = spark.createDataFrame(
        [(1, 1, 1.5, DAY)] * 4 + [(2, 1 << 40, 2.0, DAY)] * 4,
        "orderId INT, clientId BIGINT, amount DOUBLE, date STRING",
    )
    out = enrich_orders(c, o, strategy=strategy, slice_rows=2)
    assert out.schema["clientId"].dataType == schemas.CLIENTS["clientId"].dataType
    assert rows(out) == rows(by_window(c, o))


def test_wrong_arguments(shops):
    c, o = shops
    with pytest.raises(ValueError, match="unknown strategy"):
        enrich_orders(c, o, strategy="magic")
    with pytest.raises(ValueError, match="both inputs: NAME, name"):
        enrich_orders(c, o.withColumn("NAME", F.lit("x")))
    with pytest.raises(ValueError, match="both inputs: AMOUNT, amount"):
        enrich_orders(c, o, total="AMOUNT")
    with pytest.raises(ValueError, match="0 columns 'nope'"):
        enrich_orders(c, o, key="nope")
