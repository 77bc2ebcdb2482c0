"""Clients with their orders and the order total of each client.

The result is that of::

    SELECT c.*, o.<all but the key>, SUM(o.amount) OVER (PARTITION BY c.clientId)
    FROM clients c LEFT JOIN orders o ON c.clientId = o.clientId

Totals are aggregated before the join, one row per client id, so no plan windows over the
orders of a client. Each input is read twice: for the totals, a few columns, and for the
join. All strategies give the same rows, columns and errors:

``auto``     one declarative plan, run when the caller acts; adaptive execution decides
             what to broadcast and cuts the orders, or the copies, of a hot id.
``clients``  orders are streamed past broadcast clients, if these are measured to fit;
``orders``   clients are streamed past broadcast orders, likewise. Else as ``auto``.
``buckets``  one declarative plan that joins by the key alone, for clients that are kept in
             buckets by it (``sources.buckets``): they do not move. All pairs of one id are
             joined in one task.
``sliced``   both sides are shuffled, and an id with more than ``slice_rows`` pairs is cut
             into slices, however many such ids there are. The totals are written once to
             the shared scratch folder to find these ids.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.operators.prefilter import may_match
from tallybrook.scratch import written

# A side is broadcast by name only if it is measured to be at most this large.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Pairs of a client id that go to one task together.
SLICE_ROWS = 1_000_000

STRATEGIES = ("auto", "clients", "orders", "buckets", "sliced")


def enrich_orders(
    clients: DataFrame,
    orders: DataFrame,
    *,
    key: str = "clientId",
    amount: str = "amount",
    total: str = "totalAmountByClient",
    strategy: str = "auto",
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    slice_rows: int = SLICE_ROWS,
    bloom_bits: int | None = None,
) -> DataFrame:
    """Left join orders to clients and add each client's total.

    Output columns: those of ``clients``, those of ``orders`` but the key, ``total``.
    Names are resolved as the session does, by default in any case; the key column has
    the clients' spelling and type. Every client is kept; without orders it has one row
    with NULLs, total included. NULL amounts do not count; NULL keys match nothing; a
    client id that occurs k times has its orders k times, in the total too.

    With ``bloom_bits`` orders of ids that no client has are dropped in their scan, before
    any shuffle, by a Bloom filter of that size (``operators.prefilter``); worth it where many
    orders have unknown ids. The result is the same.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; expected one of {STRATEGIES}")
    shape = _Shape(clients, orders, key, amount, total)
    if bloom_bits is not None:
        shape.orders = may_match(shape.orders, clients, shape.key, bits=bloom_bits)
    if strategy == "clients" and _fits(clients, broadcast_limit):
        return _past_clients(shape)
    if strategy == "orders" and _fits(orders, broadcast_limit):
        return shape.output(shape.with_totals(shape.totals()).join(F.broadcast(shape.orders), shape.key, "left"))
    if strategy == "sliced":
        return _sliced(shape, slice_rows)
    if strategy == "buckets":
        return shape.output(shape.with_totals(shape.totals()).join(shape.orders, shape.key, "left"))
    return _matched(shape)


class _Shape:
    """The inputs under unambiguous names, and the columns and types of the result."""

    def __init__(self, clients, orders, key, amount, total):
        spark = clients.sparkSession
        exact = spark.conf.get("spark.sql.caseSensitive", "false") == "true"
        folded = (lambda name: name) if exact else str.casefold

        def field_of(df, name):
            found = [f.name for f in df.schema.fields if folded(f.name) == folded(name)]
            if len(found) != 1:
                raise ValueError(f"{len(found)} columns {name!r} in {df.columns}")
            return found[0]

        self.key, order_key = field_of(clients, key), field_of(orders, key)
        self.amount = field_of(orders, amount)
        names = [*clients.columns, *[c for c in orders.columns if c != order_key], total]
        seen = [folded(n) for n in names]
        clash = sorted({n for n in names if seen.count(folded(n)) > 1})
        if clash:
            raise ValueError(f"column(s) in both inputs: {', '.join(clash)}")
        self.clients = clients
        # the key of matched rows is taken from the clients, and so has their type
        self.orders = orders.withColumnRenamed(order_key, self.key).where(F.col(_quoted(self.key)).isNotNull())
        self.total, self.columns = total, names
        self.sum_type = orders.select(F.sum(_quoted(self.amount)).alias("s")).schema["s"].dataType
        self._order_fields = [f for f in orders.schema.fields if f.name != order_key]

    def totals(self, how: str = "inner") -> DataFrame:
        """Per client id: total, number of orders, copies of the client.

        The total sums each order once per copy. Summing the sum of a client once per
        copy, not multiplying it, keeps all digits of DECIMAL amounts. With ``how='left'``
        ids without orders are there as well, ``_orders`` NULL for them and 1 for others.
        """
        key = _quoted(self.key)
        orders, amount = self.orders.groupBy(key), F.sum(_quoted(self.amount)).alias("_sum")
        if how == "left":
            order_sums = orders.agg(amount).withColumn("_orders", F.lit(1))
        else:
            order_sums = orders.agg(amount, F.count(F.lit(1)).alias("_orders"))
        ids = self.clients.select(key).where(F.col(key).isNotNull())
        return ids.join(order_sums, self.key, how).groupBy(key).agg(
            F.sum("_sum").cast(self.sum_type).alias("_total"),
            F.max("_orders").alias("_orders"),
            F.count(F.lit(1)).alias("_copies"),
        )

    def with_totals(self, totals: DataFrame) -> DataFrame:
        """All clients; those without orders have no ``_orders``."""
        return self.clients.join(totals, self.key, "left")

    def output(self, joined: DataFrame) -> DataFrame:
        return joined.select(
            *[_quoted(c) for c in self.columns[:-1]], F.col("_total").alias(self.total)
        )

    def without_orders(self, clients: DataFrame) -> DataFrame:
        """The given clients in output shape, order columns NULL."""
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._order_fields]
        return clients.select(
            *[_quoted(c) for c in self.clients.columns], *nulls, F.col("_total").alias(self.total)
        )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def measured_bytes(df: DataFrame, limit: int | None = None) -> int | None:
    """Upper estimate of the rows' size in memory; None if a column type is unbounded.

    Rows are counted and text is measured; all else is of fixed width. If the fixed width
    alone exceeds ``limit``, text is not read.
    """
    texts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.sum(F.octet_length(_quoted(field.name))), F.lit(0)))
    fixed = df.count() * (16 * len(df.columns) + 32)
    if not texts or (limit is not None and fixed > limit):
        return fixed
    return fixed + df.agg(functools.reduce(Column.__add__, texts).alias("text")).first()["text"]


def _fits(df: DataFrame, limit: int) -> bool:
    size = measured_bytes(df, limit)
    return size is not None and size <= limit


def _matched(shape: _Shape) -> DataFrame:
    """Inner join in which every client has a row to meet.

    Spark can cut a hot key on either side of an inner join, but of a left join only on
    the left. So each id without orders gets one empty order, and so does the NULL id.
    Empty orders and totals come from one aggregation: no input is read a third time. The
    null-safe condition hashes another key than the totals do, so that both sides of the
    join come straight from a shuffle, as the cutting of hot keys asks for.
    """
    totals = shape.totals("left")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in shape.orders.schema.fields if f.name != shape.key]
    # the total of these is NULL, too; asking for it makes both uses of the totals one aggregation
    lone = totals.where(F.col("_orders").isNull() & F.col("_total").isNull()).select(_quoted(shape.key), *nulls)
    key_type = lone.schema[shape.key].dataType
    no_id = shape.clients.sparkSession.range(1).select(F.lit(None).cast(key_type).alias(shape.key), *nulls)
    names = [_quoted(c) for c in shape.orders.columns]
    met = shape.orders
    for empty in (lone, no_id):
        met = met.unionAll(empty.select(*names))
    known = shape.with_totals(totals)
    met = met.withColumnRenamed(shape.key, _MET)
    return shape.output(known.join(met, known[_quoted(shape.key)].eqNullSafe(met[_MET])))


_MET = "_met"


def _past_clients(shape: _Shape) -> DataFrame:
    """Stream the orders past a broadcast of the clients, totals attached."""
    known = shape.with_totals(shape.totals())
    matched = F.broadcast(known.where(F.col("_orders").isNotNull())).join(shape.orders, shape.key)
    return shape.output(matched).union(shape.without_orders(known.where(F.col("_orders").isNull())))


def _sliced(shape: _Shape, slice_rows: int) -> DataFrame:
    """Shuffle both sides on the client id, hot ids cut into slices.

    With s order slices and c client slices an id has s * c slots. An order picks one
    order slice and is repeated for each client slice, a client the other way round,
    so each pair meets in exactly one slot.
    """
    totals = written(shape.totals(), "client-totals")
    side = math.isqrt(slice_rows)
    copies = F.ceil(F.col("_copies") / F.lit(side))
    hot = totals.where(F.col("_orders").cast("double") * F.col("_copies") > slice_rows).select(
        _quoted(shape.key),
        copies.alias(_CLIENT_SLICES),
        F.ceil(F.col("_orders") * F.ceil(F.col("_copies") / copies) / F.lit(slice_rows)).alias(_ORDER_SLICES),
    )
    if hot.isEmpty():
        return shape.output(shape.with_totals(totals).join(shape.orders, shape.key, "left"))
    known = shape.with_totals(totals)
    lone = shape.without_orders(known.where(F.col("_orders").isNull()))
    named = _in_slots(known.where(F.col("_orders").isNotNull()), hot, shape.key, _CLIENT_SLICES)
    placed = _in_slots(shape.orders, hot, shape.key, _ORDER_SLICES)
    # every order of a matched client finds it in its slot; orders of no client find none
    return shape.output(named.join(placed, [shape.key, "_slot"])).union(lone)


_ORDER_SLICES, _CLIENT_SLICES = "_order_slices", "_client_slices"


def _in_slots(df: DataFrame, hot: DataFrame, key: str, own: str) -> DataFrame:
    """Give each row its slot: one slice of its own side, all slices of the other.

    Whether hot ids are broadcast is left to the optimizer, which knows their size. A
    row's own slice is the same again when its task is rerun, and copies of a row in
    different input partitions land in different slices.
    """
    other = _CLIENT_SLICES if own == _ORDER_SLICES else _ORDER_SLICES
    hashed = [_quoted(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    # taken before the join, which may move rows
    rows = df.withColumn("_spread", F.xxhash64(*hashed, F.spark_partition_id()))
    slotted = rows.join(hot, key, "left").withColumn(
        "_own", F.pmod("_spread", F.coalesce(own, F.lit(1).cast("long")))
    ).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(other, F.lit(1).cast("long")) - 1))
    )
    order_slice, client_slice = ("_own", "_other") if own == _ORDER_SLICES else ("_other", "_own")
    slots = F.coalesce(_CLIENT_SLICES, F.lit(1).cast("long"))
    slot = F.col(order_slice) * slots + F.col(client_slice)
    return slotted.withColumn("_slot", slot).drop("_own", "_other", "_spread", _ORDER_SLICES, _CLIENT_SLICES)


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))
