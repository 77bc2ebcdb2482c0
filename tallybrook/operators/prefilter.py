"""Rows that can't find a partner are dropped before they are shuffled, by a Bloom filter.

The filter of the small side's keys is built in the cluster: each key sets a few bits, bits
are or-ed together word by word, and the words, a fixed number, become one array of ``bits``
bits. It reaches the large side's scan as the value of a scalar subquery, so nothing runs before
the caller's action. A key that is there always passes; of those that are not, about one in
a hundred passes at ten bits a key, and is dropped by the join itself.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 2**23 bits are one MiB and serve some 800 000 keys; the array is the bound of what is sent to each task.
BITS = 1 << 23
MOST_BITS = 1 << 28
HASHES = 5

_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def may_match(rows: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None, *, bits: int = BITS) -> DataFrame:
    """The rows whose ``key`` may be among those of ``keys``; none that is among them is lost.

    Rows with a NULL key are dropped: NULL matches nothing. Whole-number keys may differ in
    width, other keys must be of one type. ``bits`` is a power of two, ten a key serve well.
    """
    if bits < 64 or bits > MOST_BITS or bits & (bits - 1):
        raise ValueError(f"bits must be a power of two from 64 to {MOST_BITS}, not {bits}")
    own, other = _quoted(key), _quoted(keys_key or key)
    kinds = [df.select(c).schema[0].dataType for df, c in ((rows, own), (keys, other))]
    if all(isinstance(k, _WHOLE_NUMBERS) for k in kinds):
        cast = [F.col(c).cast("long") for c in (own, other)]
    elif kinds[0] == kinds[1]:
        cast = [F.col(c) for c in (own, other)]
    else:
        # their equality involves a cast, after which hashes no longer agree
        raise ValueError(f"keys of types {kinds[0].simpleString()} and {kinds[1].simpleString()}")
    words = _filter(keys, cast[1], bits).scalar()
    tests = [F.get(words, _word(p)).bitwiseAND(_mask(p)) != 0 for p in _positions(cast[0], bits)]
    return rows.where(F.col(own).isNotNull() & functools.reduce(Column.__and__, tests))


def _filter(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """One row: the words of the filter, in order, as an array of 64-bit numbers."""
    position = keys.where(key.isNotNull()).select(F.explode(F.array(*_positions(key, bits))).alias("p"))
    none = F.lit(0).cast("long").alias("w")
    marked = position.select(_word(F.col("p")).cast("long").alias("i"), _mask(F.col("p")).alias("w"))
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), none)
    words = marked.unionAll(empty).groupBy("i").agg(F.bit_or("w").alias("w"))
    gathered = F.sort_array(F.collect_list(F.struct("i", "w")))
    return words.agg(F.transform(gathered, lambda x: x["w"]).alias("words"))


def _positions(key: Column, bits: int) -> list[Column]:
    hashed = F.xxhash64(key)
    # two halves of 31 bits: no sum overflows
    first, step = hashed.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(hashed, 33)
    return [(first + step * i).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def _word(position: Column) -> Column:
    return F.shiftright(position, 6).cast("int")


def _mask(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
