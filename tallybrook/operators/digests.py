"""Differences of large tables that are nearly equal: digests per bucket first, then rows.

Every row falls into one of ``buckets`` by its hash, and a bucket's digest is the number of
its rows and two sums of two 64-bit hashes of each. Sums do not depend on the order of
rows and count duplicates. Both sides are read and hashed in place, one digest row a bucket and task is
shuffled, and only rows of buckets whose digests differ are compared as rows. Equal tables
so shuffle digests alone; tables that differ in a few rows shuffle few buckets.

Two different buckets pass as equal only if both pairs of sums agree. For hashes that behave
like random ones the chance is below 2**-120 a bucket; xxHash is no cryptographic hash, so
rows made on purpose to collide are outside this bound: use ``diff`` for those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.operators.compare import diff, diff_counts

# One digest row each; the list of differing buckets is as long at most, so it can be broadcast.
BUCKETS = 65_536


def bucket_digests(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, sum_1, sum_2): the digest of each bucket that holds rows."""
    one, two = _hashes(rows)
    wide = T.DecimalType(38, 0)
    return (
        rows.select(one.alias("one"), two.alias("two"))
        .groupBy(F.pmod("one", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("one").cast(wide)).alias("sum_1"),
             F.sum(F.col("two").cast(wide)).alias("sum_2"))
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket): where the digests of both sides differ, or only one side has rows."""
    signed = [bucket_digests(df, buckets).withColumn("sign", F.lit(s)) for df, s in ((left, 1), (right, -1))]
    sums = [F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("n", "sum_1", "sum_2")]
    both = signed[0].unionAll(signed[1]).groupBy("bucket").agg(*sums)
    return both.where("n != 0 OR sum_1 != 0 OR sum_2 != 0").select("bucket")


def digest_diff_counts(
    left: DataFrame, right: DataFrame, *, buckets: int = BUCKETS, side: str = "side", copies: str = "copies"
) -> DataFrame:
    """``diff_counts`` by digests first: same rows, same columns."""
    return diff_counts(*_suspects(left, right, buckets), side=side, copies=copies)


def digest_diff(left: DataFrame, right: DataFrame, *, buckets: int = BUCKETS, side: str = "side") -> DataFrame:
    """``diff`` by digests first."""
    return diff(*_suspects(left, right, buckets), side=side)


def same_digests(left: DataFrame, right: DataFrame, *, buckets: int = BUCKETS) -> bool:
    """``same_rows`` up to the bound above, from digests alone."""
    _check(left, right)
    return differing_buckets(*_alike(left, right), buckets).isEmpty()


def _check(left: DataFrame, right: DataFrame) -> None:
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")


def _alike(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides in the types that their union has: an INT 1 is a BIGINT 1 there, and hashes as such."""
    names = [f"c{i}" for i in range(len(left.columns))]
    left, right = left.toDF(*names), right.toDF(*names)
    types = left.unionAll(right).schema
    cast = [[F.col(f.name).cast(f.dataType).alias(f.name) for f in types.fields] for _ in range(2)]
    return left.select(*cast[0]), right.select(*cast[1])


def _suspects(left: DataFrame, right: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose bucket differs, without a shuffle of rows."""
    _check(left, right)
    pair = _alike(left, right)
    differing = F.broadcast(differing_buckets(*pair, buckets))
    out = []
    for rows in pair:
        bucket = F.pmod(_hashes(rows)[0], F.lit(buckets)).cast("int")
        held = rows.withColumn("bucket", bucket).join(differing, "bucket", "left_semi").drop("bucket")
        out.append(held.toDF(*left.columns))
    return out[0], out[1]


def _hashes(rows: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, in which every NULL counts where it stands."""
    parts = [part for f in rows.schema.fields for part in _hashed(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType)]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _hashed(value: Column, kind: T.DataType) -> list[Column]:
    """Columns that are equal exactly if two values are; Spark's hash alone passes over NULLs."""
    if isinstance(kind, (T.MapType, T.VariantType)):
        raise ValueError("maps and variants have no order or equality to compare rows by")
    if isinstance(kind, T.ArrayType):
        element = F.transform(value, lambda x: F.xxhash64(*_hashed(x, kind.elementType)))
        return [value.isNull(), F.size(value), element]
    if isinstance(kind, T.StructType):
        inner = [part for f in kind.fields for part in _hashed(value.getField(f.name), f.dataType)]
        return [value.isNull(), *inner]
    return [value.isNull(), value]
