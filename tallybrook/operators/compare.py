"""Two-way difference of two DataFrames, duplicates counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of one differing row that a single task may write out at once.
_COPIES_PER_CHUNK = 1_000_000


def diff_counts(
    left: DataFrame, right: DataFrame, *, side: str = "side", copies: str = "copies"
) -> DataFrame:
    """One row per distinct row that occurs more often on one side.

    Adds ``side`` ('left' or 'right') and ``copies``, the surplus there, under other
    names where the inputs have such columns. Both
    directions come from one aggregation; copies of a row collapse before the
    shuffle, so a row that fills a third of the input costs no more than any other.
    """
    columns = left.columns
    if columns != right.columns:
        raise ValueError(f"columns differ: {columns} and {right.columns}")
    taken = {c.casefold() for c in columns} & {side.casefold(), copies.casefold()}
    if taken:
        raise ValueError(f"the inputs have column(s) {sorted(taken)}; choose other names")
    names = [f"c{i}" for i in range(len(columns))]
    signed = left.toDF(*names).withColumn("sign", F.lit(1))
    signed = signed.unionAll(right.toDF(*names).withColumn("sign", F.lit(-1)))
    surplus = signed.groupBy(*names).agg(F.sum("sign").alias("surplus")).where("surplus != 0")
    sides = F.when(F.col("surplus") > 0, "left").otherwise("right")
    return surplus.select(*names, sides, F.abs("surplus")).toDF(*columns, side, copies)


def diff(left: DataFrame, right: DataFrame, *, side: str = "side") -> DataFrame:
    """All differing rows with their ``side``, each as often as its surplus.

    A surplus above the chunk size is cut into chunks that are spread over tasks
    before they are written out, so that no task writes all copies of one row. Both
    branches read the same aggregation.
    """
    columns = [*left.columns, side]
    names = [*[f"c{i}" for i in range(len(left.columns))], "side"]
    if side.casefold() in {c.casefold() for c in left.columns}:
        raise ValueError(f"the inputs have a column {side!r}; choose another name")
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    counted = diff_counts(left.toDF(*names[:-1]), right.toDF(*names[:-1]))
    few = counted.where(F.col("copies") <= _COPIES_PER_CHUNK)
    many = counted.where(F.col("copies") > _COPIES_PER_CHUNK)

    one = F.lit(1).cast("long")
    chunks = F.sequence(one, F.ceil(F.col("copies") / F.lit(_COPIES_PER_CHUNK)))
    in_chunk = F.least(
        F.lit(_COPIES_PER_CHUNK).cast("long"),
        F.col("copies") - (F.col("chunk") - 1) * _COPIES_PER_CHUNK,
    )
    spread = (
        many.withColumn("chunk", F.explode(chunks))
        .withColumn("copies", in_chunk)
        .repartition(*names, "chunk")
        .drop("chunk")
    )
    each_copy = F.explode(F.sequence(one, F.col("copies"))).alias("copy")
    return few.unionByName(spread).select(*names, each_copy).drop("copy").toDF(*columns)


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True if both hold the same rows, each equally often."""
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    names = [f"c{i}" for i in range(len(left.columns))]
    return diff_counts(left.toDF(*names), right.toDF(*names)).isEmpty()
