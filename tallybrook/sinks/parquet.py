"""Parquet sink, partitioned by a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: str = "location",
    mode: str = "overwrite",
    *,
    layout: str = "rebalance",
    coalesce: int | None = None,
    **options,
) -> None:
    """One folder per value of ``partition_by``; NULL has a folder of its own.

    ``layout`` decides how many files that makes:

    - ``rebalance``: rows of one value are brought together, a value with many rows
      is split over tasks by size, so files are neither tiny nor written by one task;
    - ``as_is``: no shuffle; each task writes a file for each value it holds.

    ``coalesce`` caps the write tasks, and so the files per value, at the price of
    parallelism. ``overwrite`` replaces the whole path; to replace only the values
    written, pass ``partitionOverwriteMode='dynamic'``.
    """
    if layout not in ("rebalance", "as_is"):
        raise ValueError(f"unknown layout {layout!r}")
    if coalesce is not None:
        df = df.coalesce(coalesce)
    elif layout == "rebalance":
        df = df.hint("rebalance", F.col(partition_by))
    df.write.options(**options).partitionBy(partition_by).mode(mode).parquet(path)
