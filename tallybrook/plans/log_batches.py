"""Streaming jobs over logs that keep several outputs, or a state: routes, counts, first lines.

Each is a source, a transformation and a batch sink of ``streaming.batches``: a batch that
is run again after a lost job replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tallybrook.operators.logs import earliest, errors_only, level_distribution, malformed, parse_logs, well_formed
from tallybrook.schemas import ERROR_LOG, LOG_LINE, PARSED_LOG
from tallybrook.sources.text_lines import stream_text_lines
from tallybrook.streaming.batches import BATCH, STREAM, read_batch, read_batches, start_batches, write_batch

# Where each route's rows go, below the output folder, and what they look like.
ROUTES = {"well_formed": PARSED_LOG, "errors": ERROR_LOG, "malformed": LOG_LINE}
LEVEL_COUNTS = StructType([PARSED_LOG["level"], StructField("lines", LongType(), True)])


def routed(lines: DataFrame) -> dict[str, DataFrame]:
    """Raw lines by route: well-formed rows, ERROR rows among them, and lines outside the grammar."""
    parsed = parse_logs(lines)
    return {"well_formed": well_formed(parsed), "errors": errors_only(parsed), "malformed": malformed(lines)}


def run_routed_log_stream(
    spark: SparkSession,
    logs_path: str,
    checkpoint: str,
    output_path: str,
    *,
    routes_of: Callable[[DataFrame], dict[str, DataFrame]] = routed,
    max_files_per_trigger: int | None = None,
    source_options: dict | None = None,
    **sink_options,
) -> StreamingQuery:
    """One pass over the lines, one output folder per route.

    A micro-batch is read once and held while its routes are written. Read a route back
    with ``read_route``.
    """
    lines = stream_text_lines(spark, logs_path, max_files_per_trigger, **(source_options or {}))

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for route, rows in routes_of(batch).items():
                write_batch(rows, f"{output_path}/{route}", checkpoint, number)
        finally:
            batch.unpersist()

    return start_batches(lines, checkpoint, write, **sink_options)


def read_route(spark: SparkSession, output_path: str, route: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a route; ``schema`` for routes other than those of ``routed``."""
    schema = schema or ROUTES[route]
    return read_batches(spark, f"{output_path}/{route}", schema).select(*schema.names)


def run_level_counts(
    spark: SparkSession,
    logs_path: str,
    checkpoint: str,
    output_path: str,
    *,
    output_mode: str = "update",
    max_files_per_trigger: int | None = None,
    source_options: dict | None = None,
    **sink_options,
) -> StreamingQuery:
    """Count lines per level as they come; the counts are state that a restart finds again.

    ``update`` writes the levels that a batch changed, ``complete`` all levels with every
    batch. The state holds one row per level, whatever the number of lines.
    """
    if output_mode not in ("update", "complete"):
        raise ValueError(f"counts change, so the output mode is update or complete, not {output_mode!r}")
    lines = stream_text_lines(spark, logs_path, max_files_per_trigger, **(source_options or {}))
    counts = level_distribution(parse_logs(lines))

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch.coalesce(1), output_path, checkpoint, number)

    return start_batches(counts, checkpoint, write, output_mode=output_mode, **sink_options)


def current_level_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """Lines per level after the last batch, summed over the streams that write there.

    Counts only grow, and the batch that counted a level last holds its count; that is so
    in both output modes.
    """
    written = read_batches(spark, output_path, LEVEL_COUNTS)
    last = written.groupBy(STREAM, "level").agg(F.max_by("lines", BATCH).alias("lines"))
    return last.groupBy("level").agg(F.sum("lines").alias("lines"))


def run_earliest_lines(
    spark: SparkSession,
    logs_path: str,
    checkpoint: str,
    output_path: str,
    *,
    n: int = 1,
    max_files_per_trigger: int | None = None,
    source_options: dict | None = None,
    **sink_options,
) -> StreamingQuery:
    """Keep the first ``n`` well-formed lines of all that came so far, ties as in ``earliest``.

    The state is the ``n`` rows that the batch before wrote; a batch merges its own first
    ``n`` with them. Both are top-k: no batch is sorted as a whole.
    """
    lines = stream_text_lines(spark, logs_path, max_files_per_trigger, **(source_options or {}))

    def write(batch: DataFrame, number: int) -> None:
        first = earliest(parse_logs(batch), n)
        if number > 0:
            kept = read_batch(batch.sparkSession, output_path, checkpoint, number - 1, PARSED_LOG)
            first = earliest(first.unionAll(kept), n)
        write_batch(first, output_path, checkpoint, number)

    return start_batches(lines, checkpoint, write, **sink_options)


def current_earliest(spark: SparkSession, output_path: str, n: int = 1) -> DataFrame:
    """The first ``n`` lines after the last batch, over all streams that write there."""
    written = read_batches(spark, output_path, PARSED_LOG)
    last = F.max(BATCH).over(Window.partitionBy(STREAM))
    newest = written.withColumn("_last", last).where(F.col(BATCH) == F.col("_last"))
    return earliest(newest.select(*PARSED_LOG.names), n)
