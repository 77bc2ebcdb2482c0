"""Streaming job: text files in, parsed log rows out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallybrook.operators.logs import errors_only, parse_logs, parse_well_formed
from tallybrook.sources.text_lines import stream_text_lines
from tallybrook.streaming.sink import start_stream


def error_lines(lines: DataFrame) -> DataFrame:
    """Raw lines to ERROR rows, for alerting or dead-letter routing."""
    return errors_only(parse_logs(lines))


def run_log_stream(
    spark: SparkSession,
    logs_path: str,
    checkpoint: str,
    output_path: str | None = None,
    *,
    rows_of: Callable[[DataFrame], DataFrame] = parse_well_formed,
    max_files_per_trigger: int | None = None,
    source_options: dict | None = None,
    **sink_options,
) -> StreamingQuery:
    """Start the job. ``rows_of`` turns raw lines into the rows to write, e.g. ``error_lines``."""
    lines = stream_text_lines(spark, logs_path, max_files_per_trigger, **(source_options or {}))
    return start_stream(rows_of(lines), checkpoint, output_path, **sink_options)
