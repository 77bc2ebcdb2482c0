"""Checkpointed streaming sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_stream(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    *,
    format: str = "parquet",
    output_mode: str = "append",
    interval_ms: int = 5000,
    available_now: bool = False,
    query_name: str | None = None,
    **options,
) -> StreamingQuery:
    """Start writing a streaming DataFrame and return at once.

    A micro-batch starts every ``interval_ms`` (0: as soon as the last is done); with
    ``available_now`` all data present is processed, in rate-limited batches, and the
    query ends. File sinks need a ``path``; with the ``checkpoint`` they write each
    row exactly once across restarts. ``format='console'`` is for looking at rows.
    """
    if format != "console" and not path:
        raise ValueError(f"a {format} stream needs a path to write to")
    writer = (
        df.writeStream.format(format)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_ms} milliseconds")
    return writer.start(path) if path else writer.start()
