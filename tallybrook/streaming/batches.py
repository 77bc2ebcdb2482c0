"""Sinks that a stream writes batch by batch, each batch under its own number.

A file sink takes one output and appends. Here a micro-batch is handed to a function that
may write several outputs, or replace what an earlier batch wrote. Spark runs a batch again if the job
ended between the write and the commit, with the same number and the same input;
as each batch replaces only the folder of its own number, nothing is written twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

BATCH, STREAM = "batch_id", "stream"


def stream_tag(checkpoint: str) -> str:
    """Names a stream by its checkpoint: batch numbers of another checkpoint are other batches."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def batch_folder(root: str, checkpoint: str, batch: int) -> str:
    return f"{root.rstrip('/')}/{STREAM}={stream_tag(checkpoint)}/{BATCH}={batch}"


def write_batch(rows: DataFrame, root: str, checkpoint: str, batch: int) -> None:
    """Write the rows of one batch, in place of what an earlier attempt at it wrote."""
    rows.write.mode("overwrite").parquet(batch_folder(root, checkpoint, batch))


def read_batch(spark: SparkSession, root: str, checkpoint: str, batch: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(batch_folder(root, checkpoint, batch))


def read_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of all batches of all streams that write here, with ``batch_id`` and ``stream``."""
    fields = [*schema.fields, StructField(STREAM, StringType()), StructField(BATCH, LongType())]
    return spark.read.schema(StructType(fields)).parquet(root)


def start_batches(
    df: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    *,
    output_mode: str = "append",
    interval_ms: int = 5000,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start handing micro-batches to ``write(rows, number)`` and return at once.

    Triggers as in ``start_stream``. ``write`` must give the same result when it is called
    again with the same batch, as ``write_batch`` does.
    """
    writer = df.writeStream.foreachBatch(write).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms} milliseconds").start()
