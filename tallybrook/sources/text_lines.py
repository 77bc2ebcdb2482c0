"""Raw text lines, batch or streaming: one row per line in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.schemas import LOG_LINE


def read_text_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.schema(LOG_LINE).options(**options).text(path)


def stream_text_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, **options
) -> DataFrame:
    """Watch a folder for new text files; every file in it counts, whatever its name.

    ``max_files_per_trigger`` bounds a micro-batch; 1 gives one batch per file. Without
    it a micro-batch takes all files that are there, whatever the size of the cluster.
    Further options (``pathGlobFilter``, ``maxBytesPerTrigger``, ``cleanSource``) go
    to the file source as they are.
    """
    reader = spark.readStream.schema(LOG_LINE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.options(**options).text(path)
