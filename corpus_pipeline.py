"""The corpus pipeline: stages over documents, each written and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm.common import table
from tallybrook.llm.pipeline_stages import STAGES
from tallybrook.scratch import cleared, delete, shared_folder

ORACLE_SQL = None  # the stages are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages, in order, to the documents of ``sf_dir``.

    What a stage wrote for itself is deleted once its result is written, and so is the
    result of the stage before.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = shared_folder(spark, f"pipeline-{name}")
        with cleared(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(folder)
        docs = spark.read.schema(result.schema).parquet(folder)
        if before:
            delete(spark, before)
        before = folder
    return docs
