"""Working folders for written intermediate tables.

On a cluster every executor must see the same folder, so the location comes
from ``spark.checkpoint.dir``. Only where that is unset in local mode (tests) is
a temporary folder made; a cluster without the setting is an error.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallybrook-")


def _context_folder(spark: SparkSession) -> str | None:
    """The folder that ``SparkContext.setCheckpointDir`` named, if it was called."""
    context = getattr(spark, "sparkContext", None)
    return context.getCheckpointDir() if context is not None else None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder path under the cluster's shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage is cut, a lost executor costs only a re-read."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    for made in _open_scopes:
        made.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete what ``written`` wrote inside, once the rows made from it are safe elsewhere."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for folder in made:
            delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
