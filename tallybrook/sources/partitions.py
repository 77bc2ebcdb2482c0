"""Date-partitioned folders: ``<root>/<column>=yyyy-MM-dd/``."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import SparkSession

from tallybrook.functions.dates import parse_partition_date

# Fixed value: the folder in which partitioned writes keep rows without a value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: the setting by which recovered partitions also have their files counted.
_LIST_FILES = "spark.sql.hive.gatherFastStats"


def partition_folders(
    spark: SparkSession, root: str, column: str = "date"
) -> dict[date, list[str]]:
    """Folders under ``root`` per partition date.

    Spark lists the names of one level of folders when it recovers the partitions of a
    table that has its place there; no file below is touched. The table is there for the
    listing alone. Two spellings of one date (``2023-9-5``, ``2023-09-05``) are one
    partition, an empty folder is one, too.
    """
    prefix = f"{column}="
    folders: dict[date, list[str]] = {}
    for name in _partition_names(spark, root, column):
        text = name[len(prefix) :]
        if text == _NULL_FOLDER:
            continue
        try:
            day = parse_partition_date(text)
        except ValueError:
            raise ValueError(f"not a {column}=yyyy-MM-dd folder: {name!r} in {root}") from None
        folders.setdefault(day, []).append(f"{root.rstrip('/')}/{name}")
    return folders


def _partition_names(spark: SparkSession, root: str, column: str) -> list[str]:
    """Names of the folders ``column=...``, as they are spelled."""
    table, by = f"folders_{uuid.uuid4().hex}", _quoted(column)
    place = root.replace("\\", "\\\\").replace("'", "\\'")
    values = _quoted("value" if column != "value" else "values")
    stats = spark.conf.get(_LIST_FILES)
    spark.conf.set(_LIST_FILES, "false")
    try:
        spark.sql(
            f"CREATE TABLE {table} ({values} STRING, {by} STRING) USING text PARTITIONED BY ({by}) LOCATION '{place}'"
        )
        spark.catalog.recoverPartitions(table)
        return [row["partition"] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    except Exception as error:
        if "FileNotFoundException" in str(error) or "does not exist" in str(error):
            raise FileNotFoundError(root) from None
        raise
    finally:
        spark.conf.set(_LIST_FILES, stats)
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay: their place was given


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def latest_partition(
    spark: SparkSession, root: str, column: str = "date"
) -> tuple[date, list[str]]:
    """Newest partition date, by date and not by text, and its folder(s)."""
    folders = partition_folders(spark, root, column)
    if not folders:
        raise ValueError(f"no partitions by {column!r} in {root}")
    newest = max(folders)
    return newest, folders[newest]


def latest_partition_value(spark: SparkSession, root: str, column: str = "date") -> str:
    """Newest partition as ``yyyy-MM-dd``."""
    return latest_partition(spark, root, column)[0].isoformat()
