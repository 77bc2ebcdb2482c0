"""Tables kept in buckets by key, so that joins on the key need not move them again.

A table that is joined every day to new rows is shuffled once, when it is written: one file
per bucket, sorted by key. A join or aggregation on the key then reads it as it lies, and
only the new rows move, to as many partitions as there are buckets. Take a number of
buckets that is not below ``spark.sql.shuffle.partitions``; else Spark moves both sides to
have more tasks. A bucket is read by one task: the rows of one key and the NULL keys must fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write the rows below ``path`` and name them ``table`` in the session's catalog, in place of an older one."""
    if buckets < 1:
        raise ValueError(f"{buckets} buckets")
    dealt = rows.repartition(buckets, rows[_quoted(key)])
    writer = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.mode("overwrite").option("path", path).saveAsTable(table)
    return rows.sparkSession.table(table)


def open_bucketed(
    spark: SparkSession, table: str, path: str, schema: StructType, key: str, buckets: int
) -> DataFrame:
    """Name what ``write_bucketed`` wrote in another session; key and buckets as they were then."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place, by = path.replace("\\", "\\\\").replace("'", "\\'"), _quoted(key)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
