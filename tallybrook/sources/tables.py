"""CSV tables with declared schemas, and access to them by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallybrook.schemas import CLIENTS, ORDERS, projection_of
from tallybrook.sources.partitions import latest_partition


def read_csv_table(
    spark: SparkSession, path: str, schema: StructType, columns: Iterable[str] | None = None
) -> DataFrame:
    """Comma-separated files with a header, typed by ``schema``; bad values become NULL.

    ``columns`` are ``selectExpr`` expressions; unused columns are not parsed.
    """
    table = spark.read.schema(schema).option("header", True).option("delimiter", ",").csv(path)
    return table.selectExpr(*(columns or schema.names))


def bad_csv_rows(
    spark: SparkSession, path: str | list[str], schema: StructType, *, text: str = "bad_row"
) -> DataFrame:
    """Rows of which a value does not fit its type, or that have too many or too few values.

    The columns of ``schema`` are as ``read_csv_table`` gives them, the bad values NULL;
    ``text`` is the row as it stands in the file. These rows stay in the table.
    """
    if text.casefold() in map(str.casefold, schema.names):
        raise ValueError(f"the schema has a column {text!r}; choose another name")
    reader = spark.read.schema(StructType([*schema.fields, StructField(text, StringType())]))
    options = {"header": True, "delimiter": ",", "columnNameOfCorruptRecord": text}
    # the condition asks for all columns: a bad value in one that is not parsed would not be seen
    values = F.array(*[F.col(f"`{c}`").cast("string") for c in schema.names])
    return reader.options(**options).csv(path).where(F.col(f"`{text}`").isNotNull() & (F.size(values) > 0))


def read_latest_partition(
    spark: SparkSession,
    root: str,
    schema: StructType,
    columns: Iterable[str] | None = None,
    column: str = "date",
) -> DataFrame:
    """The newest ``column=yyyy-MM-dd`` folder only, ``column`` filled with its date.

    Older folders are neither listed nor read. The files do not hold ``column``
    themselves, so it is added as a constant of its declared type.
    """
    newest, folders = latest_partition(spark, root, column)
    in_files = StructType([f for f in schema.fields if f.name != column])
    day = F.lit(newest).cast(schema[column].dataType)
    files = spark.read.schema(in_files).option("header", True).option("delimiter", ",").csv(folders)
    return files.withColumn(column, day).selectExpr(*(columns or schema.names))


def filter_latest(table: DataFrame, column: str) -> DataFrame:
    """Rows with the newest ``column`` of a table that is not laid out in date folders.

    The maximum is a scalar subquery: one value, known before the scan is planned to
    its end, and pushed into it.
    """
    newest = table.agg(F.max(column).alias("_newest")).scalar()
    return table.where(F.col(column) == newest)


class Tables:
    """Named tables, loaded on first use and kept; names are case-insensitive."""

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        self._loaders = {name.lower(): load for name, load in loaders.items()}
        self._loaded: dict[str, DataFrame] = {}

    def get(self, name: str) -> DataFrame:
        wanted = name.lower()
        if wanted not in self._loaders:
            known = ", ".join(sorted(self._loaders))
            raise ValueError(f"unknown table {name!r}; expected one of: {known}")
        if wanted not in self._loaded:
            self._loaded[wanted] = self._loaders[wanted]()
        return self._loaded[wanted]


def client_order_tables(
    spark: SparkSession,
    clients_path: str,
    orders_root: str,
    clients_schema: StructType = CLIENTS,
    orders_schema: StructType = ORDERS,
    partition_column: str = "date",
) -> Tables:
    """``clients``, and ``orders`` of the newest partition, with declared columns only."""
    return Tables(
        {
            "clients": lambda: read_csv_table(
                spark, clients_path, clients_schema, projection_of("clients")
            ),
            "orders": lambda: read_latest_partition(
                spark, orders_root, orders_schema, projection_of("orders"), partition_column
            ),
        }
    )
