"""Batch job: clients and the newest orders in, enriched Parquet out."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallybrook.functions.dates import iso_date_text
from tallybrook.operators.enrich import enrich_orders
from tallybrook.schemas import CLIENTS, ORDERS, SCHEMAS
from tallybrook.scratch import cleared, written
from tallybrook.sinks.parquet import write_partitioned
from tallybrook.sources.partitions import latest_partition
from tallybrook.sources.tables import Tables, bad_csv_rows, client_order_tables


def enriched_latest_orders(
    tables: Tables, partition_column: str = "date", **enrich_options
) -> DataFrame:
    """Every client with its orders of the newest partition, the date as text."""
    orders = tables.get("orders")
    orders = orders.withColumn(partition_column, iso_date_text(orders[partition_column]))
    return enrich_orders(tables.get("clients"), orders, **enrich_options)


def run_client_orders(
    spark: SparkSession,
    clients_path: str,
    orders_root: str,
    output_path: str,
    *,
    clients_schema: StructType = CLIENTS,
    orders_schema: StructType = ORDERS,
    partition_column: str = "date",
    partition_by: str = "location",
    mode: str = "overwrite",
    columnar_copy: bool = False,
    bad_rows_path: str | None = None,
    enrich_options: dict | None = None,
    write_options: dict | None = None,
) -> StructType:
    """Read, enrich and write; returns the schema to read the output back with.

    Read back with that schema: without it the type of the partition column is
    guessed from folder names. ``columnar_copy`` parses the CSV files once into Parquet
    in the shared scratch folder; worth it for large inputs, which the enrichment reads
    twice, once a few columns only. What is written there is deleted when the job is done.
    With ``bad_rows_path`` the rows of both inputs that hold a bad value are listed there as
    well, below ``clients`` and ``orders``, in place of those of an earlier run.
    """
    if bad_rows_path:
        of_orders = StructType([f for f in orders_schema.fields if f.name != partition_column])
        folders = latest_partition(spark, orders_root, partition_column)[1]
        for name, path, schema in (("clients", clients_path, clients_schema), ("orders", folders, of_orders)):
            bad_csv_rows(spark, path, schema).write.mode("overwrite").parquet(f"{bad_rows_path}/{name}")
    with cleared(spark):
        return _run(
            spark, clients_path, orders_root, output_path, clients_schema, orders_schema,
            partition_column, partition_by, mode, columnar_copy, enrich_options or {},
            write_options or {},
        )


def _run(
    spark, clients_path, orders_root, output_path, clients_schema, orders_schema,
    partition_column, partition_by, mode, columnar_copy, enrich_options, write_options,
) -> StructType:
    tables = client_order_tables(
        spark, clients_path, orders_root, clients_schema, orders_schema, partition_column
    )
    if columnar_copy:
        tables = Tables(
            {name: functools.partial(written, tables.get(name), name) for name in SCHEMAS}
        )
    enriched = enriched_latest_orders(tables, partition_column, **enrich_options)
    write_partitioned(enriched, output_path, partition_by, mode, **write_options)
    return enriched.schema
