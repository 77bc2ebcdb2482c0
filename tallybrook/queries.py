"""Queries over the shared test tables, each with the SQL it must agree with.

Clients are ``customer``, orders are ``orders``; log lines are made from ``events``,
one per event. Each query works on whole tables. Files that a query reads back are
written to the shared scratch folder first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook import schemas
from tallybrook.functions.dates import iso_date_text, millisecond_text
from tallybrook.functions.log_fields import LOG_PATTERN
from tallybrook.operators.compare import diff, diff_counts
from tallybrook.operators.digests import digest_diff, digest_diff_counts
from tallybrook.operators.enrich import enrich_orders
from tallybrook.operators.logs import (
    earliest,
    errors_only,
    level_distribution,
    malformed,
    parse_logs,
    parse_well_formed,
    well_formed,
)
from tallybrook.plans.client_orders import enriched_latest_orders, run_client_orders
from tallybrook.plans.log_batches import (
    current_earliest,
    current_level_counts,
    read_route,
    run_earliest_lines,
    run_level_counts,
    run_routed_log_stream,
)
from tallybrook.plans.log_stream import error_lines, run_log_stream
from tallybrook.scratch import shared_folder
from tallybrook.sinks.parquet import write_partitioned
from tallybrook.sources.buckets import write_bucketed
from tallybrook.sources.tables import Tables, bad_csv_rows, client_order_tables, filter_latest
from tallybrook.sources.text_lines import read_text_lines


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _query(sql: str | None, name: str | None = None):
    def register(run):
        REGISTRY[name or run.__name__] = Query(run, sql)
        return run

    return register


# --- tables -----------------------------------------------------------------

# The test tables have BIGINT keys where the declared tables have INT.
CLIENTS = schemas.with_types(schemas.CLIENTS, clientId=T.LongType())
ORDERS = schemas.with_types(schemas.ORDERS, clientId=T.LongType(), orderId=T.LongType())


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("clientId"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("location"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderId"),
        F.col("o_custkey").alias("clientId"),
        F.col("o_totalprice").alias("amount"),
        iso_date_text(F.col("o_orderdate")).alias("date"),
    )


_STAGED: dict[tuple[str, str, str], str] = {}


def _staged(spark: SparkSession, sf_dir: str, purpose: str, write: Callable[[str], None]) -> str:
    """A folder with files made from the test tables, written once per session."""
    made = (spark.sparkContext.applicationId, sf_dir, purpose)
    if made not in _STAGED:
        folder = shared_folder(spark, purpose)
        write(folder)
        _STAGED[made] = folder
    return _STAGED[made]


def _staged_csv(spark: SparkSession, sf_dir: str) -> str:
    """Clients, and orders with one date folder per year."""

    def write(folder):
        clients(spark, sf_dir).write.option("header", True).csv(f"{folder}/clients")
        by_year = orders(spark, sf_dir).withColumn("date", F.trunc("date", "year"))
        files = by_year.hint("rebalance", F.col("date")).write.option("header", True)
        files.partitionBy("date").csv(f"{folder}/orders")

    return _staged(spark, sf_dir, "csv", write)


def _csv_tables(spark: SparkSession, folder: str) -> Tables:
    return client_order_tables(spark, f"{folder}/clients", f"{folder}/orders", CLIENTS, ORDERS)


_CLIENTS_SQL = """SELECT c_custkey AS clientId, c_name AS name, c_mktsegment AS location
  FROM customer"""
_ORDERS_SQL = """SELECT o_orderkey AS orderId, o_custkey AS clientId, o_totalprice AS amount,
  strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders"""
_NEWEST_YEAR_SQL = """SELECT o_orderkey AS orderId, o_custkey AS clientId, o_totalprice AS amount,
  strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS date
  FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)"""


def _enrichment_sql(orders_sql: str, where: str = "") -> str:
    return f"""WITH c AS ({_CLIENTS_SQL}), o AS ({orders_sql}), enriched AS (
  SELECT clientId, name, location, orderId, amount, date,
    ROUND(SUM(amount) OVER (PARTITION BY clientId), 2) AS totalAmountByClient
  FROM c LEFT JOIN o USING (clientId))
SELECT * FROM enriched {where}"""


def _rounded(enriched: DataFrame) -> DataFrame:
    # the last digits of a sum of doubles depend on the order of summation
    return enriched.withColumn("totalAmountByClient", F.round("totalAmountByClient", 2))


# --- enrichment -------------------------------------------------------------


@_query(_enrichment_sql(_ORDERS_SQL))
def client_order_enrichment(spark, sf_dir):
    """Left join and client total; adaptive execution picks the join."""
    return _rounded(enrich_orders(clients(spark, sf_dir), orders(spark, sf_dir)))


@_query(_enrichment_sql(_ORDERS_SQL))
def client_order_enrichment_preagg(spark, sf_dir):
    """Orders streamed past broadcast clients that carry pre-aggregated totals."""
    return _rounded(
        enrich_orders(clients(spark, sf_dir), orders(spark, sf_dir), strategy="clients")
    )


@_query(_enrichment_sql(_ORDERS_SQL))
def client_order_enrichment_broadcast(spark, sf_dir):
    """Clients streamed past broadcast orders, where these fit."""
    return _rounded(enrich_orders(clients(spark, sf_dir), orders(spark, sf_dir), strategy="orders"))


@_query(_enrichment_sql(_ORDERS_SQL))
def client_order_enrichment_sliced(spark, sf_dir):
    """Shuffle join with hot clients cut into slices."""
    return _rounded(
        enrich_orders(
            clients(spark, sf_dir), orders(spark, sf_dir), strategy="sliced", slice_rows=8
        )
    )


@_query(
    f"""WITH c AS ({_CLIENTS_SQL}), o AS (
  SELECT o_orderkey AS orderId, o_custkey AS clientId,
    CAST(CAST(o_totalprice AS DECIMAL(12,2))
      + CAST(o_orderkey AS DECIMAL(10,0)) * CAST('0.0000000001' AS DECIMAL(11,10)) AS DECIMAL(20,10)) AS amount
  FROM orders)
SELECT clientId, name, location, orderId, CAST(amount AS VARCHAR) AS amount,
  CAST(CAST(SUM(amount) OVER (PARTITION BY clientId) AS DECIMAL(30,10)) AS VARCHAR) AS totalAmountByClient
FROM c LEFT JOIN o USING (clientId)"""
)
def client_order_enrichment_decimal(spark, sf_dir):
    """Totals of DECIMAL amounts, to the last digit."""
    digits = F.col("orderId").cast("decimal(10,0)") * F.lit("0.0000000001").cast("decimal(11,10)")
    amount = (F.col("amount").cast("decimal(12,2)") + digits).cast("decimal(20,10)")
    exact = orders(spark, sf_dir).withColumn("amount", amount)
    enriched = enrich_orders(clients(spark, sf_dir), exact.drop("date"), strategy="sliced", slice_rows=8)
    return enriched.withColumns(
        {c: F.col(c).cast("string") for c in ("amount", "totalAmountByClient")}
    )


@_query(_enrichment_sql(_ORDERS_SQL).replace("clientId", "clientid").replace("orderId", "orderid"))
def client_order_enrichment_lower_case(spark, sf_dir):
    """Frames with names in lower case, joined by the default key."""
    sides = [df.toDF(*map(str.lower, df.columns)) for df in (clients(spark, sf_dir), orders(spark, sf_dir))]
    return _rounded(enrich_orders(*sides))


@_query(_enrichment_sql(_ORDERS_SQL))
def client_order_enrichment_bucketed(spark, sf_dir):
    """Clients kept in buckets by their id: only the orders move."""
    made = []

    def write(folder):
        made.append(write_bucketed(clients(spark, sf_dir), f"clients_{uuid.uuid4().hex}", folder, "clientId", 32))

    folder = _staged(spark, sf_dir, "buckets", write)
    _BUCKETED.setdefault(folder, made[0] if made else None)
    return _rounded(enrich_orders(_BUCKETED[folder], orders(spark, sf_dir), strategy="buckets"))


_BUCKETED: dict[str, DataFrame] = {}


@_query(
    f"""WITH c AS ({_CLIENTS_SQL}), o AS ({_ORDERS_SQL} WHERE o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey, o_custkey + 100000000, o_totalprice, strftime(o_orderdate, '%Y-%m-%d')
  FROM orders WHERE o_orderkey % 2 = 1)
SELECT clientId, name, location, orderId, amount, date,
  ROUND(SUM(amount) OVER (PARTITION BY clientId), 2) AS totalAmountByClient
FROM c LEFT JOIN o USING (clientId)"""
)
def client_order_enrichment_unknown_clients(spark, sf_dir):
    """Half the orders are of unknown clients; a Bloom filter drops them before the shuffle."""
    other = F.when(F.col("orderId") % 2 == 1, F.col("clientId") + 100_000_000).otherwise(F.col("clientId"))
    half = orders(spark, sf_dir).withColumn("clientId", other)
    return _rounded(enrich_orders(clients(spark, sf_dir), half, bloom_bits=1 << 20))


@_query(
    f"""WITH c AS ({_CLIENTS_SQL}), o AS ({_ORDERS_SQL})
SELECT count(*) AS n_rows, count(orderId) AS n_orders FROM c LEFT JOIN o USING (clientId)"""
)
def enrichment_row_count(spark, sf_dir):
    enriched = enrich_orders(clients(spark, sf_dir), orders(spark, sf_dir))
    return enriched.agg(F.count(F.lit(1)).alias("n_rows"), F.count("orderId").alias("n_orders"))


# --- sources ----------------------------------------------------------------


@_query(_CLIENTS_SQL)
def clients_csv_scan(spark, sf_dir):
    """CSV with declared schema, by (case-insensitive) name."""
    return _csv_tables(spark, _staged_csv(spark, sf_dir)).get("CLIENTS")


def _staged_bad_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(folder):
        bad_id, no_location = F.col("c_nationkey") < 10, F.col("c_acctbal") < 0
        _table(spark, sf_dir, "customer").select(
            F.when(bad_id, F.concat(F.lit("id-"), "c_custkey"))
            .otherwise(F.col("c_custkey").cast("string"))
            .alias("clientId"),
            F.col("c_name").alias("name"),
            F.when(~no_location, F.col("c_mktsegment")).alias("location"),
        ).write.option("header", True).csv(f"{folder}/clients")

    return _staged(spark, sf_dir, "csv-bad-values", write)


@_query(
    """SELECT CASE WHEN c_nationkey < 10 THEN NULL ELSE c_custkey END AS clientId,
  c_name AS name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS location
FROM customer"""
)
def clients_csv_bad_values(spark, sf_dir):
    """Ids that are not numbers and empty locations arrive as NULL, the rows stay."""
    return _csv_tables(spark, _staged_bad_csv(spark, sf_dir)).get("clients")


@_query(
    """SELECT CAST(NULL AS BIGINT) AS clientId, c_name AS name,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS location,
  'id-' || c_custkey || ',' || c_name || ',' || CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS bad_row
FROM customer WHERE c_nationkey < 10"""
)
def clients_csv_bad_rows(spark, sf_dir):
    """Rows with a value that is not of its type, with their text."""
    return bad_csv_rows(spark, f"{_staged_bad_csv(spark, sf_dir)}/clients", CLIENTS)


@_query(_NEWEST_YEAR_SQL)
def latest_partition_scan(spark, sf_dir):
    """Only the newest date folder is read."""
    newest = _csv_tables(spark, _staged_csv(spark, sf_dir)).get("orders")
    return newest.withColumn("date", iso_date_text(F.col("date")))


@_query(
    f"""SELECT * FROM ({_ORDERS_SQL})
WHERE date = (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders)"""
)
def latest_partition_subquery(spark, sf_dir):
    """The newest date of a table that is not laid out in folders."""
    newest = filter_latest(_table(spark, sf_dir, "orders"), "o_orderdate")
    return newest.select(
        F.col("o_orderkey").alias("orderId"),
        F.col("o_custkey").alias("clientId"),
        F.col("o_totalprice").alias("amount"),
        iso_date_text(F.col("o_orderdate")).alias("date"),
    )


# --- batch job and sinks ----------------------------------------------------


@_query(_enrichment_sql(_NEWEST_YEAR_SQL))
def batch_enrichment_latest(spark, sf_dir):
    """The whole batch job: CSV in, partitioned Parquet out, read back."""
    folder, out = _staged_csv(spark, sf_dir), shared_folder(spark, "enriched")
    schema = run_client_orders(
        spark,
        f"{folder}/clients",
        f"{folder}/orders",
        out,
        clients_schema=CLIENTS,
        orders_schema=ORDERS,
    )
    return _rounded(spark.read.schema(schema).parquet(out).select(*schema.names))


@_query(_enrichment_sql(_NEWEST_YEAR_SQL, "WHERE orderId IS NULL"))
def clients_without_recent_orders(spark, sf_dir):
    """The NULL side of the left join, by an ad-hoc predicate."""
    enriched = enriched_latest_orders(_csv_tables(spark, _staged_csv(spark, sf_dir)))
    return _rounded(enriched.where("orderId IS NULL"))


def _written_clients(spark, sf_dir, purpose, *writes) -> DataFrame:
    path = shared_folder(spark, purpose)
    for transform, mode, options in writes:
        write_partitioned(transform(clients(spark, sf_dir)), path, "location", mode, **options)
    return spark.read.schema(CLIENTS).parquet(path).select(*CLIENTS.names)


def _renamed(table: DataFrame) -> DataFrame:
    return table.withColumn("name", F.upper("name"))


@_query(f"SELECT * FROM ({_CLIENTS_SQL}) UNION ALL SELECT * FROM ({_CLIENTS_SQL})")
def partitioned_write_append(spark, sf_dir):
    return _written_clients(
        spark, sf_dir, "append",
        (lambda c: c, "append", {}), (lambda c: c, "append", {}),
    )


@_query(f"SELECT clientId, upper(name) AS name, location FROM ({_CLIENTS_SQL})")
def partitioned_write_overwrite(spark, sf_dir):
    """The second write replaces the first; two write tasks at most."""
    return _written_clients(
        spark, sf_dir, "overwrite",
        (lambda c: c, "overwrite", {}), (_renamed, "overwrite", {"coalesce": 2}),
    )


@_query(
    f"""SELECT clientId, CASE WHEN location = 'BUILDING' THEN upper(name) ELSE name END AS name,
  location FROM ({_CLIENTS_SQL})"""
)
def partitioned_write_dynamic_overwrite(spark, sf_dir):
    """The second write replaces its own locations only."""
    return _written_clients(
        spark, sf_dir, "dynamic",
        (lambda c: c, "overwrite", {}),
        (lambda c: _renamed(c.where("location = 'BUILDING'")), "overwrite",
         {"partitionOverwriteMode": "dynamic"}),
    )


# --- logs -------------------------------------------------------------------

# How an event type shows as a log level; TRACE is outside the grammar.
_LEVELS = {
    "error": "ERROR",
    "click": "INFO ",
    "view": "DEBUG",
    "purchase": "WARN ",
    "signup": "TRACE",
}


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw line per event; some are shaped like stack-trace lines."""
    event = F.col("event_type")
    level = F.upper(event)
    for name, shown in _LEVELS.items():
        level = F.when(event == name, shown).otherwise(level)
    line = F.concat(
        millisecond_text(F.col("ts")), F.lit(" "), level, F.lit(" [user-"), "user_id",
        F.lit("] app."), event, F.lit(" - "), F.coalesce("props", F.lit("")),
    )
    frame = F.concat(F.lit("  at frame "), "event_id")
    return _table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 11 == 0, frame).otherwise(line).alias("value")
    )


_LEVEL_SQL = " ".join(f"WHEN '{name}' THEN '{shown}'" for name, shown in _LEVELS.items())
_LINES_SQL = f"""SELECT CASE WHEN event_id % 11 = 0 THEN '  at frame ' || event_id
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' '
    || CASE event_type {_LEVEL_SQL} ELSE upper(event_type) END
    || ' [user-' || user_id || '] app.' || event_type || ' - ' || coalesce(props, '')
  END AS value FROM events"""
_PARSED_SQL = f"""WITH lines AS ({_LINES_SQL}), parsed AS (SELECT
{", ".join(f"regexp_extract(value, '{LOG_PATTERN}', {i}) AS {name}"
           for i, name in enumerate(schemas.PARSED_LOG.names, 1))}
FROM lines)"""  # fmt: skip
_WELL_FORMED_SQL = f"{_PARSED_SQL} SELECT * FROM parsed WHERE level <> ''"
_ERRORS_SQL = f"""{_PARSED_SQL}
SELECT log_timestamp, logger, message FROM parsed WHERE level = 'ERROR'"""


def _staged_lines(spark: SparkSession, sf_dir: str) -> str:
    return _staged(
        spark, sf_dir, "log-lines", lambda folder: log_lines(spark, sf_dir).write.text(f"{folder}/logs")
    )


@_query(f"{_PARSED_SQL} SELECT * FROM parsed", name="parse_logs")
def parsed_log_lines(spark, sf_dir):
    """Text files through the parser; unmatched lines stay, with empty fields."""
    return parse_logs(read_text_lines(spark, f"{_staged_lines(spark, sf_dir)}/logs"))


@_query(_WELL_FORMED_SQL)
def well_formed_logs(spark, sf_dir):
    return well_formed(parse_logs(log_lines(spark, sf_dir)))


@_query(_WELL_FORMED_SQL)
def well_formed_logs_one_pass(spark, sf_dir):
    """The same from raw lines, as the streaming job does it."""
    return parse_well_formed(log_lines(spark, sf_dir))


@_query(_ERRORS_SQL)
def error_logs(spark, sf_dir):
    return errors_only(parse_logs(log_lines(spark, sf_dir)))


@_query(f"{_PARSED_SQL} SELECT * FROM parsed WHERE level = 'INFO'")
def info_logs(spark, sf_dir):
    """An ad-hoc predicate over parsed rows."""
    return parse_logs(log_lines(spark, sf_dir)).filter("level = 'INFO'")


@_query(f"SELECT value FROM ({_LINES_SQL}) WHERE NOT regexp_matches(value, '{LOG_PATTERN}')")
def malformed_log_lines(spark, sf_dir):
    return malformed(log_lines(spark, sf_dir))


@_query(
    f"""{_PARSED_SQL}
SELECT level, count(*) AS lines FROM parsed WHERE level <> '' GROUP BY level"""
)
def log_level_distribution(spark, sf_dir):
    return level_distribution(parse_logs(log_lines(spark, sf_dir)))


@_query(f"{_WELL_FORMED_SQL} ORDER BY log_timestamp, level, thread, logger, message LIMIT 1")
def earliest_log_line(spark, sf_dir):
    return earliest(parse_logs(log_lines(spark, sf_dir)))


# --- streaming --------------------------------------------------------------


def _stream_to_end(spark, logs, folder, **options) -> None:
    run_log_stream(
        spark, f"{logs}/logs", f"{folder}/checkpoint", f"{folder}/out",
        available_now=True, **options,
    ).awaitTermination()


@_query(_WELL_FORMED_SQL)
def stream_well_formed_logs(spark, sf_dir):
    """The streaming job over text files, run to its end and read back."""
    folder = shared_folder(spark, "stream")
    _stream_to_end(spark, _staged_lines(spark, sf_dir), folder)
    return spark.read.schema(schemas.PARSED_LOG).parquet(f"{folder}/out")


@_query(_ERRORS_SQL)
def stream_error_logs(spark, sf_dir):
    folder = shared_folder(spark, "stream")
    _stream_to_end(spark, _staged_lines(spark, sf_dir), folder, rows_of=error_lines)
    return spark.read.schema(schemas.ERROR_LOG).parquet(f"{folder}/out")


@_query(f"{_WELL_FORMED_SQL} UNION ALL SELECT * FROM parsed WHERE level <> ''")
def stream_restart_exactly_once(spark, sf_dir):
    """Restarts on one checkpoint: old files are not read again, new ones are."""
    folder = shared_folder(spark, "stream")
    log_lines(spark, sf_dir).write.text(f"{folder}/logs")
    _stream_to_end(spark, folder, folder)
    _stream_to_end(spark, folder, folder)  # nothing new
    log_lines(spark, sf_dir).write.mode("append").text(f"{folder}/logs")
    _stream_to_end(spark, folder, folder)
    return spark.read.schema(schemas.PARSED_LOG).parquet(f"{folder}/out")


@_query(_WELL_FORMED_SQL)
def stream_one_file_per_batch(spark, sf_dir):
    """Several files, a micro-batch for each."""
    folder = shared_folder(spark, "stream")
    log_lines(spark, sf_dir).repartition(3).write.text(f"{folder}/logs")
    _stream_to_end(spark, folder, folder, max_files_per_trigger=1)
    return spark.read.schema(schemas.PARSED_LOG).parquet(f"{folder}/out")


@_query(_WELL_FORMED_SQL)
def stream_processing_time(spark, sf_dir):
    """The interval trigger: what is there is processed, then the query is stopped."""
    folder = shared_folder(spark, "stream")
    query = run_log_stream(
        spark, f"{_staged_lines(spark, sf_dir)}/logs", f"{folder}/checkpoint", f"{folder}/out", interval_ms=200
    )
    query.processAllAvailable()
    query.stop()
    return spark.read.schema(schemas.PARSED_LOG).parquet(f"{folder}/out")


def _routed(spark, sf_dir, route) -> DataFrame:
    """One pass over several files writes all routes; run once per session."""

    def write(folder):
        log_lines(spark, sf_dir).repartition(3).write.text(f"{folder}/logs")
        run_routed_log_stream(
            spark, f"{folder}/logs", f"{folder}/checkpoint", f"{folder}/out",
            available_now=True, max_files_per_trigger=2,
        ).awaitTermination()

    return read_route(spark, f"{_staged(spark, sf_dir, 'routed', write)}/out", route)


@_query(_WELL_FORMED_SQL)
def stream_routed_well_formed(spark, sf_dir):
    return _routed(spark, sf_dir, "well_formed")


@_query(_ERRORS_SQL)
def stream_routed_errors(spark, sf_dir):
    return _routed(spark, sf_dir, "errors")


@_query(f"SELECT value FROM ({_LINES_SQL}) WHERE NOT regexp_matches(value, '{LOG_PATTERN}')")
def stream_routed_malformed(spark, sf_dir):
    return _routed(spark, sf_dir, "malformed")


def _counted_over_a_restart(spark, sf_dir, output_mode) -> DataFrame:
    folder = shared_folder(spark, "counts")
    for _ in range(2):
        log_lines(spark, sf_dir).repartition(2).write.mode("append").text(f"{folder}/logs")
        run_level_counts(
            spark, f"{folder}/logs", f"{folder}/checkpoint", f"{folder}/out",
            output_mode=output_mode, available_now=True, max_files_per_trigger=1,
        ).awaitTermination()
    return current_level_counts(spark, f"{folder}/out")


_COUNTED_TWICE_SQL = f"""{_PARSED_SQL}
SELECT level, 2 * count(*) AS lines FROM parsed WHERE level <> '' GROUP BY level"""


@_query(_COUNTED_TWICE_SQL)
def stream_level_counts_update(spark, sf_dir):
    """Counts kept as state over a restart; each batch writes the levels that it changed."""
    return _counted_over_a_restart(spark, sf_dir, "update")


@_query(_COUNTED_TWICE_SQL)
def stream_level_counts_complete(spark, sf_dir):
    """The same, all levels written with each batch."""
    return _counted_over_a_restart(spark, sf_dir, "complete")


@_query(f"{_WELL_FORMED_SQL} ORDER BY log_timestamp, level, thread, logger, message LIMIT 7")
def stream_earliest_lines(spark, sf_dir):
    """The first lines over several batches, each merged with those kept so far."""
    folder = shared_folder(spark, "first-lines")
    log_lines(spark, sf_dir).repartition(3).write.text(f"{folder}/logs")
    run_earliest_lines(
        spark, f"{folder}/logs", f"{folder}/checkpoint", f"{folder}/out", n=7,
        available_now=True, max_files_per_trigger=1,
    ).awaitTermination()
    return current_earliest(spark, f"{folder}/out", 7)


# --- difference -------------------------------------------------------------


def _ordering_and_visiting(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    ordering = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    visiting = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return ordering, visiting


_DIFF_SQL = """SELECT id, 'left' AS side FROM
  (SELECT o_custkey AS id FROM orders EXCEPT ALL SELECT user_id FROM events)
UNION ALL SELECT id, 'right' AS side FROM
  (SELECT user_id AS id FROM events EXCEPT ALL SELECT o_custkey FROM orders)"""


@_query(_DIFF_SQL)
def dataset_difference(spark, sf_dir):
    """Both directions of a difference that counts duplicates."""
    return diff(*_ordering_and_visiting(spark, sf_dir))


@_query(_DIFF_SQL)
def dataset_difference_by_digests(spark, sf_dir):
    """The same through bucket digests; here most buckets differ."""
    return digest_diff(*_ordering_and_visiting(spark, sf_dir))


@_query(
    f"""SELECT clientId, name, location, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM ({_CLIENTS_SQL}) WHERE clientId % 500 = 1
UNION ALL SELECT clientId, upper(name) || '!', location, 'right', 1 FROM ({_CLIENTS_SQL}) WHERE clientId % 500 = 1"""
)
def changed_clients_by_digests(spark, sf_dir):
    """Two tables of which few rows differ: only their buckets are compared as rows."""
    old = clients(spark, sf_dir)
    name = F.when(F.col("clientId") % 500 == 1, F.concat(F.upper("name"), F.lit("!"))).otherwise(F.col("name"))
    return digest_diff_counts(old, old.withColumn("name", name))


@_query(f"SELECT id, side, count(*) AS copies FROM ({_DIFF_SQL}) GROUP BY id, side")
def dataset_difference_counts(spark, sf_dir):
    return diff_counts(*_ordering_and_visiting(spark, sf_dir))
