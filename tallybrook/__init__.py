"""Client-order enrichment and log analytics as plain PySpark DataFrame functions."""

from tallybrook.operators.compare import diff, diff_counts, same_rows
from tallybrook.operators.digests import digest_diff, digest_diff_counts, same_digests
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
from tallybrook.operators.prefilter import may_match
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
from tallybrook.sinks.parquet import write_partitioned
from tallybrook.sources.buckets import open_bucketed, write_bucketed
from tallybrook.sources.partitions import latest_partition_value
from tallybrook.sources.tables import (
    Tables,
    bad_csv_rows,
    client_order_tables,
    filter_latest,
    read_csv_table,
    read_latest_partition,
)
from tallybrook.sources.text_lines import read_text_lines, stream_text_lines
from tallybrook.streaming.batches import read_batches, start_batches, write_batch
from tallybrook.streaming.sink import start_stream

__all__ = [
    "Tables",
    "bad_csv_rows",
    "client_order_tables",
    "current_earliest",
    "current_level_counts",
    "diff",
    "diff_counts",
    "digest_diff",
    "digest_diff_counts",
    "earliest",
    "enrich_orders",
    "enriched_latest_orders",
    "error_lines",
    "errors_only",
    "filter_latest",
    "latest_partition_value",
    "level_distribution",
    "malformed",
    "may_match",
    "open_bucketed",
    "parse_logs",
    "parse_well_formed",
    "read_batches",
    "read_csv_table",
    "read_latest_partition",
    "read_route",
    "read_text_lines",
    "run_client_orders",
    "run_earliest_lines",
    "run_level_counts",
    "run_log_stream",
    "run_routed_log_stream",
    "same_digests",
    "same_rows",
    "start_batches",
    "start_stream",
    "stream_text_lines",
    "well_formed",
    "write_batch",
    "write_bucketed",
    "write_partitioned",
]
