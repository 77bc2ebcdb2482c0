"""Declared schemas and projections. Nothing is ever inferred from the data.

Every field is nullable: CSV is read in PERMISSIVE mode, so text that does not
fit its type arrives as NULL and the row is kept.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table names, field names and field types of all inputs and outputs.


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


CLIENTS = T.StructType(
    [
        T.StructField("clientId", T.IntegerType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("location", T.StringType(), True),
    ]
)

# ``date`` is the partition column of the orders folder, not a CSV column.
ORDERS = T.StructType(
    [
        T.StructField("orderId", T.IntegerType(), True),
        T.StructField("clientId", T.IntegerType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("date", T.DateType(), True),
    ]
)

# Output of the enrichment; ``date`` leaves as yyyy-MM-dd text.
ENRICHED_ORDERS = T.StructType(
    [
        T.StructField("clientId", T.IntegerType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("location", T.StringType(), True),
        T.StructField("orderId", T.IntegerType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("totalAmountByClient", T.DoubleType(), True),
    ]
)

LOG_LINE = _strings("value")
PARSED_LOG = _strings("log_timestamp", "level", "thread", "logger", "message")
ERROR_LOG = _strings("log_timestamp", "logger", "message")

SCHEMAS: dict[str, T.StructType] = {"clients": CLIENTS, "orders": ORDERS}

# Column expressions per table, in output order; ``selectExpr`` syntax, so an
# entry may carry an alias.
PROJECTIONS: dict[str, tuple[str, ...]] = {
    "clients": ("clientId", "name", "location"),
    "orders": ("orderId", "clientId", "amount", "date"),
}


def _lookup(mapping, table: str):
    try:
        return mapping[table.lower()]
    except KeyError:
        known = ", ".join(sorted(mapping))
        raise ValueError(f"unknown table {table!r}; expected one of: {known}") from None


def schema_of(table: str) -> T.StructType:
    return _lookup(SCHEMAS, table)


def projection_of(table: str) -> tuple[str, ...]:
    return _lookup(PROJECTIONS, table)


def with_types(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """The same schema with some fields' types replaced (e.g. BIGINT keys)."""
    unknown = set(types) - set(schema.names)
    if unknown:
        raise ValueError(f"no such field(s): {', '.join(sorted(unknown))}")
    return T.StructType(
        [T.StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in schema.fields]
    )
