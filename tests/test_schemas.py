from __future__ import annotations

import datetime

import pytest
from pyspark.sql import types as T

from tallybrook import schemas


def shape(schema):
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema]


def test_clients():
    assert shape(schemas.CLIENTS) == [
        ("clientId", "int", True), ("name", "string", True), ("location", "string", True),
    ]


def test_orders():
    assert shape(schemas.ORDERS) == [
        ("orderId", "int", True), ("clientId", "int", True), ("amount", "double", True),
        ("date", "date", True),
    ]


def test_log_schemas_are_all_text():
    assert schemas.LOG_LINE.names == ["value"]
    assert schemas.PARSED_LOG.names == ["log_timestamp", "level", "thread", "logger", "message"]
    assert schemas.ERROR_LOG.names == ["log_timestamp", "logger", "message"]
    for schema in (schemas.LOG_LINE, schemas.PARSED_LOG, schemas.ERROR_LOG):
        assert {f.dataType for f in schema} == {T.StringType()}


def test_rows_fit_the_schemas(spark):
    clients = spark.createDataFrame([(None, None, "quay"), (2**31 - 1, "", None)], schemas.CLIENTS)
    leap_day = datetime.date(2020, 2, 29)
    orders = spark.createDataFrame([(-4, 908, -0.5, leap_day), (None,) * 4, (8, None, 1e12, None)], schemas.ORDERS)
    assert clients.schema == schemas.CLIENTS and clients.count() == 2
    assert orders.schema == schemas.ORDERS
    assert [r.date for r in orders.where("orderId < 0").collect()] == [leap_day]


@pytest.mark.parametrize("name", ["clients", "CLIENTS", "Clients"])
def test_lookup_ignores_case(name):
    assert schemas.schema_of(name) is schemas.CLIENTS
    assert schemas.projection_of(name) == ("clientId", "name", "location")


def test_orders_projection():
    assert schemas.projection_of("orders") == ("orderId", "clientId", "amount", "date")


@pytest.mark.parametrize("lookup", [schemas.schema_of, schemas.projection_of])
def test_unknown_table(lookup):
    with pytest.raises(ValueError, match="unknown table 'products'"):
        lookup("products")


def test_with_types():
    wide = schemas.with_types(schemas.CLIENTS, clientId=T.LongType())
    assert shape(wide)[0] == ("clientId", "bigint", True)
    assert shape(wide)[1:] == shape(schemas.CLIENTS)[1:]
    with pytest.raises(ValueError, match="no such field"):
        schemas.with_types(schemas.CLIENTS, id=T.LongType())
