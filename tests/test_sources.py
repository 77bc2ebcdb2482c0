"""CSV tables, date folders, named access, text lines."""

from __future__ import annotations

import datetime

import pytest

from tallybrook import schemas
from tallybrook.functions.dates import iso_date_text, millisecond_text
from tallybrook.plans.client_orders import run_client_orders
from tallybrook.sources.partitions import latest_partition_value, partition_folders
from tallybrook.sources.tables import (
    Tables,
    bad_csv_rows,
    client_order_tables,
    filter_latest,
    read_csv_table,
    read_latest_partition,
)
from tallybrook.sources.text_lines import read_text_lines

HEADER = "orderId,clientId,amount\n"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


class TestCsv:
    def test_declared_types(self, spark, tmp_path):
        put(tmp_path, "c.csv", "clientId,name,location\n1,Ada,Lyon\n2,Ben,Oslo\n")
        df = read_csv_table(spark, str(tmp_path), schemas.CLIENTS)
        assert df.schema == schemas.CLIENTS
        assert sorted(tuple(r) for r in df.collect()) == [(1, "Ada", "Lyon"), (2, "Ben", "Oslo")]

    def test_bad_values_become_null_and_the_row_stays(self, spark, tmp_path):
        put(tmp_path, "c.csv", "clientId,name,location\nx,Ada,Lyon\n2,Ben,\n3\n")
        rows = [tuple(r) for r in read_csv_table(spark, str(tmp_path), schemas.CLIENTS).collect()]
        assert rows == [(None, "Ada", "Lyon"), (2, "Ben", None), (3, None, None)]

    def test_projection_may_rename(self, spark, tmp_path):
        put(tmp_path, "c.csv", "clientId,name,location\n1,Ada,Lyon\n")
        df = read_csv_table(spark, str(tmp_path), schemas.CLIENTS, ["clientid AS id", "name"])
        assert df.columns == ["id", "name"]

    def test_reads_only_wanted_columns(self, spark, tmp_path):
        put(tmp_path, "c.csv", "clientId,name,location\n1,Ada,Lyon\n")
        df = read_csv_table(spark, str(tmp_path), schemas.CLIENTS, ["name"])
        assert "ReadSchema: struct<name:string>" in executed(df)


class TestLatestPartition:
    def test_newest_by_date_not_by_text(self, spark, tmp_path):
        for day in ("2023-01-01", "2023-9-5", "2023-10-20", "2022-12-31"):
            put(tmp_path / f"date={day}", "o.csv", HEADER + "1,1,1.0\n")
        assert latest_partition_value(spark, str(tmp_path)) == "2023-10-20"

    def test_single_digit_month_is_read(self, spark, tmp_path):
        put(tmp_path / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        put(tmp_path / "date=2023-9-5", "o.csv", HEADER + "2,1,2.0\n")
        put(tmp_path / "date=2023-09-05", "o.csv", HEADER + "3,1,2.0\n")
        assert latest_partition_value(spark, str(tmp_path)) == "2023-09-05"
        df = read_latest_partition(spark, str(tmp_path), schemas.ORDERS)
        assert sorted(r.orderId for r in df.collect()) == [2, 3]

    def test_rows_schema_and_date(self, spark, tmp_path):
        put(tmp_path / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        put(tmp_path / "date=2023-09-20", "a.csv", HEADER + "2,1,2.5\n")
        put(tmp_path / "date=2023-09-20", "b.csv", HEADER + "3,x,3.5\n")
        df = read_latest_partition(spark, str(tmp_path), schemas.ORDERS)
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.ORDERS]
        day = datetime.date(2023, 9, 20)
        assert sorted(tuple(r) for r in df.collect()) == [(2, 1, 2.5, day), (3, None, 3.5, day)]

    def test_older_folders_are_not_listed(self, spark, tmp_path):
        put(tmp_path / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        put(tmp_path / "date=2023-09-20", "o.csv", HEADER + "2,1,2.5\n")
        files = read_latest_partition(spark, str(tmp_path), schemas.ORDERS).inputFiles()
        assert len(files) == 1 and "date=2023-09-20" in files[0]

    @pytest.mark.parametrize("content", [HEADER, None])
    def test_newest_folder_without_rows_or_files_counts(self, spark, tmp_path, content):
        put(tmp_path / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        (tmp_path / "date=2023-09-20").mkdir()
        if content:
            put(tmp_path / "date=2023-09-20", "o.csv", content)
        assert latest_partition_value(spark, str(tmp_path)) == "2023-09-20"
        assert read_latest_partition(spark, str(tmp_path), schemas.ORDERS).count() == 0

    def test_other_entries_do_not_count(self, spark, tmp_path):
        put(tmp_path / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        put(tmp_path / "day=2024-01-01", "o.csv", HEADER)
        put(tmp_path / "date=__HIVE_DEFAULT_PARTITION__", "o.csv", HEADER)
        put(tmp_path, "date=2024-06-01", "a file, not a folder")
        assert list(partition_folders(spark, str(tmp_path))) == [datetime.date(2023, 1, 1)]

    def test_other_column_name(self, spark, tmp_path):
        put(tmp_path / "day=2023-01-01", "o.csv", "orderId\n1\n")
        df = read_latest_partition(
            spark, str(tmp_path), schemas.T.StructType.fromDDL("orderId INT, day STRING"),
            column="day",
        )
        assert [tuple(r) for r in df.collect()] == [(1, "2023-01-01")]

    @pytest.mark.parametrize("name", ["foo", "2023-13-45", "20230101"])
    def test_folder_that_is_no_date(self, spark, tmp_path, name):
        put(tmp_path / f"date={name}", "o.csv", HEADER)
        with pytest.raises(ValueError, match=f"date={name}"):
            latest_partition_value(spark, str(tmp_path))

    def test_no_partitions(self, spark, tmp_path):
        with pytest.raises(ValueError, match="no partitions by 'date'"):
            latest_partition_value(spark, str(tmp_path))

    def test_missing_root(self, spark, tmp_path):
        with pytest.raises(FileNotFoundError):
            latest_partition_value(spark, str(tmp_path / "nowhere"))

    def test_plain_table_form(self, spark):
        df = spark.sql("SELECT * FROM VALUES (1, DATE'2023-01-01'), (2, DATE'2023-02-01'), "
                       "(3, DATE'2023-02-01'), (4, NULL) AS t(id, day)")  # fmt: skip
        assert sorted(r.id for r in filter_latest(df, "day").collect()) == [2, 3]


class TestNamedTables:
    def test_case_unknown_and_memo(self, spark):
        loads = []
        tables = Tables({"Clients": lambda: loads.append(1) or spark.range(3)})
        assert tables.get("CLIENTS") is tables.get("clients")
        assert loads == [1]
        with pytest.raises(ValueError, match="unknown table 'items'; expected one of: clients"):
            tables.get("items")

    def test_nothing_is_read_before_use(self, spark, tmp_path):
        tables = client_order_tables(spark, str(tmp_path / "none"), str(tmp_path / "none"))
        with pytest.raises(FileNotFoundError):
            tables.get("orders")

    def test_declared_columns(self, spark, tmp_path):
        put(tmp_path / "c", "c.csv", "clientId,name,location\n1,Ada,Lyon\n")
        put(tmp_path / "o" / "date=2023-01-01", "o.csv", HEADER + "1,1,1.0\n")
        tables = client_order_tables(spark, str(tmp_path / "c"), str(tmp_path / "o"))
        assert tables.get("clients").columns == ["clientId", "name", "location"]
        assert tables.get("orders").columns == ["orderId", "clientId", "amount", "date"]


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\n\nthree")
    rows = [r.value for r in read_text_lines(spark, str(tmp_path)).collect()]
    assert rows == ["one", "two", "", "three"]


def test_date_texts_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-03-31 02:30:00.1299'), "
                   "(TIMESTAMP_NTZ'2024-03-31 00:00:00'), (NULL) AS t(ts)")  # fmt: skip
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        rows = df.select(millisecond_text(df.ts), iso_date_text(df.ts)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == [
        ("2024-03-31 02:30:00.129", "2024-03-31"),
        ("2024-03-31 00:00:00.000", "2024-03-31"),
        (None, None),
    ]


class TestBadRows:
    SCHEMA = "clientId INT, name STRING, since DATE"

    def write(self, folder, *lines):
        folder.mkdir(exist_ok=True)
        (folder / f"{len(list(folder.iterdir()))}.csv").write_text("\n".join(["clientId,name,since", *lines]) + "\n")
        return str(folder)

    def schema(self, spark):
        return spark.createDataFrame([], self.SCHEMA).schema

    def test_bad_rows_are_listed_with_their_text_and_stay(self, spark, tmp_path):
        path = self.write(tmp_path / "c", "1,Ash,2020-01-31", "x2,Birch,2020-02-01", "3,,", '4,"a,b",soon', "5,Elm", "6,F,2020-01-01,more")
        bad = bad_csv_rows(spark, path, self.schema(spark))
        assert bad.columns == ["clientId", "name", "since", "bad_row"]
        assert sorted(r["bad_row"] for r in bad.collect()) == ['4,"a,b",soon', "5,Elm", "6,F,2020-01-01,more", "x2,Birch,2020-02-01"]
        rows = {r["name"]: tuple(r)[:3] for r in bad.collect()}
        assert rows["Birch"] == (None, "Birch", datetime.date(2020, 2, 1))
        assert rows["a,b"] == (4, "a,b", None)
        table = read_csv_table(spark, path, self.schema(spark))
        assert table.count() == 6
        assert {tuple(r)[:3] for r in bad.collect()} <= {tuple(r) for r in table.collect()}

    def test_a_bad_value_in_a_column_nobody_asks_for(self, spark, tmp_path):
        path = self.write(tmp_path / "c", "1,Ash,never")
        assert bad_csv_rows(spark, path, self.schema(spark)).select("name", "bad_row").collect() == [("Ash", "1,Ash,never")]
        assert bad_csv_rows(spark, path, self.schema(spark)).count() == 1

    def test_none_and_other_names(self, spark, tmp_path):
        path = self.write(tmp_path / "c", "1,Ash,2020-01-31")
        assert bad_csv_rows(spark, path, self.schema(spark), text="why").columns[-1] == "why"
        assert bad_csv_rows(spark, path, self.schema(spark)).isEmpty()
        with pytest.raises(ValueError, match="choose another name"):
            bad_csv_rows(spark, path, self.schema(spark), text="NAME")

    def test_the_batch_job_lists_them(self, spark, tmp_path):
        clients = self.write(tmp_path / "c", "1,Ash,pier", "two,Birch,pier")
        orders = tmp_path / "orders" / "date=2024-02-01"
        orders.parent.mkdir()
        self.write(orders, "9,1,2.5", "10,1,much")
        for _ in range(2):
            run_client_orders(spark, clients, str(orders.parent), str(tmp_path / "out"), bad_rows_path=str(tmp_path / "bad"))
            got = {n: [r["bad_row"] for r in spark.read.parquet(f"{tmp_path}/bad/{n}").collect()] for n in ("clients", "orders")}
            assert got == {"clients": ["two,Birch,pier"], "orders": ["10,1,much"]}
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3
