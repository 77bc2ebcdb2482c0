"""Run a query's SQL in DuckDB and compare row by row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def normal(rows, names) -> list[tuple]:
    """Rows with columns in name order, themselves sorted; floats to 6 places."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v

    out = [tuple(value(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
