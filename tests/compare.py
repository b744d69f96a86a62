"""Side-by-side comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def table_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_table(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), table_of(df.columns, df.collect())


def duck_table(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), table_of(columns, result.fetchall())
