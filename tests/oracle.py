"""Compare a Spark result with its SQL statement in DuckDB."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    """Rows as exact text, columns by name: 1.0 and -0.0 differ from 1 and 0.0."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    actual = [tuple(row) for row in df.collect()]
    assert _sorted_rows(df.columns, actual) == _sorted_rows(names, expected)
    return len(actual)
