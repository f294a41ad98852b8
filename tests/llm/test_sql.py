"""Queries that SQL can express, against a second engine."""

import duckdb
import pytest

from florin.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    wanted = connection.execute(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(c[0] for c in wanted.description)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    place = {c[0]: i for i, c in enumerate(wanted.description)}
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r[place[c]] for c in columns)) for r in wanted.fetchall())
