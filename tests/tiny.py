"""Hand-sized source tables: rows as dicts, everything else empty or NULL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from florin.operators.report_dates import ReportSpan, listed_span
from florin.sources.catalog import CONTRACTS, Sources, from_frames

TYPES = {
    "string": T.StringType(),
    "measure": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "key": T.LongType(),
}


def schema_of(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, TYPES[k]) for c, k in CONTRACTS[table].items()])


def tiny_sources(spark: SparkSession, **tables: list[dict]) -> Sources:
    frames = {}
    for name in CONTRACTS:
        schema = schema_of(name)
        rows = [tuple(row.get(f.name) for f in schema) for row in tables.get(name, [])]
        frames[name] = spark.createDataFrame(rows, schema)
    return from_frames(spark, frames)


def span_of(spark: SparkSession, *days: date) -> ReportSpan:
    return listed_span(spark, days)


def one(df) -> dict:
    """The only row, decimals as floats."""
    rows = df.collect()
    assert len(rows) == 1, rows
    return plain(rows[0])


def plain(row) -> dict:
    return {k: float(v) if type(v).__name__ == "Decimal" else v for k, v in row.asDict().items()}
