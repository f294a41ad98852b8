"""Report transposition: one row per section and metric, one column per report date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin import params

# Rows unpivoted per section: (section, {column: SQL}).
Section = tuple[str, dict[str, str]]


def unpivoted(stated: DataFrame, sections: Sequence[Section], day: str = "report_date") -> DataFrame:
    """(day, section_no, line_no, section, metric, format, value), all sections in one pass."""
    rows = [
        f"STRUCT({s} AS section_no, {m} AS line_no, '{section}' AS section, '{name.strip('`')}' AS metric, "
        f"'{_format(name)}' AS format, {sql} AS value)"
        for s, (section, columns) in enumerate(sections, 1)
        for m, (name, sql) in enumerate(columns.items(), 1)
    ]
    return stated.selectExpr(day, f"INLINE(ARRAY({', '.join(rows)}))")


def transposed(stated: DataFrame, sections: Sequence[Section], days: Sequence[date], day: str = "report_date") -> DataFrame:
    """Sections in order, their lines in order, one column per listed date."""
    long = unpivoted(stated, sections, day).withColumn("day", F.date_format(day, "yyyy-MM-dd"))
    return (
        long.groupBy("section_no", "line_no", "section", "metric", "format")
        .pivot("day", [d.isoformat() for d in days])
        .agg(F.first("value"))
    )


def _format(name: str) -> str:
    return "percentage" if name == params.PERCENTAGE_COLUMN else "currency"
