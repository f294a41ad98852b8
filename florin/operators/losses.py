"""Rows that a report reads but cannot count: unmatched and malformed ones, per source.

The counts are facts like any other and ride in the report's one aggregate, so they cost
no further job, belong to a report date, and stay exact when a lost executor's tasks run
again. A source's ``read`` rows are those of the dates that the report date reads (a date
read by two cuts counts in both); ``unmatched`` ones lack the row of a master or of the
other side that would give them a meaning, ``malformed`` ones lack a value that the
source must have, or have one that cannot be parsed. Behind a join that repeats rows, the
repeated rows count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.functions.amounts import FACT
from florin.operators.facts import entry, tagged

READ, UNMATCHED, MALFORMED = "read", "unmatched", "malformed"
KINDS = [READ, UNMATCHED, MALFORMED]
# What makes a row of the source unmatched and malformed, for the report's readers.
MEANINGS = {
    "bank_balances": ("no account group", "no final balance"),
    "money_market": ("no control date of the operation", "no turnover"),
    "cc_movements": ("no concept name", "no value"),
    "multicash": ("no active own account", "no amount or currency"),
    "transactions": ("no channel or account", "no amount or time"),
    "balance": ("no accepted product", "no balance"),
    "adapter": ("a late refund sent out without its counterpart", "a refund's cycle or amount cannot be read"),
    "renewals": ("", "no amount"),
    "derivatives": ("", "no amount"),
}


def name(kind: str, source: str) -> str:
    return f"{kind}_{source}"


METRICS = [name(kind, source) for source in MEANINGS for kind in KINDS]


def counted(source: str, malformed: Column, n: Column | None = None) -> list[Column]:
    """Facts that count a row as read and, where it is, as malformed."""
    one = F.lit(1) if n is None else n
    return [entry(name(READ, source), one), entry(F.when(malformed, name(MALFORMED, source)), one)]


def unmatched(source: str, applies: Column, n: Column | None = None) -> Column:
    return entry(F.when(applies, name(UNMATCHED, source)), F.lit(1) if n is None else n)


def through_join(joined: DataFrame, source: str, n: Column, keep: tuple[str, ...] = ("report_date",)) -> DataFrame:
    """Facts behind a left join that repeats every fact ``n`` times: NULL where nothing matched.

    Counts of rows are not repeated; the read rows without a match count as unmatched.
    """
    metric, value = F.col("metric"), F.col("amount")
    is_count = metric.isin(name(READ, source), name(MALFORMED, source))
    whole = F.when(is_count, value).otherwise((value * n).cast(FACT))
    lost = n.isNull() & (metric == name(READ, source))
    entries = [entry(F.when(is_count | n.isNotNull(), metric), whole), entry(F.when(lost, name(UNMATCHED, source)), value)]
    return tagged(joined, entries, keep)


def uncounted_rows(metrics: DataFrame) -> DataFrame:
    """report_date, source, rows_read, unmatched, malformed over metrics that have the counts."""
    rows = ", ".join(
        f"STRUCT('{source}' AS source, " + ", ".join(f"CAST({name(k, source)} AS BIGINT) AS {column}" for k, column in COLUMNS.items()) + ")"
        for source in MEANINGS
    )
    return metrics.selectExpr("report_date", f"INLINE(ARRAY({rows}))")


COLUMNS = {READ: "rows_read", UNMATCHED: "unmatched", MALFORMED: "malformed"}
