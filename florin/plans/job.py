"""The batch job: report, four keyed upserts, one transposed report file."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from florin import params
from florin.operators import losses, refunds
from florin.operators.merge import upsert
from florin.operators.report_dates import ReportSpan, window_span
from florin.operators.transpose import Section, transposed, unpivoted
from florin.plans import daily
from florin.session import cut_lineage
from florin.settings import DEFAULT, Settings



def sections(stated: DataFrame) -> list[Section]:
    """Sections of the transposed report, with the lines that ``stated`` has."""
    return [
        (params.SECTION_INCOME, daily.income_table(stated)),
        (params.SECTION_EXPENSE, daily.expense_table(stated)),
        (params.SECTION_T0, daily.available_table("t0")),
        (params.SECTION_T1, daily.available_table("t1")),
        (params.SECTION_SUMMARY, daily.SUMMARY_TABLE),
    ]


@dataclass(frozen=True)
class Targets:
    """Where the outputs go: folders, or names of catalog tables (``report`` is a folder)."""

    income: str
    expense: str
    available: str
    summary: str
    report: str | None = None  # one CSV with a column per report date, for its readers
    long_report: str | None = None  # its lines by report date, for spans of any length
    losses: str | None = None  # rows read, unmatched and malformed per report date and source


def parse_report_date(text: str) -> date:
    """The date of an ISO date or timestamp, with or without ``Z`` or a leading ``DATE``."""
    clock = r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?"
    found = re.fullmatch(rf"\s*(?:DATE\s+)?'?(\d{{4}}-\d{{2}}-\d{{2}}){clock}Z?'?\s*", text, re.IGNORECASE)
    if not found:
        raise ValueError(f"not a report date: {text!r}")
    return date.fromisoformat(found[1])


def requested_span(
    spark: SparkSession, src: Mapping[str, DataFrame], text: str | None = None, settings: Settings = DEFAULT
) -> ReportSpan:
    """The window of a report date given as text, or of the latest adapter date when none is given."""
    if text:
        return window_span(spark, parse_report_date(text)).under(settings)
    latest = refunds.latest_date(src).first()["latest"]
    if latest is None:
        raise ValueError("no report date given and the adapter source is empty")
    return window_span(spark, latest).under(settings)


def report_days(span: ReportSpan) -> list[date]:
    """The report dates in order: column heads of the transposed report."""
    return sorted(row[0] for row in span.listed.collect())


def transposed_report(span: ReportSpan, stated: DataFrame) -> DataFrame:
    return transposed(stated, sections(stated), report_days(span))


def run_report(
    span: ReportSpan, src: Mapping[str, DataFrame], targets: Targets, as_of: date | None = None
) -> DataFrame:
    """Compute the report once, upsert its tables, write the transposed report; returns the statements.

    ``losses.uncounted_rows`` over what is returned says, per report date and source, how many
    rows were read, unmatched and malformed; it reads the stored statements and no source again.
    A line that the settings no longer have keeps what a target's row had of it, as in any
    merge: statements with other lines belong into targets of their own.
    """
    stated = cut_lineage(daily.report(span, src, as_of, count_rows=True))
    tables = [
        (daily.income_statement(stated), targets.income, params.MERGE_KEYS),
        (daily.expense_statement(stated), targets.expense, params.MERGE_KEYS),
        (daily.available_union(stated), targets.available, params.MERGE_KEYS_AVAILABLE),
        (daily.cash_summary(stated), targets.summary, params.MERGE_KEYS),
    ]
    for table, target, keys in tables:
        upsert(daily.stamped(table), target, keys, params.PARTITION_KEYS)
    if targets.losses:
        lost = losses.uncounted_rows(stated).withColumnRenamed("report_date", "fecha_reporte")
        upsert(daily.stamped(lost), targets.losses, [*params.MERGE_KEYS, "source"], params.PARTITION_KEYS)
    if targets.report:
        # One row per line of the report, whatever the size of the sources.
        ordered = transposed_report(span, stated).orderBy("section_no", "line_no")
        ordered.coalesce(1).write.mode("overwrite").option("header", "true").csv(targets.report)
    if targets.long_report:
        lines = unpivoted(stated, sections(stated)).hint("rebalance", "report_date")
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date").parquet(
            targets.long_report
        )
    return stated


def run_for(
    spark: SparkSession,
    src: Mapping[str, DataFrame],
    targets: Targets,
    text: str | None = None,
    as_of: date | None = None,
    settings: Settings = DEFAULT,
) -> DataFrame:
    """The whole job from a report date given as text, or from the latest adapter date."""
    return run_report(requested_span(spark, src, text, settings), src, targets, as_of)
