"""Report dates and the bridge from report dates to source dates.

A source row may serve several report dates (overlapping intervals, today and
yesterday), so the bridge is always a join and never a column of the source.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from florin.functions import calendar
from florin.settings import DEFAULT, Settings

# Cuts of the bridge: which source dates a report date reads.
REPORT = "report"  # the report date itself
PREVIOUS = "previous"  # the business day before
BANK_T0 = "bank_t0"
BANK_T1 = "bank_t1"
MOVEMENTS = "movements"  # catch-up interval of account movements
STATEMENTS = "statements"  # run-out interval of bank statements
AGREED = "agreed"  # the business days before it on which an operation may have been agreed, and itself
AGREED_DAYS = 4
CUTS = [REPORT, PREVIOUS, BANK_T0, BANK_T1, MOVEMENTS, STATEMENTS, AGREED]

# Source dates never lie further from their report date than this.
REACH = timedelta(days=calendar.NEIGHBOUR_DAYS)
AGREED_REACH = timedelta(days=calendar.window_lookback(AGREED_DAYS))  # that of the agreed days
MAX_ROWS_PER_DATE = 5 + AGREED_DAYS + 2 * calendar.NEIGHBOUR_DAYS

# A bridge row is two dates and a short tag. 500 000 of them (40 years of report
# dates) stay around 20 MB; a longer backfill is computed and joined by shuffle.
MAX_HELD_ROWS = 500_000

# Beyond this many dates their range is named, too: file readers push no long list down.
MAX_PUSHED_DATES = 200


@dataclass(frozen=True)
class ReportSpan:
    """The report dates of one run, with the bounds known when the plan is built and the settings they are reported under."""

    anchors: DataFrame  # one column, report_date, distinct
    first: date
    last: date
    at_most: int | None = None  # report dates; as many as days from first to last where unknown
    settings: Settings = DEFAULT

    def under(self, settings: Settings) -> ReportSpan:
        """The same report dates under other settings."""
        return replace(self, settings=settings)

    @property
    def source_bounds(self) -> tuple[date, date]:
        return self.first - REACH, self.last + REACH

    @property
    def max_bridge_rows(self) -> int:
        days = (self.last - self.first).days + 1
        return min(days, days if self.at_most is None else self.at_most) * MAX_ROWS_PER_DATE

    @property
    def is_held(self) -> bool:
        """Whether the bridge is computed once and held as a local table: its size is
        bounded by the run's arguments alone. Beyond the bound it stays a lazy plan."""
        return self.max_bridge_rows <= MAX_HELD_ROWS

    @cached_property
    def dates(self) -> DataFrame:
        """One row per report date with every offset as a column."""
        return calendar.with_report_dates(self.anchors, "report_date", self.settings.bank_cutover)

    @cached_property
    def listed(self) -> DataFrame:
        """The report dates alone."""
        return self.bridge.where(F.col("cut") == REPORT).select("report_date")

    @cached_property
    def bridge(self) -> DataFrame:
        """(report_date, cut, source_date), one row per source date a report date reads."""
        if self.is_held:
            return self.anchors.sparkSession.createDataFrame(self._held_bridge)
        return self._computed_bridge()

    @cached_property
    def _held_bridge(self) -> pa.Table:
        return self._computed_bridge().toArrow()

    def _computed_bridge(self) -> DataFrame:
        def rows(cut: str, days: Column) -> Column:
            return F.transform(days, lambda d: F.struct(F.lit(cut).alias("cut"), d.alias("source_date")))

        entries = F.concat(
            rows(REPORT, F.array("report_date")),
            rows(PREVIOUS, F.array("prev_bd")),
            rows(BANK_T0, F.array("bank_t0")),
            rows(BANK_T1, F.array("bank_t1")),
            rows(MOVEMENTS, F.sequence("unity_from", "unity_to")),
            rows(STATEMENTS, F.sequence("tx_from", "tx_to")),
            rows(AGREED, calendar.business_window(F.col("report_date"), AGREED_DAYS)),
        )
        return self.dates.select("report_date", F.inline(entries))

    def bridge_for(self, cuts: Iterable[str]) -> DataFrame:
        part = self.bridge.where(F.col("cut").isin(list(cuts)))
        return F.broadcast(part) if self.is_held else part

    def reads(self, day: str, cuts: Iterable[str]) -> Column:
        """Literal predicate on a source date, for the scan: the exact dates of the cuts, or
        the reachable range when they are not held."""
        column = F.col(day)
        named = set(cuts)
        if not self.is_held:
            first, last = self.source_bounds
            if AGREED in named:
                first = self.first - AGREED_REACH
            return column.between(F.lit(first), F.lit(last))
        rows = zip(self._held_bridge["cut"].to_pylist(), self._held_bridge["source_date"].to_pylist(), strict=True)
        found = sorted({source_date for cut, source_date in rows if cut in named})
        if not found:
            return F.lit(False)
        # As text: one call, whatever the number of dates.
        listed = F.expr(f"`{day}` IN ({', '.join(f"DATE '{d}'" for d in found)})")
        if len(found) <= MAX_PUSHED_DATES:
            return listed
        # Row groups are skipped by range only.
        return column.between(F.lit(found[0]), F.lit(found[-1])) & listed


def window_span(spark: SparkSession, report_date: date, count: int = 4) -> ReportSpan:
    """The report date and the ``count`` business days before it."""
    anchors = _one_row(spark).select(
        F.explode(calendar.business_window(F.lit(report_date), count)).alias("report_date")
    )
    return ReportSpan(anchors, report_date - timedelta(days=calendar.window_lookback(count)), report_date, count + 1)


def business_day_span(spark: SparkSession, first: date, last: date) -> ReportSpan:
    """Every business day in [first, last], for a backfill."""
    anchors = _one_row(spark).select(
        F.explode(calendar.open_days(F.lit(first), F.lit(last))).alias("report_date")
    )
    return ReportSpan(anchors, first, last)


def listed_span(spark: SparkSession, days: Iterable[date]) -> ReportSpan:
    """An explicit list of report dates."""
    listed = sorted(set(days))
    anchors = _one_row(spark).select(F.explode(F.array(*[F.lit(d) for d in listed])).alias("report_date"))
    return ReportSpan(anchors, listed[0], listed[-1], len(listed))


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def on_dates(source: DataFrame, day: str, span: ReportSpan, cuts: Iterable[str]) -> DataFrame:
    """Source rows per report date and cut that reads them.

    The literal dates reach the file scan (partitions, row groups); the join then
    gives every row its report dates.
    """
    bridge = span.bridge_for(cuts)
    return _read(source, day, span, cuts).join(bridge, F.col(day) == bridge["source_date"]).drop("source_date")


def read_dates(source: DataFrame, day: str, span: ReportSpan, cuts: Iterable[str]) -> DataFrame:
    """Source rows that some report date reads, each once and without the report date."""
    if not span.is_held:
        return _read(source, day, span, cuts)
    bridge = span.bridge_for(cuts)
    return source.where(span.reads(day, cuts)).join(bridge, F.col(day) == bridge["source_date"], "left_semi")


def _read(source: DataFrame, day: str, span: ReportSpan, cuts: Iterable[str]) -> DataFrame:
    """Source rows of the dates that the cuts read.

    Where the bridge is not held, its distinct dates are broadcast instead, a row per day of
    the span and its surroundings at most: they prune the partitions of the range when the
    query runs, so that only those of the asked dates are read.
    """
    rows = source.where(span.reads(day, cuts))
    if span.is_held:
        return rows
    asked = span.bridge.where(F.col("cut").isin(list(cuts))).select(F.col("source_date").alias("_asked")).distinct()
    return rows.join(F.broadcast(asked), F.col(day) == F.col("_asked"), "left_semi")
