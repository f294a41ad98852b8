"""Colombian business-calendar arithmetic as row-local column expressions.

Everything is computed from the date itself (no window, no join, no driver
loop): the holidays of the surrounding years are an array, the open days near a
date are that array subtracted from a day sequence, and previous/next business
days are the nearest entries. A plan therefore costs the same per row for one
report date or for twenty years of them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin import params

# Fixed values: (month, day) holidays, holidays moved to the following Monday,
# and offsets from Easter Sunday.
FIXED_HOLIDAYS = [(1, 1), (5, 1), (7, 20), (8, 7), (12, 8), (12, 25)]
MONDAY_HOLIDAYS = [(1, 6), (3, 19), (6, 29), (8, 15), (10, 12), (11, 1), (11, 11)]
EASTER_OFFSETS = [-3, -2, 43, 64, 71]

# Every calendar week has at least two business days (Holy Week, when St
# Joseph's Monday falls into it, has exactly two), so 15 days either side of a
# date always contain the neighbouring business days.
NEIGHBOUR_DAYS = 15


def _div(value: Column, by: int) -> Column:
    return ((value - value % by) / by).cast("int")


def easter_sunday(year: Column) -> Column:
    """Western Easter (anonymous Gregorian computus)."""
    golden = year % 19
    century = _div(year, 100)
    in_century = year % 100
    skipped = _div(century - _div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - _div(century, 4) - skipped + 15) % 30
    weekday = ((century % 4) * 2 + _div(in_century, 4) * 2 + 32 - epact - in_century % 4) % 7
    late = _div(golden + epact * 11 + weekday * 22, 451)
    # Days after 22 March.
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), (epact + weekday - late * 7).cast("int"))


def holidays_between(first: Column, last: Column) -> Column:
    """Array of the holidays in every calendar year touched by [first, last]."""

    def of_year(easter: Column) -> Column:
        year = F.year(easter)
        fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
        moved = [
            F.next_day(F.date_sub(F.make_date(year, F.lit(m), F.lit(d)), 1), "MON") for m, d in MONDAY_HOLIDAYS
        ]
        movable = [F.date_add(easter, n) for n in EASTER_OFFSETS]
        return F.array(*fixed, *moved, *movable)

    easters = F.transform(F.sequence(F.year(first), F.year(last)), easter_sunday)
    return F.flatten(F.transform(easters, of_year))


def _weekdays(days: Column) -> Column:
    return F.filter(days, lambda d: F.weekday(d) < 5)


def open_days(first: Column, last: Column) -> Column:
    """Ascending array of the business days in [first, last]."""
    return _weekdays(F.array_except(F.sequence(first, last), holidays_between(first, last)))


def _not_year_end(days: Column) -> Column:
    return F.filter(days, lambda d: ~((F.month(d) == 12) & (F.dayofmonth(d) == 31)))


def before(days: Column, day: Column) -> Column:
    return F.array_max(F.filter(days, lambda d: d < day))


def after(days: Column, day: Column) -> Column:
    return F.array_min(F.filter(days, lambda d: d > day))


def is_friday_or_month_end(day: Column) -> Column:
    return (F.weekday(day) == 4) | (day == F.last_day(day))


def bank_date(start: Column, fallback: Column, cutover: date = params.BANK_CUTOVER) -> Column:
    """Balance date used for a cut, with the year-end shifts."""
    base = F.when(start < F.lit(cutover), F.date_sub(start, 1)).otherwise(fallback)
    shifted = F.when(_is_year_end(start), F.date_add(base, 2)).otherwise(base)
    return F.when(_is_year_end(shifted), F.date_add(shifted, 1)).otherwise(shifted)


def _is_year_end(day: Column) -> Column:
    return (F.month(day) == 12) & (F.dayofmonth(day) == 31)


def parse_report_date(text: Column) -> Column:
    """Date of an ISO date, ISO timestamp (with or without ``Z``) or ``DATE yyyy-mm-dd`` text."""
    return F.regexp_extract(text, r"^\s*(?:(?i:DATE)\s+)?(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def with_calendar(df: DataFrame, day: str) -> DataFrame:
    """Add is_bd, is_bd_settle, prev_bd, next_bd and is_fri_or_eom for a date column."""
    d = F.col(day)
    near = _with_open_days(df, day)
    return near.select(
        *df.columns,
        F.array_contains("_open", d).alias("is_bd"),
        F.array_contains("_settle", d).alias("is_bd_settle"),
        before(F.col("_open"), d).alias("prev_bd"),
        after(F.col("_open"), d).alias("next_bd"),
        is_friday_or_month_end(d).alias("is_fri_or_eom"),
    )


def with_report_dates(df: DataFrame, day: str, cutover: date = params.BANK_CUTOVER) -> DataFrame:
    """Add every date offset a report date needs: neighbours, bank dates, source intervals."""
    d = F.col(day)
    settles = F.array_contains("_settle", d)
    near = (
        _with_open_days(df, day)
        .withColumn("prev_bd", before(F.col("_open"), d))
        .withColumn("next_bd", after(F.col("_open"), d))
    )
    return near.select(
        *df.columns,
        "prev_bd",
        "next_bd",
        bank_date(d, F.col("prev_bd"), cutover).alias("bank_t0"),
        bank_date(F.col("next_bd"), d, cutover).alias("bank_t1"),
        F.when(settles, F.date_add(before(F.col("_settle"), d), 1)).otherwise(d).alias("unity_from"),
        d.alias("unity_to"),
        d.alias("tx_from"),
        F.when(settles, F.date_sub(after(F.col("_settle"), d), 1)).otherwise(d).alias("tx_to"),
    )


def _with_open_days(df: DataFrame, day: str) -> DataFrame:
    d = F.col(day)
    return df.withColumn("_open", open_days(F.date_sub(d, NEIGHBOUR_DAYS), F.date_add(d, NEIGHBOUR_DAYS))).withColumn(
        "_settle", _not_year_end(F.col("_open"))
    )


def window_lookback(count: int) -> int:
    """Days that always hold at least ``count`` business days (two per week)."""
    return 7 * ((count + 1) // 2 + 1)


def business_window(day: Column, count: int = 4) -> Column:
    """The last ``count`` business days before ``day`` in order, then ``day`` itself."""
    earlier = open_days(F.date_sub(day, window_lookback(count)), F.date_sub(day, 1))
    kept = F.slice(earlier, F.size(earlier) - count + 1, F.lit(count))
    return F.concat(kept, F.array(day))
