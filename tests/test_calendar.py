from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from florin.functions import calendar
from florin.operators.report_dates import business_day_span, listed_span, window_span


def days_df(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "day date")


def calendar_of(spark, day):
    return calendar.with_calendar(days_df(spark, day), "day").first()


# --- an independent, day-by-day calendar --------------------------------------------


def easter(year):
    """Spencer Jones' table-free computus, on Python integers."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = divmod(b, 4)
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = divmod(c, 4)
    m = (a + 11 * h) // 319
    r = (2 * e + 2 * i - k - h + m + 32) % 7
    n = (h - m + r + 90) // 25
    p = (h - m + r + n + 19) % 32
    return date(year, n, p)


def holidays(year):
    def monday(d):
        return d + timedelta(days=-d.weekday() % 7)

    fixed = [date(year, m, d) for m, d in [(1, 1), (5, 1), (7, 20), (8, 7), (12, 8), (12, 25)]]
    moved = [
        monday(date(year, m, d)) for m, d in [(1, 6), (3, 19), (6, 29), (8, 15), (10, 12), (11, 1), (11, 11)]
    ]
    e = easter(year)
    return {*fixed, *moved, *[e + timedelta(days=n) for n in (-3, -2, 43, 64, 71)]}


def is_open(day, cache={}):
    return day.weekday() < 5 and day not in cache.setdefault(day.year, holidays(day.year))


def walk(day, step, test=is_open):
    day += timedelta(days=step)
    while not test(day):
        day += timedelta(days=step)
    return day


@pytest.mark.parametrize(
    "day, expected",
    [(date(2026, 1, 9), True), (date(2026, 1, 10), False), (date(2026, 1, 11), False), (date(2026, 1, 1), False)],
)
def test_business_day(spark, day, expected):
    assert calendar_of(spark, day).is_bd is expected


def test_year_end_settles_nothing(spark):
    row = calendar_of(spark, date(2025, 12, 31))
    assert row.is_bd and not row.is_bd_settle


@pytest.mark.parametrize(
    "day, expected", [(date(2026, 1, 9), True), (date(2026, 1, 8), False), (date(2026, 1, 31), True)]
)
def test_friday_or_month_end(spark, day, expected):
    assert calendar_of(spark, day).is_fri_or_eom is expected


def test_previous_business_day(spark):
    assert calendar_of(spark, date(2026, 1, 9)).prev_bd == date(2026, 1, 8)
    assert calendar_of(spark, date(2026, 1, 8)).prev_bd == date(2026, 1, 7)


def test_easter(spark):
    rows = spark.range(1900, 2150).select("id", calendar.easter_sunday(F.col("id").cast("int")).alias("e")).collect()
    assert [(r.id, r.e) for r in rows] == [(y, easter(y)) for y in range(1900, 2150)]


def test_neighbours_match_a_day_by_day_walk(spark):
    days = spark.sql("SELECT explode(sequence(DATE '1999-12-01', DATE '2036-02-01')) AS day")
    rows = calendar.with_calendar(days, "day").collect()
    assert len(rows) > 13000
    for row in rows:
        assert row.is_bd == is_open(row.day), row
        assert row.prev_bd == walk(row.day, -1), row
        assert row.next_bd == walk(row.day, 1), row


def test_intervals_match_a_day_by_day_walk(spark):
    def settles(day):
        return is_open(day) and (day.month, day.day) != (12, 31)

    days = spark.sql("SELECT explode(sequence(DATE '2019-12-01', DATE '2027-02-01')) AS day")
    for row in calendar.with_report_dates(days, "day").collect():
        first = last = row.day
        if settles(row.day):
            first = walk(row.day, -1, settles) + timedelta(days=1)
            last = walk(row.day, 1, settles) - timedelta(days=1)
        assert (row.unity_from, row.unity_to) == (first, row.day), row
        assert (row.tx_from, row.tx_to) == (row.day, last), row


@pytest.mark.parametrize(
    "start, fallback, expected",
    [
        (date(2026, 1, 9), date(2026, 1, 8), date(2026, 1, 8)),
        (date(2026, 3, 15), date(2026, 3, 14), date(2026, 3, 14)),
        (date(2025, 12, 31), date(2025, 12, 30), date(2026, 1, 1)),
        (date(2026, 1, 2), date(2025, 12, 31), date(2026, 1, 1)),
    ],
)
def test_bank_date(spark, start, fallback, expected):
    row = spark.range(1).select(calendar.bank_date(F.lit(start), F.lit(fallback)).alias("d")).first()
    assert row.d == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-01-09T05:00:00.000Z", date(2026, 1, 9)),
        ("2026-01-09T23:59:59-05:00", date(2026, 1, 9)),
        ("2026-01-09", date(2026, 1, 9)),
        ("DATE 2026-01-09", date(2026, 1, 9)),
        ("date 2026-01-09 ", date(2026, 1, 9)),
        ("2026-13-41", None),
        ("", None),
    ],
)
def test_parse_report_date(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(calendar.parse_report_date(F.col("t")).alias("d")).first()
    assert row.d == expected


def window(spark, day, **kwargs):
    return sorted(r[0] for r in window_span(spark, day, **kwargs).listed.collect())


def test_window_sizes(spark):
    assert len(window(spark, date(2026, 1, 9))) == 5
    short = window(spark, date(2026, 1, 9), count=2)
    assert len(short) == 3 and short[-1] == date(2026, 1, 9)


def test_window_keeps_a_report_date_that_is_not_a_business_day(spark):
    assert window(spark, date(2026, 1, 10), count=1) == [date(2026, 1, 9), date(2026, 1, 10)]


def test_long_window_reaches_back_far_enough(spark):
    day, expected = date(2025, 4, 25), []
    for _ in range(250):
        day = walk(day, -1)
        expected.insert(0, day)
    assert window(spark, date(2025, 4, 25), count=250) == [*expected, date(2025, 4, 25)]


def test_runout_interval_of_a_weekend_date(spark):
    row = listed_span(spark, [date(2026, 1, 10)]).dates.first()
    assert row.tx_from == row.tx_to == date(2026, 1, 10)


def test_backfill_days(spark):
    days = business_day_span(spark, date(2024, 1, 1), date(2024, 1, 31)).listed
    assert days.count() == 21


def test_source_dates_stay_within_the_literal_bounds(spark):
    span = business_day_span(spark, date(2024, 12, 1), date(2026, 4, 30))
    low, high = span.source_bounds
    row = span.bridge.agg(F.min("source_date"), F.max("source_date"), F.count("*")).first()
    assert low <= row[0] and row[1] <= high and row[2] <= span.max_bridge_rows


def test_very_long_spans_are_neither_held_nor_broadcast(spark):
    span = business_day_span(spark, date(1900, 1, 1), date(1990, 1, 1))
    plan = span.bridge_for(["report"])._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan and "LocalRelation" not in plan
