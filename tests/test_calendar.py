from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tollbook.functions import calendar as cal, windows as win
from tollbook.operators import windows as w

# Bounds worked out in plain Python for four as-of dates; 2025-03-20 is the last day of a leap year.
AS_OF = (dt.date(2001, 7, 15), dt.date(2024, 1, 30), dt.date(2024, 3, 31), dt.date(2025, 3, 20))
GOLDEN = """
today       2001-07-15 2001-07-15 2024-01-30 2024-01-30 2024-03-31 2024-03-31 2025-03-20 2025-03-20
yesterday   2001-07-14 2001-07-14 2024-01-29 2024-01-29 2024-03-30 2024-03-30 2025-03-19 2025-03-19
last7days   2001-07-09 2001-07-15 2024-01-24 2024-01-30 2024-03-25 2024-03-31 2025-03-14 2025-03-20
last30days  2001-06-16 2001-07-15 2024-01-01 2024-01-30 2024-03-02 2024-03-31 2025-02-19 2025-03-20
thisweek    2001-07-14 2001-07-20 2024-01-27 2024-02-02 2024-03-30 2024-04-05 2025-03-15 2025-03-21
thismonth   2001-06-22 2001-07-22 2024-01-21 2024-02-19 2024-03-20 2024-04-19 2025-02-19 2025-03-20
lastmonth   2001-05-22 2001-06-21 2023-12-22 2024-01-20 2024-02-20 2024-03-19 2025-02-19 2025-03-20
last2month  2001-05-22 2001-07-22 2023-12-22 2024-02-19 2024-02-20 2024-04-19 2025-02-19 2025-03-20
last3month  2001-04-21 2001-07-22 2023-11-22 2024-02-19 2024-01-21 2024-04-19 2025-01-20 2025-03-20
last6month  2001-01-20 2001-07-22 2023-08-23 2024-02-19 2023-10-23 2024-04-19 2024-09-22 2025-03-20
last9month  2000-10-22 2001-07-22 2023-05-22 2024-02-19 2023-07-23 2024-04-19 2024-06-21 2025-03-20
last12month 2000-07-22 2001-07-22 2023-02-20 2024-02-19 2023-04-21 2024-04-19 2024-04-20 2025-03-20
spring      2001-03-21 2001-06-21 2023-03-21 2023-06-21 2024-03-20 2024-06-20 2024-03-20 2024-06-20
summer      2001-06-22 2001-09-22 2023-06-22 2023-09-22 2024-06-21 2024-09-21 2024-06-21 2024-09-21
fall        2001-09-23 2001-12-21 2023-09-23 2023-12-21 2024-09-22 2024-12-20 2024-09-22 2024-12-20
winter      2001-12-22 2002-03-20 2023-12-22 2024-03-19 2024-12-21 2025-03-20 2024-12-21 2025-03-20
thisyear    2001-03-21 2002-03-20 2023-03-21 2024-03-19 2024-03-20 2025-03-20 2024-03-20 2025-03-20
"""
LEGACY_YEAR = "2001-03-21 2002-03-20 2024-03-21 2025-03-20 2024-03-20 2025-03-19 2025-03-20 2026-03-19"


def _golden():
    bounds = {}
    for line in GOLDEN.split("\n"):
        if line:
            name, *days = line.split()
            days = [dt.date.fromisoformat(d) for d in days]
            for i, as_of in enumerate(AS_OF):
                bounds[as_of, name] = (days[2 * i], days[2 * i + 1])
    return bounds


@pytest.mark.parametrize("as_of", AS_OF)
def test_known_date_bounds(as_of):
    for name in win.WINDOW_NAMES[:-1]:
        assert win.known_range(name, as_of) == _golden()[as_of, name], name


def test_column_bounds_equal_golden(spark):
    days = spark.createDataFrame([(d,) for d in AS_OF], "day date")
    rows = w.bounds_of(days, "day").collect()
    assert {(r.as_of, r.window): (r.lo, r.hi) for r in rows} == _golden()
    for r in rows:
        assert r.days == (r.hi - r.lo).days + 1
        assert r.divisor == (24 if r.window in ("today", "yesterday") else r.days)


def test_bounds_table(spark):
    rows = w.window_bounds(spark, AS_OF[0], selection=(dt.date(2001, 1, 1), dt.date(2001, 1, 10))).collect()
    assert [r.window for r in rows] == list(win.WINDOW_NAMES)
    assert (rows[-1].days, rows[-1].divisor) == (10, 10)


def test_legacy_year():
    days = [dt.date.fromisoformat(d) for d in LEGACY_YEAR.split()]
    for i, as_of in enumerate(AS_OF):
        assert win.known_range("thisyear", as_of, legacy_year=True) == (days[2 * i], days[2 * i + 1])


def test_true_jalali_months():
    # The last day of a leap year: the month before Esfand starts on 1 Bahman.
    lo, hi = win.known_range("lastmonth", dt.date(2025, 3, 20), jalali_months=True)
    assert (lo, hi) == (dt.date(2025, 1, 20), dt.date(2025, 2, 18))


def test_nowruz():
    known = {1375: "1996-03-20", 1379: "2000-03-20", 1380: "2001-03-21", 1399: "2020-03-20", 1403: "2024-03-20",
             1404: "2025-03-21"}
    for year, day in known.items():
        assert cal.jalali_to_date(year, 1, 1) == dt.date.fromisoformat(day)


def test_round_trip_and_both_kinds_of_day(spark):
    lo, hi = dt.date(1950, 1, 1), dt.date(2059, 12, 31)
    days = spark.range((hi - lo).days + 1).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("d"))
    split = days.select("d", cal.jalali_year(F.col("d")).alias("y"), cal.jalali_month(F.col("d")).alias("m"),
                        cal.jalali_day(F.col("d")).alias("j"))
    back = split.withColumn("back", cal.jalali_to_date(F.col("y"), F.col("m"), F.col("j")))
    assert back.where("d <> back").count() == 0
    for r in split.collect()[::97]:
        assert (cal.jalali_year(r.d), cal.jalali_month(r.d), cal.jalali_day(r.d)) == (r.y, r.m, r.j)


def test_leap_flag_is_the_year_length():
    for year in range(1340, 1429):
        length = (cal.jalali_to_date(year + 1, 1, 1) - cal.jalali_to_date(year, 1, 1)).days
        assert cal.jalali_year_length(year) == length


def test_months_back_overflows(spark):
    assert cal.months_back(dt.date(2024, 3, 31), 1) == dt.date(2024, 3, 2)
    assert cal.months_back(dt.date(2023, 3, 31), 1) == dt.date(2023, 3, 3)
    assert cal.months_back(dt.date(2024, 1, 15), 2) == dt.date(2023, 11, 15)
    row = spark.range(1).select(cal.months_back(F.lit(dt.date(2024, 3, 31)), 1).alias("d")).first()
    assert row.d == dt.date(2024, 3, 2)


def test_typed_dates(spark):
    texts = {"1403-01-01": "2024-03-20", "1403-12-30": "2025-03-20", "2024-03-20": "2024-03-20",
             "1380-04-24": "2001-07-15", "1402-11-10": "2024-01-30", "1407-01-01": "2028-03-20", "x": None, "": None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cal.parse_any_date(F.col("t"))).collect()
    assert {t: d and str(d) for t, d in rows} == texts
    assert all(str(cal.parse_known_date(t)) == d for t, d in texts.items() if d)


def test_offsets():
    assert [cal.offset_minutes(o) for o in ("+03:30", "-00:30", 3.5, -0.5, "+00:00", -9.5)] == [210, -30, 210, -30, 0, -570]


def test_span_granularity(spark):
    spans = {1: "1 day", 30: "1 day", 31: "5 day", 63: "5 day", 64: "10 day", 101: "20 day", 364: "20 day", 365: "1 month"}
    rows = spark.createDataFrame([(n,) for n in spans], "n int").select("n", win.span_granularity(F.col("n"))).collect()
    assert dict(map(tuple, rows)) == spans


def test_average_over_no_days(spark):
    row = spark.range(1).select(w.average(F.lit(3.0), F.lit(0)).alias("a")).first()
    assert row.a is None
