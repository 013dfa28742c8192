"""The eighteen calendar windows of a report, as columns of an as-of date.

Given a known date the bounds are literals, so window filters reach the file scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.functions import calendar as cal
from tollbook.functions.calendar import Day

# The window names of the report tabs.
WINDOW_NAMES = (
    "today", "yesterday", "last7days", "last30days", "thisweek", "thismonth", "lastmonth",
    "last2month", "last3month", "last6month", "last9month", "last12month",
    "spring", "summer", "fall", "winter", "thisyear", "selection",
)

# Gregorian months to step back before snapping to the Jalali month.
MONTHS_BACK = {"last2month": 1, "last3month": 2, "last6month": 5, "last9month": 8, "last12month": 11}

# Windows of the last days, the as-of date included.
LAST_DAYS = {"last7days": 7, "last30days": 30}

# First and last day of a season, counted from the first day of the year.
SEASON_DAYS = {"spring": (0, 92), "summer": (93, 185), "fall": (186, 275)}

# An hourly view is averaged over the hours of a day.
HOURLY = {"today": 24, "yesterday": 24}


@dataclass(frozen=True)
class Anchors:
    """The days that the windows of an as-of date hang on.

    `months` holds the first and last day of the Jalali month reached by stepping back some months.
    """

    as_of: Day
    jalali_year: tuple[Day, Day]
    year: tuple[Day, Day]
    months: dict[int, tuple[Day, Day]]


STEPS = (0, 1, 2, 5, 8, 11)


def anchors(as_of: dt.date, legacy_year: bool = False, jalali_months: bool = False) -> Anchors:
    """The anchors of a known date.

    `legacy_year` bounds the year by the Gregorian year of the date and its leap flag instead of the
    Jalali year. `jalali_months` steps back on the Jalali calendar instead of the Gregorian one.
    """
    jalali_year = (cal.year_start(as_of), cal.year_end(as_of))
    year = _gregorian_year(as_of) if legacy_year else jalali_year
    months = {}
    for n in STEPS:
        inside = _jalali_month_back(as_of, n) if jalali_months else cal.months_back(as_of, n)
        months[n] = (cal.month_start(inside), cal.month_end(inside))
    return Anchors(as_of, jalali_year, year, months)


def _jalali_month_back(as_of: dt.date, months: int) -> dt.date:
    year, month = divmod(cal.jalali_year(as_of) * 12 + cal.jalali_month(as_of) - 1 - months, 12)
    return cal.jalali_to_date(year, month + 1, 1)


def _gregorian_year(as_of: dt.date) -> tuple[dt.date, dt.date]:
    early = int(cal.is_jalali_leap(cal.jalali_year(as_of)))
    return dt.date(as_of.year, 3, 21 - early), dt.date(as_of.year + 1, 3, 20 - early)


def with_anchors(days: DataFrame, day: str) -> tuple[DataFrame, Anchors]:
    """The anchors of a column of dates, as columns `_...`.

    They are added in steps, so that each step reads the one before instead of repeating its terms.
    """
    days = days.withColumns({f"_in{n}": cal.months_back(F.col(day), n) for n in STEPS})
    days = days.withColumns({f"_{part}{n}": value for n in STEPS for part, value in {
        "jy": cal.jalali_year(F.col(f"_in{n}")), "yd": cal.jalali_yday(F.col(f"_in{n}"))}.items()})
    days = days.withColumns({f"_{part}{n}": value for n in STEPS for part, value in {
        "jm": cal.month_of(F.col(f"_yd{n}")), "jd": cal.day_of(F.col(f"_yd{n}"))}.items()})
    months = {}
    for n in STEPS:
        length = cal.jalali_month_length(F.col(f"_jy{n}"), F.col(f"_jm{n}"))
        inside, jd = F.col(f"_in{n}"), F.col(f"_jd{n}")
        months[n] = (cal.shift(inside, 1 - jd), cal.shift(inside, length - jd))
    yday = F.col("_yd0")
    year = (cal.shift(F.col(day), -yday), cal.shift(F.col(day), cal.jalali_year_length(F.col("_jy0")) - 1 - yday))
    ranges = {"_year": year, **{f"_month{n}": m for n, m in months.items()}}
    days = days.withColumns({f"{name}_{end}": d for name, pair in ranges.items() for end, d in zip(("lo", "hi"), pair)})
    column_pair = lambda name: (F.col(f"{name}_lo"), F.col(f"{name}_hi"))
    year_columns = column_pair("_year")
    return days, Anchors(F.col(day), year_columns, year_columns, {n: column_pair(f"_month{n}") for n in STEPS})


def window_range(name: str, a: Anchors, selection: tuple[Day, Day] | None = None) -> tuple[Day, Day]:
    """First and last day of one window."""
    if name == "today":
        return a.as_of, a.as_of
    if name == "yesterday":
        return cal.shift(a.as_of, -1), cal.shift(a.as_of, -1)
    if name in LAST_DAYS:
        return cal.shift(a.as_of, 1 - LAST_DAYS[name]), a.as_of
    if name == "thisweek":
        saturday = cal.shift(a.as_of, -cal.sat_weekday(a.as_of))
        return saturday, cal.shift(saturday, 6)
    if name == "thismonth":
        return a.months[0]
    if name == "lastmonth":
        return a.months[1]
    if name in MONTHS_BACK:
        return a.months[MONTHS_BACK[name]][0], a.months[0][1]
    if name in SEASON_DAYS:
        first, last = SEASON_DAYS[name]
        return cal.shift(a.jalali_year[0], first), cal.shift(a.jalali_year[0], last)
    if name == "winter":
        return cal.shift(a.jalali_year[0], SEASON_DAYS["fall"][1] + 1), a.jalali_year[1]
    if name == "thisyear":
        return a.year
    if name == "selection":
        if selection is None:
            raise ValueError("the selection window needs its two dates")
        return selection
    raise ValueError(f"unknown window {name!r}")


def names_for(selection: object = None) -> tuple[str, ...]:
    """All windows; `selection` only counts when its dates are known."""
    return WINDOW_NAMES if selection is not None else WINDOW_NAMES[:-1]


def day_count(lo: dt.date, hi: dt.date) -> int:
    return abs((hi - lo).days) + 1


def divisor(name: str, lo: dt.date, hi: dt.date) -> int:
    """What the sums of a window are averaged over: its days, or the hours of a one-day window."""
    return HOURLY.get(name, day_count(lo, hi))


def window_array(as_of: dt.date, names: Sequence[str] | None = None,
                 selection: tuple[dt.date, dt.date] | None = None, **options) -> Column:
    """The windows of a known date as one constant array of at most eighteen entries."""
    known = anchors(as_of, **options)
    entries = []
    for name in names or names_for(selection):
        lo, hi = window_range(name, known, selection)
        entries.append(f"named_struct('window', '{name}', 'lo', date'{lo}', 'hi', date'{hi}',"
                       f" 'days', {day_count(lo, hi)}, 'divisor', {divisor(name, lo, hi)})")
    return F.expr("array(" + ", ".join(entries) + ")")


def window_structs(a: Anchors, names: Sequence[str] | None = None) -> Column:
    """The windows of a column of dates as an array per row."""
    structs = []
    for name in names or names_for():
        lo, hi = window_range(name, a)
        days = F.abs(F.datediff(hi, lo)) + 1
        divisor = F.lit(HOURLY[name]) if name in HOURLY else days
        structs.append(F.struct(F.lit(name).alias("window"), lo.alias("lo"), hi.alias("hi"),
                                days.alias("days"), divisor.alias("divisor")))
    return F.array(*structs)


def known_range(name: str, as_of: dt.date, selection: tuple[dt.date, dt.date] | None = None,
                **options) -> tuple[dt.date, dt.date]:
    """First and last day of one window of a known date."""
    return window_range(name, anchors(as_of, **options), selection)


def outer_range(as_of: dt.date, names: Sequence[str] | None = None,
                selection: tuple[dt.date, dt.date] | None = None, **options) -> tuple[dt.date, dt.date]:
    """The smallest range of days that covers all the windows of a known date."""
    known = anchors(as_of, **options)
    ranges = [window_range(n, known, selection) for n in names or names_for(selection)]
    return min(lo for lo, _ in ranges), max(hi for _, hi in ranges)


def span_granularity(days: Column) -> Column:
    """Bucket width for a span of days, as `5 day` and the like."""
    # The spans above which a wider bucket is used.
    width = (F.when(days > 364, F.lit("1 month")).when(days > 100, F.lit("20 day"))
             .when(days > 63, F.lit("10 day")).when(days > 30, F.lit("5 day")).otherwise(F.lit("1 day")))
    return width
