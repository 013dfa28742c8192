"""Jalali (Solar Hijri) calendar and local time as plain columns.

Everything is integer arithmetic on `unix_date`, so it stays inside generated code and folds to a
literal when the input is one. The rule is the published 33-year leap cycle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The leap positions in the 33-year cycle.
LEAP_POSITIONS = (1, 5, 9, 13, 17, 22, 26, 30)

# Month names, Farvardin first.
MONTH_NAMES = ("فروردین", "اردیبهشت", "خرداد", "تير", "مرداد", "شهريور",
               "مهر", "آبان", "آذر", "دی", "بهمن", "اسفند")

# Weekday names, Sunday first.
WEEKDAY_NAMES = ("يكشنبه", "دوشنبه", "سه شنبه", "چهارشنبه", "پنج شنبه", "جمعه", "شنبه")

# Days from the start of the cycle containing Jalali year -1595 to 1970-01-01.
_EPOCH_SHIFT = 1075195
_CYCLE_DAYS = 33 * 365 + 8
_BLOCK_DAYS = 4 * 365 + 1
_EPOCH = dt.date(1970, 1, 1)

# A day is a date column or, for a date known when the query is written, a Python date. The same
# arithmetic serves both: known dates are worked out at once and enter the plan as literals.
Day = Column | dt.date
Number = Column | int


def _quotient(a: Number, b: int) -> Number:
    if isinstance(a, int):
        return a // b if a >= 0 else -(-a // b)
    return F.call_function("div", a, F.lit(b))


def _choose(condition: Column | bool, yes: Number, no: Number) -> Number:
    if isinstance(condition, bool):
        return yes if condition else no
    return F.when(condition, yes).otherwise(no)


def _int(n: Number) -> Number:
    return n if isinstance(n, int) else n.cast("int")


def _day_number(d: Day) -> Number:
    return (d - _EPOCH).days if isinstance(d, dt.date) else F.unix_date(d).cast("bigint")


def _day_at(number: Number) -> Day:
    return shift(_EPOCH, number) if isinstance(number, int) else F.date_from_unix_date(number.cast("int"))


def shift(d: Day, days: Number) -> Day:
    """The day some days later."""
    return d + dt.timedelta(days) if isinstance(d, dt.date) else F.date_add(d, days)


def as_column(d: Day) -> Column:
    return F.lit(d) if isinstance(d, dt.date) else d


def _year_and_day(d: Day) -> tuple[Number, Number]:
    shifted = _day_number(d) + _EPOCH_SHIFT
    in_cycle = shifted % _CYCLE_DAYS
    in_block = in_cycle % _BLOCK_DAYS
    # The first year of a block has 366 days, the other three 365.
    year_in_block = _quotient(in_block - 1, 365)
    year = 33 * _quotient(shifted, _CYCLE_DAYS) + 4 * _quotient(in_cycle, _BLOCK_DAYS) + year_in_block - 1595
    yday = in_block - 365 * year_in_block - _choose(year_in_block > 0, 1, 0)
    return _int(year), _int(yday)


def jalali_year(d: Day) -> Number:
    return _year_and_day(d)[0]


def jalali_yday(d: Day) -> Number:
    """Days since the first day of the Jalali year, from 0."""
    return _year_and_day(d)[1]


def jalali_month(d: Day) -> Number:
    return month_of(jalali_yday(d))


def jalali_day(d: Day) -> Number:
    return day_of(jalali_yday(d))


def month_of(yday: Number) -> Number:
    """Month of a day of the year counted from 0."""
    return _int(_choose(yday < 186, 1 + _quotient(yday, 31), 7 + _quotient(yday - 186, 30)))


def day_of(yday: Number) -> Number:
    """Day of the month of a day of the year counted from 0."""
    return _int(_choose(yday < 186, 1 + yday % 31, 1 + (yday - 186) % 30))


def is_jalali_leap(year: Number) -> Column | bool:
    return year % 33 in LEAP_POSITIONS if isinstance(year, int) else F.pmod(year, F.lit(33)).isin(*LEAP_POSITIONS)


def jalali_year_length(year: Number) -> Number:
    return _choose(is_jalali_leap(year), 366, 365)


def jalali_month_length(year: Number, month: Number) -> Number:
    return _choose(month <= 6, 31, _choose(month <= 11, 30, jalali_year_length(year) - 336))


def jalali_season(month: Number) -> Number:
    return _int(1 + _quotient(month - 1, 3))


def jalali_to_date(year: Number, month: Number, day: Number) -> Day:
    """Jalali year, month, day as a date. Out-of-range days roll over like day arithmetic."""
    y = (year if isinstance(year, int) else year.cast("bigint")) + 1595
    before_year = 365 * y + 8 * _quotient(y, 33) + _quotient(y % 33 + 3, 4)
    before_month = _choose(month < 7, (month - 1) * 31, (month - 7) * 30 + 186)
    return _day_at(before_year + before_month + day - 355668 - 719528)


def jalali_text(d: Column) -> Column:
    """`YYYY-MM-DD` on the Jalali calendar."""
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(jalali_year(d).cast("string"), F.lit("-"), two(jalali_month(d)), F.lit("-"), two(jalali_day(d)))


def jalali_datetime_text(ts: Column) -> Column:
    """`YYYY-MM-DD HH:mm:ss` with the date on the Jalali calendar."""
    return F.concat(jalali_text(F.to_date(ts)), F.lit(" "), F.date_format(ts, "HH:mm:ss"))


def month_start(d: Day) -> Day:
    """First day of the Jalali month containing `d`."""
    return shift(d, 1 - jalali_day(d))


def month_end(d: Day) -> Day:
    return shift(d, jalali_month_length(jalali_year(d), jalali_month(d)) - jalali_day(d))


def year_start(d: Day) -> Day:
    """First day of the Jalali year containing `d`."""
    return shift(d, -jalali_yday(d))


def year_end(d: Day) -> Day:
    return shift(d, jalali_year_length(jalali_year(d)) - 1 - jalali_yday(d))


def calendar_attributes(d: Column) -> dict[str, Column]:
    """The date-dimension columns of a day."""
    year, month, yday = jalali_year(d), jalali_month(d), jalali_yday(d)
    return {
        "jy": year,
        "jm": month,
        "jd": jalali_day(d),
        "yday": yday,
        "days_left": jalali_year_length(year) - 1 - yday,
        "month_length": jalali_month_length(year, month),
        "is_leap": is_jalali_leap(year),
        "season": jalali_season(month),
        "month_name": month_name(month),
        "weekday": sat_weekday(d),
        "weekday_name": weekday_name(d),
    }


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), month)


def weekday_name(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.dayofweek(d))


def sat_weekday(d: Day) -> Number:
    """Weekday number of a week that starts on Saturday, from 0."""
    return (d.weekday() + 2) % 7 if isinstance(d, dt.date) else F.dayofweek(d) % 7


def months_back(d: Day, months: int) -> Day:
    """`d` less some Gregorian months, a missing day rolling over into the next month.

    31 March less one month is 2 or 3 March, where `add_months` would stop at the end of February.
    """
    if isinstance(d, dt.date):
        year, month = divmod(d.year * 12 + d.month - 1 - months, 12)
        return shift(dt.date(year, month + 1, 1), d.day - 1)
    return F.date_add(F.add_months(F.trunc(d, "MM"), -months), F.dayofmonth(d) - 1)


def parse_any_date(text: Column) -> Column:
    """A `Y-m-d` text as a date: years before 2000 are Jalali, the others Gregorian."""
    parts = F.split(F.trim(text), "-")
    y, m, d = (F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    gregorian = F.to_date(F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0)))
    return F.when(y < 2000, jalali_to_date(y, m, d)).otherwise(gregorian)


def parse_known_date(text: str) -> dt.date:
    """The same for a text that is known when the query is written, such as a chosen range."""
    y, m, d = (int(part) for part in text.strip().split("-"))
    return jalali_to_date(y, m, d) if y < 2000 else dt.date(y, m, d)


def parse_jalali_datetime(text: Column) -> Column:
    """A Jalali `Y-m-d H:M:S` text as a local time; missing clock parts are zero."""
    numbers = F.regexp_extract_all(text, F.lit("[0-9]+"), 0)
    part = [F.try_element_at(numbers, F.lit(i)).try_cast("int") for i in range(1, 7)]
    clock = F.make_dt_interval(F.lit(0), *[F.coalesce(p, F.lit(0)) for p in part[3:]])
    return jalali_to_date(*part[:3]).cast("timestamp_ntz") + clock


def offset_minutes(offset: str | float) -> int:
    """Minutes of an offset given as `+03:30` or as hours such as 3.5, with its true sign."""
    if isinstance(offset, str):
        sign = -1 if offset.startswith("-") else 1
        hours, _, minutes = offset.lstrip("+-").partition(":")
        return sign * (int(hours) * 60 + int(minutes or 0))
    return round(float(offset) * 60)


def _interval(minutes: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def to_local(utc: Column, offset: str | float) -> Column:
    """UTC time to local time by one fixed offset for all history."""
    return utc + _interval(offset_minutes(offset))


def to_utc(local: Column, offset: str | float) -> Column:
    return local - _interval(offset_minutes(offset))


def local_day(utc: Column, offset: str | float) -> Column:
    return F.to_date(to_local(utc, offset))


def local_hour(utc: Column, offset: str | float) -> Column:
    """Start of the local hour, without zone."""
    local = to_local(utc, offset)
    return F.to_date(local).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(local))


def day_start_utc(day: Day, offset: str | float) -> Column:
    """The UTC instant at which a local day starts."""
    return to_utc(as_column(day).cast("timestamp_ntz"), offset)


def day_epoch_ms(day: Column) -> Column:
    """Milliseconds of the local midnight, read as if it were UTC."""
    return F.unix_date(day).cast("bigint") * 86400000
