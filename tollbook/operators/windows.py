"""Calendar windows over daily facts: filters, the range join, sums and averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tollbook.functions import calendar as cal, windows as win
from tollbook.functions.calendar import Day
from tollbook.operators import totals as t


def window_bounds(spark: SparkSession, as_of, names: Sequence[str] | None = None, **options) -> DataFrame:
    """The windows of one date as a small table."""
    return spark.range(1).select(F.inline(win.window_array(as_of, names, **options)))


def bounds_of(days: DataFrame, day: str, names: Sequence[str] | None = None) -> DataFrame:
    """The windows of every date in a column."""
    anchored, anchors = win.with_anchors(days, day)
    return anchored.select(F.col(day).alias("as_of"), F.inline(win.window_structs(anchors, names)))


def between_days(leads: DataFrame, lo: Day, hi: Day, offset: str | float) -> DataFrame:
    """Keep leads whose local day is in lo..hi.

    The days become UTC instants and the raw column is compared, so the file scan can skip.
    """
    ts = F.col("payment_date")
    return leads.where((ts >= cal.day_start_utc(lo, offset)) & (ts < cal.day_start_utc(cal.shift(hi, 1), offset)))


def in_window(leads: DataFrame, name: str, as_of, offset: str | float, **options) -> DataFrame:
    lo, hi = win.known_range(name, as_of, **options)
    return between_days(leads, lo, hi, offset)


def covered(leads: DataFrame, as_of, offset: str | float, names: Sequence[str] | None = None, **options) -> DataFrame:
    """Keep leads that fall in at least the outer range of the windows."""
    lo, hi = win.outer_range(as_of, names, **options)
    return between_days(leads, lo, hi, offset)


def to_windows(daily: DataFrame, as_of, names: Sequence[str] | None = None, day: str = "local_day",
               **options) -> DataFrame:
    """Each daily row once for every window that contains its day.

    The windows are a constant array of at most eighteen ranges, so the range join is a filter in the
    same stage: no shuffle, no second table, and generated code throughout.
    """
    paired = daily.select("*", F.inline(win.window_array(as_of, names, **options)))
    return paired.where(F.col(day).between(F.col("lo"), F.col("hi")))


def average(value: Column, divisor: Column) -> Column:
    return value / F.nullif(divisor, F.lit(0))


def covered_facts(leads: DataFrame, as_of, offset: str | float, names: Sequence[str] | None = None,
                  **options) -> DataFrame:
    """Daily facts of no more days than the windows reach."""
    return t.daily_facts(covered(leads, as_of, offset, names, **options), offset)


def window_facts(daily: DataFrame, as_of, names: Sequence[str] | None = None, **options) -> DataFrame:
    """Sums per (window, form, method), revenue still a decimal."""
    return (to_windows(daily, as_of, names, **options)
            .groupBy("window", "form_id", "payment_method")
            .agg(F.sum("revenue").alias("revenue"), F.sum("transactions").alias("transactions")))


def all_windows_cube(daily: DataFrame, as_of, names: Sequence[str] | None = None, **options) -> DataFrame:
    """Sums of every window in every scope: days first, then windows, then scopes."""
    rolled = t.scope_rollup(window_facts(daily, as_of, names, **options), "window")
    return t.money_as_double(
        rolled.select("window", "scope", "form_id", "payment_method", "revenue", "transactions"), "revenue")


def window_summary(daily: DataFrame, as_of, names: Sequence[str] | None = None, **options) -> DataFrame:
    """Revenue and transactions of each window over all forms and methods."""
    summed = (to_windows(daily, as_of, names, **options).groupBy("window", "divisor")
              .agg(F.sum("revenue").alias("revenue"), F.sum("transactions").alias("transactions")))
    return t.money_as_double(summed, "revenue")


def with_averages(summary: DataFrame) -> DataFrame:
    """Revenue and transactions per day (per hour in the one-day windows)."""
    return summary.withColumns({
        "avg_revenue": average(F.col("revenue"), F.col("divisor")),
        "avg_transactions": average(F.col("transactions"), F.col("divisor")),
    })
