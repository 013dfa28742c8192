"""Chart series over daily facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tollbook.functions import calendar as cal, windows as win
from tollbook.operators import totals as t, windows as w


def series_in_window(leads: DataFrame, name: str, as_of, offset: str | float,
                     keys: tuple[str, ...] = (), **options) -> DataFrame:
    """Points of epoch milliseconds and amount for the days inside a window."""
    daily = t.bucket_totals(w.in_window(leads, name, as_of, offset, **options), "day", offset, keys)
    return daily.select(*keys, cal.day_epoch_ms(F.col("local_day")).alias("epoch_ms"),
                        F.col("revenue").alias("amount"), "transactions")


def series_scopes(leads: DataFrame, name: str, as_of, offset: str | float, **options) -> DataFrame:
    """The points of every form, every method and the whole site, in all four scopes."""
    daily = t.scope_totals(w.in_window(leads, name, as_of, offset, **options), "day", offset)
    return daily.select("scope", "form_id", "payment_method", cal.day_epoch_ms(F.col("local_day")).alias("epoch_ms"),
                        F.col("revenue").alias("amount"), "transactions")


def series_carry(leads: DataFrame, name: str, as_of, offset: str | float,
                 keys: Sequence[str] = ("form_id",), **options) -> DataFrame:
    """Every historic day, newest first; a day outside the window repeats the last amount inside.

    Days before the first one inside stay empty. The ordered group is the days of one scope, so its
    size is bounded by the calendar and not by the payments.
    """
    lo, hi = win.known_range(name, as_of, **options)
    daily = t.bucket_totals(leads, "day", offset, tuple(keys))
    inside = F.when(F.col("local_day").between(lo, hi), F.col("revenue"))
    newest_first = (Window.partitionBy(*keys).orderBy(F.col("local_day").desc())
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(*keys, cal.day_epoch_ms(F.col("local_day")).alias("epoch_ms"),
                        F.last(inside, ignorenulls=True).over(newest_first).alias("amount"), "transactions")


def newest_first(buckets: DataFrame, column: str) -> DataFrame:
    return buckets.orderBy(F.col(column).desc())
