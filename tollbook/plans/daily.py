"""Daily sums kept as a table, of which only the days that changes touch are made anew.

The table has a folder for each local day. New, late, corrected or withdrawn payments name their days; those days are
summed again from the payments, read by their UTC range, and replace their folders. Reports read the table alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tollbook.functions import calendar as cal
from tollbook.operators import totals as t, windows as w

SCHEMA = "form_id bigint, payment_method string, revenue decimal(29,2), transactions bigint, local_day date"


Days = Iterable[dt.date | None]


def touched_days(changes: DataFrame, offset: str | float) -> list[dt.date | None]:
    """The local days of changed payments, null for those without a date; as many as the calendar has at most."""
    days = changes.select(cal.local_day(F.col("payment_date"), offset).alias("day")).distinct()
    return [r.day for r in days.collect()]


def _of_days(leads: DataFrame, days: list[dt.date | None], offset: str | float) -> DataFrame:
    """The payments of some days; between the first and the last one the scan can skip files."""
    dated = sorted(day for day in days if day)
    undated = leads.where(F.col("payment_date").isNull())
    if not dated:
        return undated
    own = w.between_days(leads, dated[0], dated[-1], offset).where(
        cal.local_day(F.col("payment_date"), offset).isin(dated))
    return own if len(dated) == len(days) else own.unionByName(undated)


def refresh_days(leads: DataFrame, path: str, days: Days, offset: str | float) -> None:
    """Sum the payments of some days again and replace those days.

    A day without payments left is replaced by an empty row. Writing the same days again changes nothing.
    """
    days = list(set(days))
    if not days:
        return
    facts = t.daily_facts(_of_days(leads, days, offset), offset)
    empty = leads.sparkSession.createDataFrame([(day,) for day in days], "local_day date")
    empty = empty.withColumn("transactions", F.lit(0).cast("bigint"))
    _write(facts.unionByName(empty, allowMissingColumns=True), path, "dynamic")


def build_daily(leads: DataFrame, path: str, offset: str | float) -> None:
    """The table of all days, in place of any that was there."""
    _write(t.daily_facts(leads, offset), path, "static")


def _write(rows: DataFrame, path: str, replaced: str) -> None:
    # Small days share a task, one day of many forms is split over several.
    dealt = rows.hint("rebalance", "local_day")
    dealt.write.partitionBy("local_day").option("partitionOverwriteMode", replaced).mode("overwrite").parquet(path)


def apply_changes(leads: DataFrame, changes: DataFrame, path: str, offset: str | float) -> list[dt.date | None]:
    """Bring the table up to date after `changes` (payments as they are now, and as they were where their day moved);
    `leads` has them applied. Returns the days that were replaced."""
    days = touched_days(changes, offset)
    refresh_days(leads, path, days, offset)
    return days


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The sums, in the columns of `daily_facts`."""
    kept = spark.read.schema(SCHEMA).parquet(path).where(F.col("transactions") > 0)
    return kept.select("form_id", "payment_method", "local_day", "revenue", "transactions")
