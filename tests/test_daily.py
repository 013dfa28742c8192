"""The table of days: only touched days change, and the report from it equals a full one."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tollbook.operators import totals as t
from tollbook.plans import daily
from tollbook.plans.report import report, report_from_daily
from tollbook.sources import site

OFFSET, AS_OF = "+03:30", dt.date(2001, 7, 15)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _files(path):
    return {p.parent.name: p.name for p in Path(path).rglob("*.parquet")}


def test_a_late_payment_changes_its_day_alone(spark, folder, tmp_path):
    leads, path = site.leads(spark, folder).where("form_id < 20").cache(), str(tmp_path / "daily")
    late = t.paid(leads).orderBy(F.col("id").desc()).limit(1)
    daily.build_daily(leads.join(late.select("id"), "id", "left_anti"), path, OFFSET)
    before = _files(path)
    (day,) = daily.apply_changes(leads, late, path, OFFSET)
    after = _files(path)
    assert {d for d in after if after[d] != before.get(d)} == {f"local_day={day}"}
    forms = site.forms(spark, folder)
    assert _rows(report_from_daily(daily.read_daily(spark, path), forms, AS_OF)) == _rows(report(leads, forms, AS_OF, OFFSET))


def test_days_that_lose_their_payments(spark, folder, tmp_path):
    leads, path = site.leads(spark, folder).where("form_id < 20"), str(tmp_path / "daily")
    daily.build_daily(leads, path, OFFSET)
    gone = t.paid(leads).where("id % 5 = 0")
    left = leads.where("id % 5 <> 0")
    for _ in range(2):  # the same changes again
        daily.apply_changes(left, gone, path, OFFSET)
    assert _rows(daily.read_daily(spark, path)) == _rows(t.daily_facts(left, OFFSET))


def test_moved_and_undated_payments(spark, folder, tmp_path):
    leads, path = site.leads(spark, folder).where("form_id < 10"), str(tmp_path / "daily")
    daily.build_daily(leads, path, OFFSET)
    moved = F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 1, F.lit(dt.datetime(2001, 7, 1, 22))).otherwise(
        F.col("payment_date")).cast("timestamp_ntz")
    now = leads.withColumn("payment_date", moved)
    changed = leads.where("id % 4 < 2").unionByName(now.where("id % 4 < 2"))
    days = daily.apply_changes(now, changed, path, OFFSET)
    assert None in days and dt.date(2001, 7, 2) in days
    assert _rows(daily.read_daily(spark, path)) == _rows(t.daily_facts(now, OFFSET))
    daily.refresh_days(now, path, [], OFFSET)
    assert daily.apply_changes(now, now.limit(0), path, OFFSET) == []


@pytest.mark.parametrize("rows", [1, 7])
def test_report_deals_days_and_forms_by_their_number(spark, folder, monkeypatch, rows):
    """The wide rows of forms, also those without payments, are made in tasks of so many rows; the result does not depend on it."""
    leads, forms = site.leads(spark, folder).where("form_id % 9 = 1"), site.forms(spark, folder).where("id % 9 = 1")
    wanted = _rows(report(leads, forms, AS_OF, OFFSET))
    monkeypatch.setattr("tollbook.plans.report.ROWS_IN_TASK", rows)
    found = report(leads, forms, AS_OF, OFFSET)
    tasks = -(-(leads.count() + forms.count()) // rows)
    plan = plan_of(found)
    plan = plan[plan.index("\n(1) "):]  # from the scans up
    assert f"{tasks}), REPARTITION_BY_NUM" in plan
    # The forms join the days before anything wide is summed.
    assert plan.index("Union") < plan.index("REPARTITION_BY_NUM") < plan.index("Expand")
    assert _rows(found) == wanted
