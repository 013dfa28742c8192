from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from conftest import plan_of
from tollbook.operators import series, totals as t, windows as w
from tollbook.plans.report import form_report, report, report_from_daily
from tollbook.sources import site
from tollbook.sources.tables import read_version, write_version

AS_OF, OFFSET = dt.date(2001, 7, 15), "+03:30"


def test_cube_equals_the_four_scopes(spark, folder):
    leads = site.leads(spark, folder)
    cube = t.totals_cube(leads).collect()
    methods = {r.payment_method for r in leads.select("payment_method").distinct().collect()}
    for scope in t.SCOPES:
        direct = {}
        for method in methods if "method" in scope else (None,):
            for r in t.totals(leads, scope, gateway=method or t.GATEWAY).collect():
                direct[r["form_id"] if "form" in scope else None, method] = (r.revenue, r.transactions)
        assert {(r.form_id, r.payment_method): (r.revenue, r.transactions) for r in cube if r.scope == scope} == direct


def test_one_form_equals_its_row(spark, folder):
    leads = site.leads(spark, folder)
    rows = {r.form_id: r for r in t.totals(leads, "form").collect()}
    form = next(iter(rows))
    one = t.totals(leads, "form", form_id=form).first()
    assert (one.revenue, one.transactions) == (rows[form].revenue, rows[form].transactions)


def test_golden_totals(spark):
    leads = site.leads(spark, "/root/testdata/sf0.01")
    this_month = w.in_window(t.paid(leads), "thismonth", AS_OF, OFFSET)
    assert this_month.count() == 64
    site_row = [r for r in w.all_windows_cube(w.covered_facts(leads, AS_OF, OFFSET), AS_OF).collect()
                if r.scope == "site" and r.window == "thismonth"]
    assert [(r.transactions, r.revenue) for r in site_row] == [(64, 16524127.76)]


def test_window_sums_equal_a_direct_filter(spark, folder):
    leads = site.leads(spark, folder)
    summary = {r.window: r for r in w.window_summary(w.covered_facts(leads, AS_OF, OFFSET), AS_OF).collect()}
    for name in ("last12month", "spring", "thisyear", "lastmonth"):
        direct = t.totals(w.in_window(leads, name, AS_OF, OFFSET), "site").collect()
        if direct:
            assert (summary[name].revenue, summary[name].transactions) == (direct[0].revenue, direct[0].transactions)
        else:
            assert name not in summary


def test_report_from_stored_daily_facts(spark, folder, tmp_path):
    leads, forms = site.leads(spark, folder), site.forms(spark, folder)
    write_version(t.daily_facts(leads, OFFSET), str(tmp_path / "daily"), 1)
    stored = report_from_daily(read_version(spark, str(tmp_path / "daily")), forms, AS_OF)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(
        map(tuple, report(leads, forms, AS_OF, OFFSET).collect()), key=str)


def test_report_of_one_form(spark, folder):
    leads, forms = site.leads(spark, folder), site.forms(spark, folder)
    whole = report(leads, forms, AS_OF, OFFSET).where("form_id = 7 OR form_id IS NULL")
    one = form_report(leads, forms, 7, AS_OF, OFFSET)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    with pytest.raises(ValueError):
        form_report(leads, forms, -1, AS_OF, OFFSET)


def test_report_of_no_payments_is_zero(spark, folder):
    leads = site.leads(spark, folder).limit(0)
    rows = report(leads, site.forms(spark, folder), AS_OF, OFFSET).collect()
    forms = site.forms(spark, folder).count()
    assert len(rows) == (2 * forms + 2) * 17
    assert all((r.total_revenue, r.total_transactions, r.revenue, r.transactions, r.avg_revenue) == (0, 0, 0, 0, 0)
               for r in rows)


def test_null_dates_and_keys_stay_in_the_totals(spark):
    schema = ("id long, form_id long, status string, is_fulfilled int, payment_method string,"
              " payment_amount decimal(19,2), payment_date timestamp_ntz")
    rows = [(1, None, "active", 1, None, Decimal("5.00"), None), (2, 7, "active", 1, "gateway", Decimal("2.50"), None),
            (3, 7, "spam", 1, "gateway", Decimal("9.00"), None), (4, 7, "active", 0, "gateway", Decimal("9.00"), None)]
    leads = spark.createDataFrame(rows, schema)
    cube = {(r.scope, r.form_id, r.payment_method): r.revenue for r in t.totals_cube(leads).collect()}
    assert cube == {("form_method", None, None): 5.0, ("form_method", 7, "gateway"): 2.5, ("form", None, None): 5.0,
                    ("form", 7, None): 2.5, ("method", None, None): 5.0, ("method", None, "gateway"): 2.5,
                    ("site", None, None): 7.5}
    forms = spark.createDataFrame([(7,)], "id long")
    tiles = {(r.scope, r.form_id): r.total_revenue for r in report(leads, forms, AS_OF, OFFSET).collect()}
    assert tiles["site", None] == 7.5 and tiles["form", 7] == 2.5


def test_local_day_and_late_evening(spark):
    schema = ("id long, form_id long, status string, is_fulfilled int, payment_method string,"
              " payment_amount decimal(19,2), payment_date timestamp_ntz")
    late = dt.datetime(2024, 1, 30, 20, 30)
    leads = spark.createDataFrame([(1, 1, "active", 1, "gateway", Decimal("1.00"), late),
                                   (2, 1, "active", 1, "gateway", Decimal("1.00"), late - dt.timedelta(seconds=1))], schema)
    days = {r.local_day for r in t.bucket_totals(leads, "day", OFFSET).collect()}
    assert days == {dt.date(2024, 1, 30), dt.date(2024, 1, 31)}
    assert [r.id for r in w.in_window(leads, "today", dt.date(2024, 1, 31), OFFSET).collect()] == [1]
    assert [r.id for r in w.in_window(leads, "today", dt.date(2024, 1, 30), OFFSET).collect()] == [2]


def test_window_bounds_reach_the_scan(spark, folder):
    plan = plan_of(w.all_windows_cube(w.covered_facts(site.leads(spark, folder), AS_OF, OFFSET), AS_OF))
    assert "GreaterThanOrEqual(o_orderdate,2000-07-21T20:30)" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_series_carry_by_hand(spark, folder):
    leads = site.leads(spark, folder)
    rows = series.series_carry(leads, "last12month", AS_OF, OFFSET).collect()
    daily = t.bucket_totals(leads, "day", OFFSET, ("form_id",)).collect()
    epoch = dt.date(1970, 1, 1)
    wanted = {}
    for form in {r.form_id for r in daily}:
        carried = None
        for r in sorted((r for r in daily if r.form_id == form), key=lambda r: r.local_day, reverse=True):
            if dt.date(2000, 7, 22) <= r.local_day <= dt.date(2001, 7, 22):
                carried = r.revenue
            wanted[form, (r.local_day - epoch).days * 86400000] = carried
    assert {(r.form_id, r.epoch_ms): r.amount for r in rows} == wanted
