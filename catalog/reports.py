"""Totals, windows, series and the report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import query
from catalog.views import FORMS, HOURLY, LEADS, PAID, WINDOWS_2001, sql
from tollbook.functions import calendar as cal, windows as win
from tollbook.operators import series, totals as t, windows as w
from tollbook.plans import daily
from tollbook.plans.report import report, report_from_daily
from tollbook.session import new_path
from tollbook.sources import site
from tollbook.sources.tables import read_version, write_version

OFFSET = "+03:30"
AS_OF = dt.date(2001, 7, 15)
SELECTION = (dt.date(2000, 11, 5), dt.date(2001, 2, 20))
EVENTS_AS_OF = dt.date(2024, 1, 30)
LOCAL = "payment_date + INTERVAL '210 minutes'"


@query("paid_filter", sql(LEADS, PAID, """
SELECT id, form_id, payment_method, CAST(payment_amount AS DOUBLE) AS payment_amount, payment_date FROM paid"""))
def paid_filter(spark, folder):
    return t.paid(site.leads(spark, folder)).select(
        "id", "form_id", "payment_method", F.col("payment_amount").cast("double"), "payment_date")


@query("leads_scan", sql(LEADS, """
SELECT id, form_id, status, is_fulfilled, payment_method, CAST(payment_amount AS DOUBLE) AS payment_amount, payment_date
FROM leads"""))
def leads_scan(spark, folder):
    return site.leads(spark, folder).select("id", "form_id", "status", "is_fulfilled", "payment_method",
                                            F.col("payment_amount").cast("double"), "payment_date")


@query("scope_filter", sql(LEADS, PAID, """
SELECT id, 'form' AS scope FROM paid UNION ALL SELECT id, 'site' FROM paid
UNION ALL SELECT id, 'form_method' FROM paid WHERE payment_method = 'gateway'
UNION ALL SELECT id, 'method' FROM paid WHERE payment_method = 'gateway'"""))
def scope_filter(spark, folder):
    return t.scope_rows(site.leads(spark, folder)).select("id", "scope")


@query("window_filter", sql(LEADS, PAID, f"""
SELECT id, CAST(payment_amount AS DOUBLE) AS payment_amount, payment_date FROM paid
WHERE CAST({LOCAL} AS DATE) BETWEEN DATE '2000-07-22' AND DATE '2001-07-22'"""))
def window_filter(spark, folder):
    inside = w.in_window(t.paid(site.leads(spark, folder)), "last12month", AS_OF, OFFSET)
    return inside.select("id", F.col("payment_amount").cast("double"), "payment_date")


def _totals(scope):
    return lambda spark, folder: t.totals(site.leads(spark, folder), scope)


SUMS = "CAST(coalesce(sum(payment_amount), 0) AS DOUBLE) AS revenue, count(id) AS transactions"

query("totals_form_method", sql(LEADS, PAID, f"""
SELECT form_id, status, {SUMS} FROM paid WHERE payment_method = 'gateway' GROUP BY form_id, status"""))(
    _totals("form_method"))
query("totals_method", sql(LEADS, PAID, f"""
SELECT status, {SUMS} FROM paid WHERE payment_method = 'gateway' GROUP BY status"""))(_totals("method"))
query("totals_form", sql(LEADS, PAID, f"""
SELECT form_id, status, {SUMS} FROM paid GROUP BY form_id, status"""))(_totals("form"))
query("totals_site", sql(LEADS, PAID, f"SELECT status, {SUMS} FROM paid GROUP BY status"))(_totals("site"))


@query("totals_cube", sql(LEADS, PAID, f"""
SELECT 'form_method' AS scope, form_id, payment_method, {SUMS} FROM paid GROUP BY form_id, payment_method
UNION ALL SELECT 'form', form_id, NULL, {SUMS} FROM paid GROUP BY form_id
UNION ALL SELECT 'method', NULL, payment_method, {SUMS} FROM paid GROUP BY payment_method
UNION ALL SELECT 'site', NULL, NULL, {SUMS} FROM paid"""))
def totals_cube(spark, folder):
    return t.totals_cube(site.leads(spark, folder))


@query("daily_totals", sql(LEADS, PAID, f"""
SELECT form_id, CAST({LOCAL} AS DATE) AS local_day, {SUMS} FROM paid GROUP BY ALL"""))
def daily_totals(spark, folder):
    return t.bucket_totals(site.leads(spark, folder), "day", OFFSET, ("form_id",))


@query("hourly_totals", sql(HOURLY, PAID, f"""
SELECT form_id, payment_method, date_trunc('hour', {LOCAL}) AS local_hour, {SUMS} FROM paid GROUP BY ALL"""))
def hourly_totals(spark, folder):
    return t.bucket_totals(site.hourly_leads(spark, folder), "hour", OFFSET, ("form_id", "payment_method"))


@query("hour_dom_profile", sql(HOURLY, PAID, f"""
SELECT CAST(hour({LOCAL}) AS INTEGER) AS hour, CAST(day({LOCAL}) AS INTEGER) AS dom, {SUMS} FROM paid GROUP BY ALL"""))
def hour_dom_profile(spark, folder):
    return t.bucket_totals(site.hourly_leads(spark, folder), "hour_dom", OFFSET)


@query("instant_totals", sql(HOURLY, PAID, f"""
SELECT {LOCAL} AS local_ts, {SUMS} FROM paid GROUP BY ALL"""))
def instant_totals(spark, folder):
    return t.bucket_totals(site.hourly_leads(spark, folder), "instant", OFFSET)


DAILY = f"""daily AS (
  SELECT form_id, payment_method, CAST({LOCAL} AS DATE) AS local_day, sum(payment_amount) AS revenue, count(*) AS transactions
  FROM paid GROUP BY ALL)"""


def _covered(spark, folder):
    return w.covered_facts(site.leads(spark, folder), AS_OF, OFFSET, selection=SELECTION)


@query("window_range_join", sql(LEADS, PAID, DAILY, WINDOWS_2001, """
SELECT w AS "window", form_id, payment_method, local_day, CAST(revenue AS DOUBLE) AS revenue, transactions
FROM daily JOIN windows ON local_day BETWEEN lo AND hi"""))
def window_range_join(spark, folder):
    joined = w.to_windows(_covered(spark, folder), AS_OF, selection=SELECTION)
    return t.money_as_double(
        joined.select("window", "form_id", "payment_method", "local_day", "revenue", "transactions"), "revenue")


@query("window_summary", sql(LEADS, PAID, DAILY, WINDOWS_2001, """
SELECT w AS "window", divisor, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(transactions) AS BIGINT) AS transactions
FROM daily JOIN windows ON local_day BETWEEN lo AND hi GROUP BY ALL"""))
def window_summary(spark, folder):
    return w.window_summary(_covered(spark, folder), AS_OF, selection=SELECTION)


@query("window_average", sql(LEADS, PAID, DAILY, WINDOWS_2001, """
SELECT w AS "window", CAST(sum(revenue) AS DOUBLE) / divisor AS avg_revenue,
  CAST(sum(transactions) AS DOUBLE) / divisor AS avg_transactions
FROM daily JOIN windows ON local_day BETWEEN lo AND hi GROUP BY w, divisor"""))
def window_average(spark, folder):
    summary = w.window_summary(_covered(spark, folder), AS_OF, selection=SELECTION)
    return w.with_averages(summary).select("window", "avg_revenue", "avg_transactions")


CUBE = """SELECT w AS "window", scope, form_id, payment_method, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(sum(transactions) AS BIGINT) AS transactions
FROM (
  SELECT 'form_method' AS scope, form_id, payment_method, local_day, revenue, transactions FROM daily
  UNION ALL SELECT 'form', form_id, NULL, local_day, revenue, transactions FROM daily
  UNION ALL SELECT 'method', NULL, payment_method, local_day, revenue, transactions FROM daily
  UNION ALL SELECT 'site', NULL, NULL, local_day, revenue, transactions FROM daily) x
JOIN windows ON local_day BETWEEN lo AND hi GROUP BY ALL"""


@query("all_windows_cube", sql(LEADS, PAID, DAILY, WINDOWS_2001, CUBE))
def all_windows_cube(spark, folder):
    return w.all_windows_cube(_covered(spark, folder), AS_OF, selection=SELECTION)


REPORT = sql(LEADS, PAID, FORMS, DAILY, WINDOWS_2001, """
scopes AS (
  SELECT 'form_method' AS scope, id AS form_id FROM forms
  UNION SELECT 'form_method', form_id FROM paid WHERE payment_method = 'gateway'
  UNION SELECT 'form', id FROM forms UNION SELECT 'form', form_id FROM paid
  UNION SELECT 'method', NULL UNION SELECT 'site', NULL),
facts AS (
  SELECT 'form_method' AS scope, form_id, local_day, revenue, transactions FROM daily WHERE payment_method = 'gateway'
  UNION ALL SELECT 'form', form_id, local_day, revenue, transactions FROM daily
  UNION ALL SELECT 'method', NULL, local_day, revenue, transactions FROM daily WHERE payment_method = 'gateway'
  UNION ALL SELECT 'site', NULL, local_day, revenue, transactions FROM daily),
all_time AS (SELECT scope, form_id, sum(revenue) AS r, sum(transactions) AS n FROM facts GROUP BY ALL),
inside AS (
  SELECT scope, form_id, w, sum(revenue) AS r, sum(transactions) AS n
  FROM facts JOIN windows ON local_day BETWEEN lo AND hi GROUP BY ALL)""", """
SELECT s.scope, s.form_id, v.w AS "window",
  CAST(coalesce(a.r, 0) AS DOUBLE) AS total_revenue, CAST(coalesce(a.n, 0) AS BIGINT) AS total_transactions,
  CAST(coalesce(i.r, 0) AS DOUBLE) AS revenue, CAST(coalesce(i.n, 0) AS BIGINT) AS transactions,
  CAST(coalesce(i.r, 0) AS DOUBLE) / v.divisor AS avg_revenue, CAST(coalesce(i.n, 0) AS DOUBLE) / v.divisor AS avg_transactions
FROM scopes s CROSS JOIN windows v
LEFT JOIN all_time a ON a.scope = s.scope AND a.form_id IS NOT DISTINCT FROM s.form_id
LEFT JOIN inside i ON i.scope = s.scope AND i.form_id IS NOT DISTINCT FROM s.form_id AND i.w = v.w""")


@query("report", REPORT)
def full_report(spark, folder):
    return report(site.leads(spark, folder), site.forms(spark, folder), AS_OF, OFFSET, selection=SELECTION)


@query("report_sink", REPORT)
def report_sink(spark, folder):
    path = new_path(spark, "report")
    write_version(full_report(spark, folder), path, 1)
    return read_version(spark, path)


@query("report_maintained", REPORT)
def report_maintained(spark, folder):
    """The report from the table of days, after payments that came late."""
    leads, path = site.leads(spark, folder), new_path(spark, "daily")
    late = F.col("id") % 500 == 7
    daily.build_daily(leads.where(~late), path, OFFSET)
    daily.apply_changes(leads, leads.where(late), path, OFFSET)
    return report_from_daily(daily.read_daily(spark, path), site.forms(spark, folder), AS_OF, selection=SELECTION)


def scope_sums(source: str, grain: str, name: str, kind: str) -> str:
    """Sums of every hour or day in the four scopes."""
    return sql(source, PAID, f"""
SELECT CASE grouping(form_id) * 2 + grouping(payment_method) WHEN 0 THEN 'form_method' WHEN 1 THEN 'form' WHEN 2 THEN 'method'
    ELSE 'site' END AS scope, form_id, payment_method, CAST(moment AS {kind}) AS {name},
  CAST(sum(payment_amount) AS DOUBLE) AS revenue, count(id) AS transactions
FROM (SELECT *, date_trunc('{grain}', {LOCAL}) AS moment FROM paid)
GROUP BY GROUPING SETS ((moment, form_id, payment_method), (moment, form_id), (moment, payment_method), (moment))""")


@query("daily_scope_totals", scope_sums(LEADS, "day", "local_day", "DATE"))
def daily_scope_totals(spark, folder):
    return t.scope_totals(site.leads(spark, folder), "day", OFFSET)


@query("hourly_scope_totals", scope_sums(HOURLY, "hour", "local_hour", "TIMESTAMP"))
def hourly_scope_totals(spark, folder):
    return t.scope_totals(site.hourly_leads(spark, folder), "hour", OFFSET)


EPOCH = "datediff('day', DATE '1970-01-01', local_day) * 86400000"
FORM_DAILY = f"""daily AS (
  SELECT form_id, CAST({LOCAL} AS DATE) AS local_day, sum(payment_amount) AS revenue, count(*) AS transactions
  FROM paid GROUP BY ALL)"""


@query("series_in_window", sql(LEADS, PAID, FORM_DAILY, f"""
SELECT form_id, {EPOCH} AS epoch_ms, CAST(revenue AS DOUBLE) AS amount, transactions FROM daily
WHERE local_day BETWEEN DATE '2001-03-21' AND DATE '2002-03-20'"""))
def series_in_window(spark, folder):
    return series.series_in_window(site.leads(spark, folder), "thisyear", AS_OF, OFFSET, ("form_id",))


@query("series_scopes", sql(LEADS, PAID, f"""
daily AS (
  SELECT CASE grouping(form_id) * 2 + grouping(payment_method) WHEN 0 THEN 'form_method' WHEN 1 THEN 'form' WHEN 2 THEN 'method'
      ELSE 'site' END AS scope, form_id, payment_method, local_day, sum(payment_amount) AS revenue, count(*) AS transactions
  FROM (SELECT *, CAST({LOCAL} AS DATE) AS local_day FROM paid)
  GROUP BY GROUPING SETS ((local_day, form_id, payment_method), (local_day, form_id), (local_day, payment_method), (local_day)))""", f"""
SELECT scope, form_id, payment_method, {EPOCH} AS epoch_ms, CAST(revenue AS DOUBLE) AS amount, transactions FROM daily
WHERE local_day BETWEEN DATE '2001-03-21' AND DATE '2002-03-20'"""))
def series_scopes(spark, folder):
    return series.series_scopes(site.leads(spark, folder), "thisyear", AS_OF, OFFSET)


@query("series_carry", sql(LEADS, PAID, FORM_DAILY, f"""
SELECT form_id, {EPOCH} AS epoch_ms, last_value(CASE WHEN local_day BETWEEN DATE '2000-07-22' AND DATE '2001-07-22'
    THEN CAST(revenue AS DOUBLE) END IGNORE NULLS) OVER (PARTITION BY form_id ORDER BY local_day DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount, transactions FROM daily"""))
def series_carry(spark, folder):
    return series.series_carry(site.leads(spark, folder), "last12month", AS_OF, OFFSET)


@query("series_desc", sql(LEADS, PAID, f"""
SELECT CAST({LOCAL} AS DATE) AS local_day, {SUMS} FROM paid GROUP BY ALL ORDER BY local_day DESC"""))
def series_desc(spark, folder):
    return series.newest_first(t.bucket_totals(site.leads(spark, folder), "day", OFFSET), "local_day")


@query("day_epoch_ms", sql(HOURLY, f"""
SELECT id, datediff('day', DATE '1970-01-01', CAST({LOCAL} AS DATE)) * 86400000 AS epoch_ms FROM leads"""))
def day_epoch_ms(spark, folder):
    return site.hourly_leads(spark, folder).select(
        "id", cal.day_epoch_ms(cal.local_day(F.col("payment_date"), OFFSET)).alias("epoch_ms"))


@query("span_granularity", sql(LEADS, """
spans AS (SELECT form_id, datediff('day', min(payment_date), max(payment_date)) + 1 AS days FROM leads GROUP BY form_id)""", """
SELECT form_id, CAST(days AS INTEGER) AS days, CASE WHEN days > 364 THEN '1 month' WHEN days > 100 THEN '20 day'
  WHEN days > 63 THEN '10 day' WHEN days > 30 THEN '5 day' ELSE '1 day' END AS width FROM spans"""))
def span_granularity(spark, folder):
    days = F.datediff(F.max("payment_date"), F.min("payment_date")) + 1
    spans = site.leads(spark, folder).groupBy("form_id").agg(days.alias("days"))
    return spans.withColumn("width", win.span_granularity(F.col("days")))
