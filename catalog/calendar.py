"""Calendar and local-time columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.reports import OFFSET
from catalog.views import HOURLY, JALALI, sql
from tollbook.functions import calendar as cal
from tollbook.operators import windows as w
from tollbook.sources import site
from tollbook.sources.tables import scan

# Month and weekday names.
MONTHS = "['فروردین','اردیبهشت','خرداد','تير','مرداد','شهريور','مهر','آبان','آذر','دی','بهمن','اسفند']"
WEEKDAYS = "['يكشنبه','دوشنبه','سه شنبه','چهارشنبه','پنج شنبه','جمعه','شنبه']"


def _days(spark, folder):
    """Every day that has orders."""
    orders = scan(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return orders.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


@query("to_local", sql(HOURLY, "SELECT id, payment_date + INTERVAL '210 minutes' AS local_ts FROM leads"))
def to_local(spark, folder):
    return site.hourly_leads(spark, folder).select("id", cal.to_local(F.col("payment_date"), OFFSET).alias("local_ts"))


@query("offset_shift", sql(HOURLY, """
SELECT id, payment_date + INTERVAL '210 minutes' AS tehran, payment_date - INTERVAL '30 minutes' AS half_west,
  payment_date - INTERVAL '570 minutes' AS marquesas, payment_date - INTERVAL '345 minutes' AS from_kathmandu
FROM leads"""))
def offset_shift(spark, folder):
    ts = F.col("payment_date")
    return site.hourly_leads(spark, folder).select(
        "id", cal.to_local(ts, 3.5).alias("tehran"), cal.to_local(ts, -0.5).alias("half_west"),
        cal.to_local(ts, -9.5).alias("marquesas"), cal.to_utc(ts, 5.75).alias("from_kathmandu"))


@query("jalali_dim", sql(JALALI, f"""
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, jy, jm, jd, yday, CAST(len - 1 - yday AS INTEGER) AS days_left,
  CAST(count(DISTINCT jd_all.n) AS INTEGER) AS month_length, len = 366 AS is_leap, CAST((jm - 1) // 3 + 1 AS INTEGER) AS season,
  {MONTHS}[jm] AS month_name,
  CAST((dayofweek(CAST(o_orderdate AS DATE)) + 1) % 7 AS INTEGER) AS weekday,
  {WEEKDAYS}[dayofweek(CAST(o_orderdate AS DATE)) + 1] AS weekday_name
FROM orders JOIN jcal ON d = CAST(o_orderdate AS DATE)
JOIN (SELECT jy AS y, jm AS m, max(jd) AS n_days FROM jcal GROUP BY jy, jm) ml ON y = jy AND m = jm
JOIN (SELECT unnest(range(1, 32)) AS n) jd_all ON n <= n_days
GROUP BY ALL""".replace("count(*) AS orders", "count(DISTINCT o_orderkey) AS orders")))
def jalali_dim(spark, folder):
    attributes = cal.calendar_attributes(F.col("day"))
    return _days(spark, folder).withColumns(attributes)


@query("names", sql(JALALI, f"""
SELECT o_orderkey AS id, {MONTHS}[jm] AS month_name,
  {WEEKDAYS}[dayofweek(CAST(o_orderdate AS DATE)) + 1] AS weekday_name
FROM orders JOIN jcal ON d = CAST(o_orderdate AS DATE)"""))
def names(spark, folder):
    day = F.to_date("o_orderdate")
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), cal.month_name(cal.jalali_month(day)).alias("month_name"),
        cal.weekday_name(day).alias("weekday_name"))


@query("jalali_to_date", sql(JALALI, """
orders_j AS (SELECT o_orderkey AS id, 1370 + o_orderkey % 40 AS y, 1 + o_custkey % 12 AS m, 1 + o_orderkey % 29 AS dd FROM orders)""", """
SELECT id, d AS day FROM orders_j JOIN jcal ON jy = y AND jm = m AND jd = dd"""))
def jalali_to_date(spark, folder):
    key = F.col("o_orderkey")
    return scan(spark, folder, "orders").select(
        key.alias("id"),
        cal.jalali_to_date(1370 + key % 40, 1 + F.col("o_custkey") % 12, 1 + key % 29).alias("day"))


@query("parse_any_date", sql(JALALI, """
texts AS (SELECT o_orderkey AS id, o_orderstatus, CAST(o_orderdate AS DATE) AS g,
  1370 + o_orderkey % 40 AS y, 1 + o_orderkey % 12 AS m, 1 + o_orderkey % 29 AS dd FROM orders)""", """
SELECT id, CASE o_orderstatus WHEN 'F' THEN CASE WHEN year(g) >= 2000 THEN g ELSE early.d + CAST(day(g) - 1 AS INTEGER) END
  WHEN 'O' THEN typed.d END AS day
FROM texts JOIN jcal typed ON typed.jy = y AND typed.jm = m AND typed.jd = dd
LEFT JOIN jcal early ON early.jy = year(g) AND early.jm = month(g) AND early.jd = 1"""))
def parse_any_date(spark, folder):
    return site.date_texts(spark, folder).select("id", cal.parse_any_date(F.col("txt")).alias("day"))


@query("sat_week", """
SELECT o_orderkey AS id, CAST((dayofweek(o_orderdate) + 1) % 7 AS INTEGER) AS weekday FROM orders""")
def sat_week(spark, folder):
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), cal.sat_weekday(F.col("o_orderdate")).alias("weekday"))


@query("php_sub_months", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, n AS months,
  CAST(date_trunc('month', o_orderdate) - to_months(CAST(n AS INTEGER)) + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) AS DATE) AS earlier
FROM orders, (VALUES (1), (2), (5), (8), (11)) v(n)""")
def php_sub_months(spark, folder):
    pairs = F.array(*[F.struct(F.lit(n).alias("months"), cal.months_back(F.col("day"), n).alias("earlier"))
                      for n in (1, 2, 5, 8, 11)])
    return _days(spark, folder).select("day", F.inline(pairs))


BACK = """days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
cal AS (
  SELECT d, y0, y0 + CAST(len - 1 AS INTEGER) AS y1, d - CAST(jd - 1 AS INTEGER) AS m0,
    (max(d) OVER (PARTITION BY jy, jm)) AS m1 FROM jcal),
back AS (
  SELECT as_of, n, m0, m1 FROM days CROSS JOIN (VALUES (0), (1), (2), (5), (8), (11)) v(n)
  JOIN cal ON d = CAST(date_trunc('month', as_of) - to_months(CAST(n AS INTEGER)) + to_days(CAST(day(as_of) - 1 AS INTEGER)) AS DATE)),
base AS (SELECT as_of, y0, y1, m0, m1 FROM days JOIN cal ON d = as_of),
bounds AS (
  SELECT as_of, 'today' AS w, as_of AS lo, as_of AS hi FROM base
  UNION ALL SELECT as_of, 'yesterday', as_of - 1, as_of - 1 FROM base
  UNION ALL SELECT as_of, 'last7days', as_of - 6, as_of FROM base
  UNION ALL SELECT as_of, 'last30days', as_of - 29, as_of FROM base
  UNION ALL SELECT as_of, 'thisweek', as_of - CAST((dayofweek(as_of) + 1) % 7 AS INTEGER),
    as_of - CAST((dayofweek(as_of) + 1) % 7 AS INTEGER) + 6 FROM base
  UNION ALL SELECT as_of, 'thismonth', m0, m1 FROM base
  UNION ALL SELECT as_of, 'lastmonth', m0, m1 FROM back WHERE n = 1
  UNION ALL SELECT b.as_of, 'last' || CASE n WHEN 11 THEN 12 WHEN 8 THEN 9 WHEN 5 THEN 6 WHEN 2 THEN 3 ELSE 2 END || 'month', b.m0, base.m1
    FROM back b JOIN base USING (as_of) WHERE n > 0
  UNION ALL SELECT as_of, 'spring', y0, y0 + 92 FROM base
  UNION ALL SELECT as_of, 'summer', y0 + 93, y0 + 185 FROM base
  UNION ALL SELECT as_of, 'fall', y0 + 186, y0 + 275 FROM base
  UNION ALL SELECT as_of, 'winter', y0 + 276, y1 FROM base
  UNION ALL SELECT as_of, 'thisyear', y0, y1 FROM base)"""


@query("window_bounds", sql(JALALI, BACK, """
SELECT as_of, w AS "window", lo, hi, CAST(hi - lo + 1 AS INTEGER) AS days,
  CAST(CASE WHEN w IN ('today', 'yesterday') THEN 24 ELSE hi - lo + 1 END AS INTEGER) AS divisor FROM bounds"""))
def window_bounds(spark, folder):
    return w.bounds_of(_days(spark, folder), "day")
