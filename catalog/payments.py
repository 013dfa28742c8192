"""Requests, settlement, corrections and routing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import ORACLES, query
from catalog.reports import OFFSET
from catalog.views import (ACTIVE, CALLBACKS, CUSTOM, CUSTOM_META, ENTRIES, FEEDS, FORMS, JALALI, LEADS, MATCHED, MESSAGES, META,
                           ORDER_TOTALS, sql)
from tollbook.operators import entries as en, hooks as hk, keyed, settle as s, transitions as tr
from tollbook.operators.totals import order_totals
from tollbook.plans import payments as pay
from tollbook.plans.colocated import settle_colocated as colocated, write_lead_tables
from tollbook.session import new_path
from tollbook.sources import site
from tollbook.sources.tables import append_batch, kept, read_batches


def _totals(spark, folder):
    return order_totals(site.order_lines(spark, folder))


def _started(spark, folder):
    return pay.start_payments(site.entries(spark, folder), site.feeds(spark, folder), _totals(spark, folder))


def _settled(spark, folder, settings=pay.AMOUNT_SETTINGS):
    return pay.settle_callbacks(site.callbacks(spark, folder), site.entries(spark, folder),
                                site.lead_meta(spark, folder), site.feeds(spark, folder), _totals(spark, folder),
                                settings=settings)


STARTED = """started AS (
  SELECT e.id, e.form_id, e.currency, e.input_5_3, e.input_6, e.input_7, a.id AS feed_id, a.type, a.desc_pm, a.mobile_field,
    e.payment_method, e.payment_status, e.is_fulfilled, e.transaction_type, e.transaction_id, e.payment_amount, e.payment_date,
    CASE WHEN a.id IS NULL THEN NULL
      WHEN a.floor_policy IS NOT NULL AND coalesce(total, 0) > 0 AND total < CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END
        THEN CASE a.floor_policy WHEN 'sadt' THEN CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END ELSE 0 END
      ELSE coalesce(total, 0) END AS due
  FROM entries e LEFT JOIN active a ON a.entry_id = e.id LEFT JOIN order_totals o ON o.lead_id = e.id)"""


@query("open_requests", sql(LEADS, ENTRIES, FEEDS, ACTIVE, ORDER_TOTALS, STARTED, """
SELECT id, feed_id, CASE WHEN feed_id IS NULL THEN 'untouched' WHEN due = 0 THEN 'free' ELSE 'pay' END AS path,
  CAST(due AS DOUBLE) AS amount_due,
  CASE WHEN feed_id IS NULL THEN payment_method ELSE 'gateway' END AS payment_method,
  CASE WHEN feed_id IS NULL THEN payment_status ELSE 'Processing' END AS payment_status,
  CASE WHEN feed_id IS NULL THEN is_fulfilled ELSE 0 END AS is_fulfilled,
  CASE WHEN feed_id IS NULL THEN transaction_type WHEN type = 'subscription' THEN 2 ELSE 1 END AS transaction_type,
  CASE WHEN feed_id IS NULL THEN transaction_id END AS transaction_id,
  CASE WHEN feed_id IS NULL THEN CAST(payment_amount AS DOUBLE) END AS payment_amount,
  CASE WHEN feed_id IS NULL THEN payment_date END AS payment_date
FROM started"""))
def open_requests(spark, folder):
    return _started(spark, folder).select(
        "id", F.col("feed.id").alias("feed_id"), "path", F.col("amount_due").cast("double"), "payment_method",
        "payment_status", "is_fulfilled", "transaction_type", "transaction_id",
        F.col("payment_amount").cast("double"), "payment_date")


@query("request_attributes", sql(LEADS, ENTRIES, META, FEEDS, ACTIVE, """
fresh AS (SELECT entry_id AS lead_id, 'feed_id' AS meta_key, CAST(id AS VARCHAR) AS meta_value FROM active
  UNION ALL SELECT entry_id, 'payment_type', 'form' FROM active
  UNION ALL SELECT entry_id, 'payment_gateway', 'Gateway' FROM active)""", """
SELECT m.* FROM lead_meta m WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.lead_id = m.lead_id AND f.meta_key = m.meta_key)
UNION ALL SELECT * FROM fresh"""))
def request_attributes(spark, folder):
    """The attribute table after all payments were started."""
    fresh = s.request_attributes(_started(spark, folder), "Gateway")
    return keyed.upsert_meta(site.lead_meta(spark, folder), fresh)


@query("open_custom_requests", sql(LEADS, ENTRIES, """
SELECT (SELECT max(id) FROM entries) + row_number() OVER (ORDER BY id) AS id, id AS from_id, form_id,
  CAST(input_2 AS DOUBLE) AS amount_due, 'Processing' AS payment_status, 1 AS transaction_type, 0 AS is_fulfilled,
  'gateway' AS payment_method, CAST(NULL AS TIMESTAMP) AS payment_date
FROM entries WHERE input_1 = '1-URGENT'"""))
def open_custom_requests(spark, folder):
    """Custom payments become new entries, numbered on from the largest id."""
    entries = site.entries(spark, folder)
    known = pay.with_meta(entries, site.lead_meta(spark, folder), ("payment_type", "part_price"))
    opened = s.open_custom_requests(known.where(F.col("payment_type") == "custom"))
    fresh = keyed.number_rows(opened.withColumnRenamed("id", "from_id"), "from_id", "id", keyed.largest(entries, "id"))
    return fresh.select("id", "from_id", "form_id", F.col("amount_due").cast("double"), "payment_status",
                        "transaction_type", "is_fulfilled", "payment_method", "payment_date")


def _custom(spark, folder):
    return pay.start_custom_payments(site.entries(spark, folder), site.custom_meta(spark, folder))


@query("custom_request_payload", sql(LEADS, ENTRIES, CUSTOM, """
SELECT a.id, from_id, CAST(input_2 AS DOUBLE) AS amount, CASE WHEN o_orderstatus = 'O' THEN 'Custom ' || from_id ELSE '' END AS description,
  CASE WHEN o_orderstatus = 'F' THEN 'payer' || o_custkey || '@example.com' ELSE '' END AS email,
  '+98' || lpad(CAST(o_custkey AS VARCHAR), 10, '9') AS mobile
FROM asked a JOIN entries e ON e.id = from_id JOIN orders ON o_orderkey = from_id"""))
def custom_request_payload(spark, folder):
    """The requests of custom payments, from attributes that are named after forms."""
    opened = _custom(spark, folder)
    payload = s.custom_payload(opened).withColumn("amount", F.col("amount").cast("double"))
    return payload.join(opened.select("id", "from_id"), "id")


@query("custom_request_attributes", sql(META, CUSTOM_META, CUSTOM, """
SELECT * FROM lead_meta
UNION ALL SELECT id, 'payment_gateway', 'Gateway' FROM asked UNION ALL SELECT id, 'payment_type', 'custom' FROM asked
UNION ALL SELECT id, meta_key, meta_value FROM asked JOIN custom_meta ON lead_id = from_id"""))
def custom_request_attributes(spark, folder):
    """The attribute table with those of the new entries."""
    return keyed.upsert_meta(site.lead_meta(spark, folder), s.custom_attributes(_custom(spark, folder), "Gateway"))


@query("custom_settle", sql(LEADS, ENTRIES.replace("entries AS", "old_entries AS", 1), CUSTOM, """entries AS (
  SELECT e.* REPLACE (asked.id AS id, 'Processing' AS payment_status, 'gateway' AS payment_method, NULL AS payment_date)
  FROM old_entries e JOIN asked ON from_id = e.id)""", FEEDS, ORDER_TOTALS, CALLBACKS.replace("callbacks AS", "calls AS", 1), """
callbacks AS (SELECT c.* REPLACE (asked.id AS lead_id) FROM calls c JOIN asked ON from_id = lead_id)""", MESSAGES, MATCHED, """
SELECT lead_id, outcome, is_free, ts AS payment_date, payment_status AS before, new_status, CAST(new_amount AS DOUBLE) AS new_amount,
  new_fulfilled, new_method, new_transaction_id, new_transaction_type, message FROM settled"""))
def custom_settle(spark, folder):
    """Custom payments to the end: new entries, their attributes, and the callbacks that settle them."""
    opened = _custom(spark, folder)
    entries = opened.select(*site.entries(spark, folder).columns)
    calls = site.callbacks(spark, folder).withColumnRenamed("lead_id", "from_id").join(
        opened.select("id", "from_id"), "from_id").withColumnRenamed("id", "lead_id").drop("from_id")
    return payment_records(pay.settle_callbacks(calls, entries, s.custom_attributes(opened, "Gateway"),
                                                site.feeds(spark, folder), _totals(spark, folder)))


@query("unset_projection", sql(LEADS, """
SELECT id, form_id, payment_method, CAST(NULL AS VARCHAR) AS payment_status, CAST(NULL AS VARCHAR) AS transaction_id,
  CAST(NULL AS INTEGER) AS transaction_type, CAST(NULL AS INTEGER) AS is_fulfilled, CAST(NULL AS TIMESTAMP) AS payment_date,
  CAST(NULL AS DOUBLE) AS payment_amount FROM leads"""))
def unset_projection(spark, folder):
    cleared = s.clear_payment(site.leads(spark, folder))
    return cleared.select("id", "form_id", "payment_method", "payment_status", "transaction_id", "transaction_type",
                          "is_fulfilled", "payment_date", F.col("payment_amount").cast("double"))


@query("request_payload", sql(LEADS, ENTRIES, FEEDS, FORMS, ACTIVE, ORDER_TOTALS, STARTED, """
texts AS (SELECT s.*, replace(replace(replace(desc_pm, '{entry_id}', CAST(s.id AS VARCHAR)), '{form_title}', title),
    '{form_id}', CAST(form_id AS VARCHAR)) AS filled, CASE WHEN feed_id % 2 = 0 OR input_7 = '0' THEN '' ELSE input_7 END AS said,
    CASE WHEN mobile_field = '6' THEN input_6 ELSE '' END AS raw
  FROM started s JOIN forms ON forms.id = form_id WHERE feed_id IS NOT NULL AND due <> 0),
numbers AS (SELECT *, regexp_replace(raw, '[^0-9]', '', 'g') AS n FROM texts)""", """
SELECT id, CAST(CASE WHEN currency = 'IRT' THEN due ELSE due / 10 END AS DOUBLE) AS amount,
  CASE WHEN coalesce(filled, '') <> '' AND said <> '' THEN filled || ' - ' || said WHEN coalesce(filled, '') <> '' THEN filled
    WHEN said <> '' THEN said ELSE ' ' END AS description,
  CASE WHEN feed_id % 2 = 1 THEN input_5_3 ELSE '' END AS email,
  CASE WHEN raw = '' THEN '' WHEN contains(raw, '+') OR contains(raw, '%2B') THEN '+' || n
    WHEN n[1:2] = '00' THEN '+' || n[3:] WHEN n[1:1] = '0' THEN n ELSE '0' || n END AS mobile
FROM numbers"""))
def request_payload(spark, folder):
    requests = pay.payment_requests(site.entries(spark, folder), site.feeds(spark, folder), site.forms(spark, folder),
                                    _totals(spark, folder))
    return requests.withColumn("amount", F.col("amount").cast("double"))


@query("request_failure", sql(LEADS, MESSAGES, """
replies AS (SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN -22
  WHEN '3-MEDIUM' THEN 100 WHEN '4-NOT SPECIFIED' THEN -2 ELSE 55 END AS reply FROM orders)""", """
SELECT id, CASE WHEN reply <> 100 THEN 'Failed' ELSE payment_status END AS payment_status,
  CASE WHEN reply <> 100 THEN coalesce(message, ' ') END AS message,
  CASE WHEN reply <> 100 THEN 'خطا در اتصال به درگاه رخ داده است : ' || coalesce(message, ' ') END AS note
FROM leads JOIN replies USING (id) LEFT JOIN messages ON code = reply"""))
def request_failure(spark, folder):
    replied = s.apply_replies(site.leads(spark, folder), site.request_replies(spark, folder), "Gateway")
    return replied.select("id", "payment_status", "message", "note")


@query("callback_outcome", sql(CALLBACKS, MESSAGES, """
SELECT lead_id, event_id, ts, CASE WHEN no_arg = 'true' THEN 'completed'
    WHEN lower(status_arg) = 'ok' AND result_code = 100 THEN 'completed' WHEN lower(status_arg) = 'ok' THEN 'failed' ELSE 'cancelled' END AS outcome,
  no_arg = 'true' AS is_free,
  CASE WHEN no_arg <> 'true' AND lower(status_arg) = 'ok' AND result_code <> 100 THEN coalesce(message, ' ') ELSE '' END AS message
FROM callbacks LEFT JOIN messages ON code = result_code"""))
def callback_outcome(spark, folder):
    return s.with_outcome(site.callbacks(spark, folder), "Gateway").select(
        "lead_id", "event_id", "ts", "outcome", "is_free", "message")


@query("first_settlement", """
SELECT user_id AS lead_id, event_id, ts FROM events WHERE user_id <> 0
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def first_settlement(spark, folder):
    """Events as callbacks: few leads with very many callbacks each."""
    from tollbook.sources.tables import scan

    calls = site.event_callbacks(scan(spark, folder, "events"))
    return s.first_callbacks(calls).select("lead_id", "event_id", "ts")


@query("callback_enrich", sql(LEADS, ENTRIES, FEEDS, FORMS, CALLBACKS, """
SELECT c.event_id, c.lead_id, c.ts, e.form_id, title AS form_title, e.payment_status, f.id AS feed_id, f.type AS feed_type
FROM callbacks c JOIN entries e ON e.id = c.lead_id AND e.payment_method = 'gateway'
LEFT JOIN feeds f ON f.id = e.form_id * 2 + 1 LEFT JOIN forms ON forms.id = e.form_id"""))
def callback_enrich(spark, folder):
    joined = pay.enrich_callbacks(site.callbacks(spark, folder), site.entries(spark, folder),
                                  site.lead_meta(spark, folder), site.feeds(spark, folder), site.forms(spark, folder))
    return joined.select("event_id", "lead_id", "ts", "form_id", "form_title", "payment_status", F.col("feed.id").alias("feed_id"),
                         F.col("feed.type").alias("feed_type"))


# The audit note texts, status labels and the guest's name in the SQL below are fixed values.
BASE = (LEADS, ENTRIES, FEEDS, ORDER_TOTALS, CALLBACKS, MESSAGES, MATCHED)


@query("settle", sql(*BASE, """
SELECT lead_id, outcome, is_free, ts AS payment_date, payment_status AS before, new_status, CAST(new_amount AS DOUBLE) AS new_amount,
  new_fulfilled, new_method, new_transaction_id, new_transaction_type, message FROM settled"""))
def settle(spark, folder):
    return payment_records(_settled(spark, folder))


def payment_records(settled):
    return settled.select(
        "lead_id", "outcome", "is_free", F.col("ts").alias("payment_date"), F.col("payment_status").alias("before"),
        "new_status", F.col("new_amount").cast("double"), "new_fulfilled", "new_method", "new_transaction_id",
        "new_transaction_type", "message")


@query("settle_colocated", ORACLES["settle"])
def settle_colocated(spark, folder):
    """The same over tables that are kept bucketed by lead."""
    tables = write_lead_tables(site.entries(spark, folder), site.lead_meta(spark, folder), site.order_lines(spark, folder),
                               f"tollbook_{uuid.uuid4().hex}", new_path(spark, "by-lead"))
    return payment_records(colocated(site.callbacks(spark, folder), tables, site.feeds(spark, folder)))


@query("settled_entries", sql(*BASE, """
SELECT e.id, CASE WHEN s.lead_id IS NULL THEN e.payment_status ELSE new_status END AS payment_status,
  CAST(CASE WHEN s.lead_id IS NULL THEN e.payment_amount ELSE new_amount END AS DOUBLE) AS payment_amount,
  CASE WHEN s.lead_id IS NULL THEN e.is_fulfilled ELSE new_fulfilled END AS is_fulfilled,
  CASE WHEN s.lead_id IS NULL THEN e.payment_date ELSE s.ts END AS payment_date,
  CASE WHEN s.lead_id IS NULL THEN e.transaction_id ELSE new_transaction_id END AS transaction_id
FROM entries e LEFT JOIN settled s ON s.lead_id = e.id"""))
def settled_entries(spark, folder):
    after = pay.settled_entries(site.entries(spark, folder), _settled(spark, folder))
    return after.select("id", "payment_status", F.col("payment_amount").cast("double"), "is_fulfilled",
                        "payment_date", "transaction_id")


@query("settled_attributes", sql(*BASE, META, """
visited AS (SELECT DISTINCT lead_id FROM callbacks JOIN entries ON id = lead_id WHERE payment_method = 'gateway' AND lead_id <> 0)""", """
SELECT m.* FROM lead_meta m LEFT JOIN settled s ON s.lead_id = m.lead_id LEFT JOIN visited v ON v.lead_id = m.lead_id
WHERE NOT (v.lead_id IS NOT NULL AND m.meta_key = 'payment_type') AND NOT (s.lead_id IS NOT NULL AND m.meta_key = 'payment_gateway' AND s.is_free)"""))
def settled_attributes(spark, folder):
    """The attribute table after settlement; the payment type goes with any callback, the gateway with a free payment."""
    gone = s.settled_attribute_keys(_settled(spark, folder)).unionByName(
        s.visited_attribute_keys(site.callbacks(spark, folder), site.entries(spark, folder)))
    return keyed.delete_meta(site.lead_meta(spark, folder), gone)


@query("settle_notes", sql(*BASE, """
money AS (SELECT *, format('{:,.2f}', CAST(total AS DOUBLE)) || ' ' || currency AS due,
  new_transaction_type = 2 AND outcome = 'completed' AS activated FROM settled),
notes AS (SELECT lead_id, activated, CASE WHEN is_free THEN 'وضعیت پرداخت : رایگان - بدون نیاز به درگاه پرداخت'
    WHEN outcome = 'completed' THEN 'وضعیت پرداخت : موفق - مبلغ پرداختی : ' || due || ' - کد تراکنش : ' || new_transaction_id
    WHEN outcome = 'cancelled' THEN 'وضعیت پرداخت : منصرف شده - مبلغ قابل پرداخت : ' || due || ' - کد تراکنش : ' || new_transaction_id
    ELSE 'وضعیت پرداخت : ناموفق - مبلغ قابل پرداخت : ' || due || ' - کد تراکنش : ' || new_transaction_id || ' - علت خطا : ' || message END AS text
  FROM money)""", """
SELECT lead_id, CASE WHEN activated THEN 1 ELSE 0 END AS position, text FROM notes
UNION ALL SELECT lead_id, 0, 'تغییرات اطلاعات فیلدها فقط در همین پیام ورودی اعمال خواهد شد و بر روی وضعیت کاربر تاثیری نخواهد داشت .'
FROM notes WHERE activated"""))
def settle_notes(spark, folder):
    return s.settlement_notes(_settled(spark, folder))


@query("transition_summary", sql(*BASE, """
SELECT payment_status AS before, new_status AS after, count(*) AS payments, CAST(sum(new_amount) AS DOUBLE) AS amount
FROM settled GROUP BY ALL"""))
def transition_summary(spark, folder):
    return s.transition_summary(_settled(spark, folder))


CORRECTED = """corrections AS (
  SELECT c_custkey AS cid, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Paid' WHEN 'BUILDING' THEN 'Cancelled' WHEN 'FURNITURE' THEN ''
      WHEN 'HOUSEHOLD' THEN 'Active' ELSE 'Failed' END AS new_status, CAST(c_acctbal AS DECIMAL(19,2)) AS new_amount,
    'M' || c_custkey AS new_txn, c_mktsegment <> 'HOUSEHOLD' AS dated, c_nationkey AS n FROM customer),
merged AS (
  SELECT e.*, cid IS NOT NULL AND payment_method = 'gateway' AS corrected, new_amount, new_txn,
    CASE WHEN new_status = '' THEN payment_status ELSE new_status END AS status2,
    CASE WHEN dated THEN d + to_hours(CAST(n % 24 AS INTEGER)) + INTERVAL '15 minutes 30 seconds' - INTERVAL '210 minutes'
      ELSE coalesce(payment_date, date_created) END AS date2
  FROM entries e LEFT JOIN corrections ON cid = e.id LEFT JOIN jcal ON jy = 1380 AND jm = 1 + n % 12 AND jd = 1 + n)"""


def _corrected(spark, folder):
    return s.correct_payments(site.entries(spark, folder), site.corrections(spark, folder), OFFSET)


# Requests that were sent, and whether the gateway refused them, with what their feed selected.
SENT = """sent AS (
  SELECT s.id AS lead_id, a.form_id, s.due, a.notif_1, a.notif_3, CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN -22
    WHEN '3-MEDIUM' THEN 100 WHEN '4-NOT SPECIFIED' THEN -2 ELSE 55 END AS reply
  FROM started s JOIN active a ON a.entry_id = s.id JOIN orders ON o_orderkey = s.id WHERE due <> 0)"""
LOGGED = (*BASE, ACTIVE, STARTED, SENT)


def _logged(spark, folder):
    """The log after requests, replies, settlements and corrections, each logged twice."""
    opened = pay.start_payments(site.entries(spark, folder), site.feeds(spark, folder), _totals(spark, folder),
                                settings=pay.NOTIFICATION_SETTINGS)
    corrected = _corrected(spark, folder).withColumns({"user_id": F.lit(7), "user_name": F.lit("editor")})
    # Both requests and replies are made from what was opened, and all events are logged twice: each is made once and kept.
    opened = kept(opened.select("id", "form_id", "path", "payment_status", "amount_due", "feed"), new_path(spark, "opened"))
    table = tr.event_table(new_path(spark, "transitions"))
    events = (tr.request_events(opened)
              .unionByName(tr.reply_events(opened, site.request_replies(spark, folder), "Gateway"))
              .unionByName(tr.settlement_events(_settled(spark, folder, pay.NOTIFICATION_SETTINGS)))
              .unionByName(tr.correction_events(corrected, F.lit("1380"))))
    events = kept(events, new_path(spark, "events"))
    for batch in range(2):
        tr.log_events(events, table, batch)
    return tr.read_events(spark, table)


@query("transition_log", sql(*LOGGED, JALALI, CORRECTED, """
SELECT lead_id, 'request' AS kind, NULL AS before, 'Processing' AS after, CAST(due AS DOUBLE) AS amount, 'submit' AS route, 0 AS user_id,
  'مهمان' AS user_name, 0 AS n_notes FROM sent
UNION ALL SELECT lead_id, 'reply', 'Processing', 'Failed', CAST(due AS DOUBLE), 'failed', 0, 'مهمان', 1 FROM sent WHERE reply <> 100
UNION ALL SELECT lead_id, 'settlement', payment_status, new_status, CAST(new_amount AS DOUBLE), CASE WHEN NOT custom THEN outcome END, 0,
  'مهمان', CASE WHEN new_transaction_type = 2 AND outcome = 'completed' THEN 2 ELSE 1 END FROM settled
UNION ALL SELECT id, 'correction', NULL, status2, CAST(new_amount AS DOUBLE), NULL, 7, 'editor', 1 FROM merged WHERE corrected"""))
def transition_log(spark, folder):
    return _logged(spark, folder).select(
        "lead_id", "kind", "before", "after", F.col("amount").cast("double"), "route", F.col("user_id").cast("int"), "user_name",
        F.when(F.col("notes").isNull(), 0).otherwise(F.size("notes")).alias("n_notes"))


@query("note_log", sql(*LOGGED, """
SELECT lead_id, 0 AS user_id, 'مهمان' AS user_name, 'خطا در اتصال به درگاه رخ داده است : ' || coalesce(message, ' ') AS text
FROM sent LEFT JOIN messages ON code = reply WHERE reply <> 100"""))
def note_log(spark, folder):
    """The notes that refused requests leave, and by whom."""
    noted = tr.notes(_logged(spark, folder)).where(F.col("kind") == "reply")
    return noted.select("lead_id", F.col("user_id").cast("int"), "user_name", "text")


@query("notify_route", sql(*LOGGED, """
SELECT lead_id, 'submit' AS route, n AS notification_id FROM sent, (VALUES ('n1'), ('n2'), ('n3')) v(n) WHERE list_contains(notif_1, n)
UNION ALL SELECT lead_id, 'failed', n FROM sent, (VALUES ('n1'), ('n2'), ('n3')) v(n) WHERE reply <> 100 AND list_contains(notif_3, n)
UNION ALL SELECT lead_id, outcome, n FROM settled, (VALUES ('n1'), ('n2'), ('n3')) v(n)
WHERE NOT custom AND list_contains(CASE outcome WHEN 'completed' THEN notif_2 WHEN 'failed' THEN notif_3 ELSE notif_4 END, n)"""))
def notify_route(spark, folder):
    """What is sent at the request, when it is refused and when it is settled."""
    return tr.notifications(_logged(spark, folder), site.forms(spark, folder))


@query("transition_counts", sql(*LOGGED, JALALI, CORRECTED, """
events AS (SELECT 'request' AS kind, NULL AS before, 'Processing' AS after, due AS amount FROM sent
  UNION ALL SELECT 'reply', 'Processing', 'Failed', due FROM sent WHERE reply <> 100
  UNION ALL SELECT 'settlement', payment_status, new_status, new_amount FROM settled
  UNION ALL SELECT 'correction', NULL, status2, new_amount FROM merged WHERE corrected)""", """
SELECT kind, before, after, count(*) AS events, CAST(sum(amount) AS DOUBLE) AS amount FROM events GROUP BY ALL"""))
def transition_counts(spark, folder):
    return tr.transitions(_logged(spark, folder))


def _hooks():
    """Hooks on the amount of any request and of one form's, on the feeds that may be chosen, and on what is sent."""
    return (hk.Hooks().on("order_total", lambda total: total + 10).on("price", lambda due: due * 2)
            .on("price_7", lambda due: due - 1).on("form_price", lambda due: due + 1)
            .on("feeds", lambda feeds: feeds.where("id % 4 <> 3")).on("entry_feed", lambda feeds: feeds.where("id % 8 <> 5"))
            .on("transaction_id", lambda txn: F.concat(F.lit("H"), txn))
            .on("send_notification", lambda n, status: (n != "n3") | (status == "cancelled")))


HOOKED = ACTIVE.replace("FROM feeds WHERE is_active = 1", "FROM feeds WHERE is_active = 1 AND id % 4 <> 3")


@query("hooked_requests", sql(LEADS, ENTRIES, FEEDS, HOOKED, ORDER_TOTALS, """
charged AS (SELECT e.id, e.form_id, a.id AS feed_id, 10 + CASE WHEN a.floor_policy IS NOT NULL AND coalesce(total, 0) > 0
      AND total < CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END
      THEN CASE a.floor_policy WHEN 'sadt' THEN CASE currency WHEN 'IRR' THEN 1000 ELSE 100 END ELSE 0 END
    ELSE coalesce(total, 0) END AS due
  FROM entries e LEFT JOIN active a ON a.entry_id = e.id LEFT JOIN order_totals o ON o.lead_id = e.id),
asked AS (SELECT *, (due + 1) * 2 - CASE WHEN form_id = 7 THEN 1 ELSE 0 END AS asked FROM charged)""", """
SELECT id, feed_id, CASE WHEN feed_id IS NULL THEN 'untouched' WHEN asked = 0 THEN 'free' ELSE 'pay' END AS path,
  CAST(CASE WHEN feed_id IS NOT NULL THEN asked END AS DOUBLE) AS amount_due FROM asked"""))
def hooked_requests(spark, folder):
    """Started payments whose feed and amount hooks change."""
    started = pay.start_payments(site.entries(spark, folder), site.feeds(spark, folder), _totals(spark, folder), hooks=_hooks())
    return started.select("id", F.col("feed.id").alias("feed_id"), "path", F.col("amount_due").cast("double"))


@query("hooked_routes", sql(LEADS, ENTRIES, FEEDS.replace("feeds AS", "all_feeds AS", 1), "feeds AS (SELECT * FROM all_feeds WHERE id % 8 <> 5)",
                            ORDER_TOTALS, CALLBACKS, MESSAGES, MATCHED, """
SELECT lead_id, outcome, n AS notification_id, 'H' || new_transaction_id AS new_transaction_id,
  CAST(CASE WHEN is_free THEN NULL WHEN outcome = 'completed' THEN new_amount + 10 ELSE 0 END AS DOUBLE) AS new_amount
FROM settled, (VALUES ('n1'), ('n2'), ('n3')) v(n)
WHERE NOT custom AND (n <> 'n3' OR outcome = 'cancelled')
  AND list_contains(CASE outcome WHEN 'completed' THEN notif_2 WHEN 'failed' THEN notif_3 ELSE notif_4 END, n)"""))
def hooked_routes(spark, folder):
    """Settlements and their notifications, with hooks on the feed of an entry, its total, the transaction id and the route."""
    settled = pay.settle_callbacks(site.callbacks(spark, folder), site.entries(spark, folder), site.lead_meta(spark, folder),
                                   site.feeds(spark, folder), _totals(spark, folder), settings=pay.NOTIFICATION_SETTINGS,
                                   hooks=_hooks())
    sent = pay.route_notifications(settled, site.forms(spark, folder), _hooks())
    return sent.join(settled.select("lead_id", "outcome", "new_transaction_id", F.col("new_amount").cast("double")), "lead_id").select(
        "lead_id", "outcome", "notification_id", "new_transaction_id", "new_amount")


@query("confirmation_route", sql(*BASE, """
chosen AS (SELECT lead_id, outcome, input_1, CAST(input_2 AS DOUBLE) AS input_2, c_mktsegment, c_acctbal,
    CASE outcome WHEN 'completed' THEN conf_1 WHEN 'failed' THEN conf_2 ELSE conf_3 END AS picked
  FROM settled JOIN customer ON c_custkey = form_id WHERE NOT custom)""", """
SELECT lead_id, outcome, CASE WHEN c_acctbal < 1000 THEN 'c1'
  WHEN list_contains(picked, 'c2') AND c_mktsegment <> 'BUILDING' AND input_2 > 200000 THEN 'c2'
  WHEN list_contains(picked, 'c3') AND contains(lower(input_1), 'h') THEN 'c3' ELSE 'c1' END AS confirmation_id
FROM chosen"""))
def confirmation_route(spark, folder):
    return pay.route_confirmations(_settled(spark, folder, pay.CONFIRMATION_SETTINGS), site.forms(spark, folder))


@query("post_status_update", sql(*BASE, FORMS, """
decided AS (SELECT post_id, CASE WHEN update_post_action1 IN ('publish', 'draft', 'pending', 'private') THEN update_post_action1
    ELSE post_status END AS new_status
  FROM settled JOIN forms ON forms.id = form_id WHERE outcome = 'completed' AND NOT custom AND post_id IS NOT NULL),
posts AS (SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'publish'
  WHEN '3-MEDIUM' THEN 'draft' WHEN '4-NOT SPECIFIED' THEN 'private' ELSE 'publish' END AS status FROM orders)""", """
SELECT id, coalesce(new_status, status) AS post_status, coalesce(new_status <> status, FALSE) AS changed
FROM posts LEFT JOIN decided ON post_id = id"""))
def post_status_update(spark, folder):
    decided = pay.decide_post_status(_settled(spark, folder, pay.POST_SETTINGS), site.forms(spark, folder))
    return en.update_post_status(site.posts(spark, folder), decided)


@query("entry_detail", sql(LEADS, ENTRIES, ORDER_TOTALS, JALALI, """
shown AS (SELECT e.id, payment_status, payment_date + INTERVAL '210 minutes' AS local, transaction_id, currency,
    CASE WHEN payment_amount = 0 THEN coalesce(total, 0) ELSE payment_amount END AS amount
  FROM entries e LEFT JOIN order_totals o ON o.lead_id = e.id WHERE payment_method = 'gateway')""", """
SELECT id, CASE payment_status WHEN 'Cancelled' THEN 'منصرف شده' WHEN 'Failed' THEN 'ناموفق' WHEN 'Processing' THEN 'معلق' ELSE 'موفق' END AS status_label,
  CASE WHEN local IS NULL THEN NULL ELSE jy || '-' || lpad(CAST(jm AS VARCHAR), 2, '0') || '-' || lpad(CAST(jd AS VARCHAR), 2, '0')
    || ' ' || strftime(local, '%H:%M:%S') END AS local_date,
  format('{:,.2f}', CAST(amount AS DOUBLE)) || ' ' || currency AS amount_text, transaction_id
FROM shown LEFT JOIN jcal ON d = CAST(local AS DATE)"""))
def entry_detail(spark, folder):
    return en.entry_detail(site.entries(spark, folder), _totals(spark, folder), OFFSET)


@query("apply_corrections", sql(LEADS, ENTRIES, JALALI, CORRECTED, """
SELECT id, corrected, CASE WHEN corrected THEN status2 ELSE payment_status END AS payment_status,
  CAST(CASE WHEN corrected THEN new_amount ELSE payment_amount END AS DOUBLE) AS payment_amount,
  CASE WHEN corrected THEN new_txn ELSE transaction_id END AS transaction_id,
  CASE WHEN corrected THEN date2 ELSE payment_date END AS payment_date,
  CASE WHEN corrected THEN CASE WHEN status2 IN ('Paid', 'Active') THEN 1 ELSE 0 END ELSE is_fulfilled END AS is_fulfilled
FROM merged"""))
def apply_corrections(spark, folder):
    return _corrected(spark, folder).select(
        "id", "corrected", "payment_status", F.col("payment_amount").cast("double"), "transaction_id", "payment_date",
        "is_fulfilled")


@query("append_notes", sql(LEADS, ENTRIES, JALALI, CORRECTED, """
SELECT id AS lead_id, 'اطلاعات تراکنش به صورت دستی ویرایش شد . وضعیت : ' ||
  CASE status2 WHEN 'Cancelled' THEN 'منصرف شده' WHEN 'Failed' THEN 'ناموفق' WHEN 'Processing' THEN 'معلق' ELSE 'موفق' END
  || ' - مبلغ : ' || format('{:,.2f}', CAST(new_amount AS DOUBLE)) || ' ' || currency || ' - کد رهگیری : ' || new_txn
  || ' - تاریخ : ' || strftime(date2, '%Y-%m-%d %H:%M:%S') AS text
FROM merged WHERE corrected"""))
def append_notes(spark, folder):
    """Notes of the corrections, appended to a note table twice: the replay must not double them."""
    path = new_path(spark, "notes")
    notes = s.correction_notes(_corrected(spark, folder))
    for _ in range(2):
        append_batch(notes, path, 0)
    return read_batches(spark, path, "lead_id bigint, text string").drop("batch")
