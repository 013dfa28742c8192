"""Money, text, status and emptiness columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import FEEDS, FORMS, LEADS, MESSAGES, sql
from tollbook.functions import money, status as st, text as tx, values as v
from tollbook.operators import hooks
from tollbook.operators.totals import paid
from tollbook.plans import payments as pay
from tollbook.sources import site
from tollbook.sources.tables import scan

AMOUNTS = """amounts AS (
  SELECT event_id AS id, CASE user_id % 3 WHEN 0 THEN 'IRR' WHEN 1 THEN 'IRT' ELSE 'USD' END AS currency,
    CASE event_type WHEN 'purchase' THEN 'sadt' WHEN 'signup' THEN 'raygan' WHEN 'view' THEN 'sadt' WHEN 'click' THEN 'raygan' END AS policy,
    event_type = 'error' AS custom,
    CAST(CASE event_type WHEN 'view' THEN -value WHEN 'purchase' THEN value * 4 ELSE value END AS DECIMAL(19,2)) AS total
  FROM events)"""


@query("currency_norm", sql(AMOUNTS, """
SELECT id, CAST(CASE WHEN currency = 'IRT' OR custom THEN total ELSE total / 10 END AS DOUBLE) AS amount FROM amounts"""))
def currency_norm(spark, folder):
    return site.amounts(spark, folder).select(
        "id", money.base_units(F.col("total"), F.col("currency"), F.col("custom")).cast("double").alias("amount"))


@query("min_amount_rule", sql(AMOUNTS, """
SELECT id, CAST(CASE WHEN total <= 0 THEN 0
  WHEN policy IS NOT NULL AND currency = 'IRR' AND total < 1000 THEN CASE policy WHEN 'sadt' THEN 1000 ELSE 0 END
  WHEN policy IS NOT NULL AND currency = 'IRT' AND total < 100 THEN CASE policy WHEN 'sadt' THEN 100 ELSE 0 END
  ELSE total END AS DOUBLE) AS amount FROM amounts"""))
def min_amount_rule(spark, folder):
    due = money.minimum_charge(F.col("total"), F.col("currency"), F.col("policy"))
    return site.amounts(spark, folder).select("id", due.cast("double").alias("amount"))


@query("format_money", sql(LEADS, """
SELECT id, format('{:,.2f}', CAST(payment_amount AS DOUBLE)) || ' ' || currency AS amount_text FROM leads"""))
def format_money(spark, folder):
    return site.leads(spark, folder).select(
        "id", money.money_text(F.col("payment_amount"), F.col("currency")).alias("amount_text"))


@query("format_avg", sql(LEADS, """
counts AS (SELECT form_id, count(*) AS n, 30 AS days FROM leads WHERE status = 'active' AND is_fulfilled = 1 GROUP BY form_id)""", """
SELECT form_id, CAST((n * 2000 + days) // (2 * days) // 1000 AS VARCHAR) || '.' ||
  lpad(CAST((n * 2000 + days) // (2 * days) % 1000 AS VARCHAR), 3, '0') AS average FROM counts"""))
def format_avg(spark, folder):
    counts = paid(site.leads(spark, folder)).groupBy("form_id").agg(F.count("id").alias("n"))
    average = F.col("n").cast("decimal(20,0)") / 30
    return counts.select("form_id", money.average_text(average).alias("average"))


@query("phone_norm", """
WITH phones AS (
  SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN '+98 ' WHEN 1 THEN '0098-' WHEN 2 THEN '0' WHEN 3 THEN '%2B98' WHEN 4 THEN 'tel: ' ELSE '' END
    || CASE WHEN c_custkey % 50 = 5 THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '9') END AS raw FROM customer),
digits AS (SELECT id, raw, regexp_replace(raw, '[^0-9]', '', 'g') AS n FROM phones)
SELECT id, raw, CASE WHEN raw IN ('', '0') THEN '' WHEN contains(raw, '+') OR contains(lower(raw), '%2b') THEN '+' || n
  WHEN n[1:2] = '00' THEN '+' || n[3:] WHEN n[1:1] = '0' THEN n ELSE '0' || n END AS phone FROM digits""")
def phone_norm(spark, folder):
    return site.phones(spark, folder).select("id", "raw", tx.phone(F.col("raw")).alias("phone"))


@query("digits_fa", sql(LEADS, """
SELECT id, translate(CAST(payment_amount AS VARCHAR), '0123456789', '۰۱۲۳۴۵۶۷۸۹') AS amount_text FROM leads"""))
def digits_fa(spark, folder):
    return site.leads(spark, folder).select(
        "id", tx.digits_fa(F.col("payment_amount").cast("string")).alias("amount_text"))


@query("status_label", sql(LEADS, """
SELECT id, CASE payment_status WHEN 'Paid' THEN 'موفق' WHEN 'Active' THEN 'موفق' WHEN 'Cancelled' THEN 'منصرف شده'
  WHEN 'Failed' THEN 'ناموفق' WHEN 'Processing' THEN 'معلق' END AS label FROM leads"""))
def status_label(spark, folder):
    return site.leads(spark, folder).select("id", st.status_label(F.col("payment_status")).alias("label"))


@query("txn_type", sql(FEEDS, "SELECT id, CASE type WHEN 'subscription' THEN 2 ELSE 1 END AS txn_type FROM feeds"))
def txn_type(spark, folder):
    kind = v.json_path(F.col("meta"), "type")
    return site.feeds(spark, folder).select("id", st.transaction_type(kind).alias("txn_type"))


@query("code_lookup", sql(MESSAGES, """
SELECT o_orderkey AS id, reply AS code, coalesce(message, ' ') AS message FROM (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN -22 WHEN '3-MEDIUM' THEN 100
    WHEN '4-NOT SPECIFIED' THEN -2 ELSE 55 END AS reply FROM orders) LEFT JOIN messages ON reply = messages.code"""))
def code_lookup(spark, folder):
    return site.request_replies(spark, folder).withColumn("message", st.code_message(F.col("code"), "Gateway"))


@query("post_status_map", sql(FEEDS, FORMS, """
SELECT f.id, CASE WHEN update_post_action1 IN ('publish', 'draft', 'pending', 'private') THEN update_post_action1 ELSE post_status END AS after_payment,
  CASE WHEN update_post_action2 IS NULL OR update_post_action2 IN ('', 'dont') THEN post_status
    WHEN update_post_action2 IN ('publish', 'draft', 'private') THEN update_post_action2 ELSE 'pending' END AS at_request
FROM feeds f JOIN forms ON forms.id = form_id"""))
def post_status_map(spark, folder):
    feeds = pay.with_form(site.feeds(spark, folder), site.forms(spark, folder), "post_status", how="inner")
    action = lambda n: v.json_path(F.col("meta"), f"update_post_action{n}")
    own = F.col("form_post_status")
    return feeds.select("id", st.post_status_after_payment(action(1), own).alias("after_payment"),
                        st.post_status_at_request(action(2), own).alias("at_request"))


@query("map_path", """
SELECT event_id AS id, coalesce(json_extract_string(props, '$.k'), '') AS found, '' AS missing,
  CAST(user_id AS VARCHAR) AS nested, '' AS nested_missing FROM events""")
def map_path(spark, folder):
    nested = F.create_map(F.lit("meta"), F.create_map(F.lit("user"), F.col("user_id").cast("string")))
    return scan(spark, folder, "events").select(
        F.col("event_id").alias("id"), v.json_path(F.col("props"), "k").alias("found"),
        v.json_path(F.col("props"), "k/deeper").alias("missing"), v.map_path(nested, "meta/user").alias("nested"),
        v.map_path(nested, "other/user").alias("nested_missing"))


@query("emptiness", """
WITH texts AS (SELECT o_orderkey AS id, o_custkey AS n, CASE o_orderpriority WHEN '1-URGENT' THEN 'x' WHEN '2-HIGH' THEN ''
  WHEN '3-MEDIUM' THEN '0' WHEN '4-NOT SPECIFIED' THEN NULL ELSE '0.0' END AS t, o_orderstatus = 'F' AS flag FROM orders)
SELECT id, t IS NULL OR t IN ('', '0') AS empty_text, t IS NULL OR t = '' AS blank_text, n = 0 AS empty_number,
  NOT flag AS empty_flag, NOT flag AS empty_list FROM texts""")
def emptiness(spark, folder):
    priority, flag = F.col("o_orderpriority"), F.col("o_orderstatus") == "F"
    text = (F.when(priority == "1-URGENT", "x").when(priority == "2-HIGH", "").when(priority == "3-MEDIUM", "0")
            .when(priority == "5-LOW", "0.0"))
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), v.is_empty_text(text).alias("empty_text"),
        v.is_blank_text(text).alias("blank_text"), v.is_empty_number(F.col("o_custkey")).alias("empty_number"),
        v.is_empty_flag(flag).alias("empty_flag"),
        v.is_empty_list(F.when(flag, F.array(F.col("o_custkey")))).alias("empty_list"))


@query("fill_template", sql(FORMS, """
SELECT o_orderkey AS id, 'Entry ' || o_orderkey || ' of ' || title || ' (' || o_custkey || ') for ' || title AS description
FROM orders JOIN forms ON forms.id = o_custkey"""))
def fill_template(spark, folder):
    leads = pay.with_form(site.leads(spark, folder), site.forms(spark, folder), "title", how="inner")
    template = F.lit("Entry {entry_id} of {form_title} ({form_id}) for {form_title}")
    filled = tx.fill_template(template, entry_id=F.col("id"), form_title=F.col("form_title"), form_id=F.col("form_id"))
    return leads.select("id", filled.alias("description"))


@query("join_desc", """
WITH parts AS (SELECT event_id AS id, CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN '' WHEN 'error' THEN '0' ELSE event_type END AS a,
  CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'user ' || user_id END AS b FROM events)
SELECT id, CASE WHEN (a IS NULL OR a IN ('', '0')) AND (b IS NULL OR b = '') THEN ' '
  WHEN a IS NULL OR a IN ('', '0') THEN b WHEN b IS NULL OR b = '' THEN a ELSE a || ' - ' || b END AS description FROM parts""")
def join_desc(spark, folder):
    kind = F.col("event_type")
    first = F.when(kind == "view", "").when(kind == "error", "0").when(kind != "click", kind)
    second = F.when(F.col("user_id") % 3 == 0, "").when(
        F.col("user_id") % 3 == 2, F.concat(F.lit("user "), F.col("user_id").cast("string")))
    return scan(spark, folder, "events").select(
        F.col("event_id").alias("id"), tx.join_description(first, second).alias("description"))


@query("mapped_answer", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'user' || o_custkey || '@example.com' ELSE '' END AS email,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'gift' WHEN '4-NOT SPECIFIED' THEN 'repeat order' WHEN '5-LOW' THEN 'late' ELSE '' END AS description,
  '' AS unmapped FROM orders""")
def mapped_answer(spark, folder):
    answers = F.col("answers")
    return site.entries(spark, folder).select(
        "id", tx.answer(answers, F.lit("5.3")).alias("email"), tx.answer(answers, F.lit("7")).alias("description"),
        tx.answer(answers, F.lit("")).alias("unmapped"))


@query("truncate_middle", """
SELECT doc_id AS id, CASE WHEN length(text) <= 41 THEN text ELSE left(text, 20) || '...' || right(text, 20) END AS label
FROM documents""")
def truncate_middle(spark, folder):
    return scan(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), tx.shorten_middle(F.col("text"), 41).alias("label"))


@query("free_txn_id", """
SELECT o_orderkey AS id, CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT) % 9000000000
  + 1000000000 AS VARCHAR) AS transaction_id FROM orders""")
def free_txn_id(spark, folder):
    return site.leads(spark, folder).select("id", st.free_transaction_id(F.col("id")).alias("transaction_id"))


@query("hook_chain", sql(LEADS, """
SELECT id, CAST(CASE WHEN form_id = 7 THEN (payment_amount + 500) * 2 - 1 ELSE (payment_amount + 500) * 2 END AS DOUBLE) AS amount
FROM leads WHERE payment_method = 'gateway'"""))
def hook_chain(spark, folder):
    """Amount hooks in order: add, then double, then one form's own; a frame hook keeps the gateway's leads."""
    points = (hooks.Hooks().on("price", lambda amount: amount + 500).on("gateway_price", lambda amount: amount * 2)
              .on("gateway_price_7", lambda amount: amount - 1).on("send", lambda method: method == "gateway"))
    amount = points.run_for_form(F.col("payment_amount"), F.col("form_id"), "price", "gateway_price")
    keep = lambda df: df.where(points.allows("send", F.col("payment_method")))
    return hooks.apply_hooks(site.leads(spark, folder), [keep, lambda df: df.select(
        "id", amount.cast("double").alias("amount"))])
