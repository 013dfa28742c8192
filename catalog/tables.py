"""Keyed maintenance of the feed, attribute, note and form tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import FEEDS, FORMS, META, sql
from tollbook.functions.values import json_path
from tollbook.operators import entries as en, feeds as fd, forms as fm, keyed, totals as t
from tollbook.sources import site
from tollbook.sources.tables import scan

FEED_COLUMNS = ("id", "form_id", "is_active", "type")


def _feeds(spark, folder):
    return site.feeds(spark, folder).select("id", "form_id", "is_active", json_path(F.col("meta"), "type").alias("type"))


@query("feed_by_id", sql(FEEDS, "SELECT id, form_id, is_active, type FROM feeds WHERE id = 15"))
def feed_by_id(spark, folder):
    return fd.feed_by_id(_feeds(spark, folder), 15)


@query("feeds_by_form", sql(FEEDS, "SELECT id, form_id, is_active, type FROM feeds WHERE is_active = 1"))
def feeds_by_form(spark, folder):
    return fd.feeds_by_form(_feeds(spark, folder), only_active=True)


@query("forms_scan", sql(FORMS, "SELECT id, title, post_status FROM forms"))
def forms_scan(spark, folder):
    return site.forms(spark, folder).select("id", "title", "post_status")


# Changes from the suppliers: about a third change a feed, the others ask for a new one.
CHANGES = """changes AS (
  SELECT s_suppkey AS seq, CASE WHEN s_nationkey < 8 THEN s_suppkey * 2 + 1 ELSE 0 END AS id, s_suppkey AS form_id,
    CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_active, 'changed' AS type FROM supplier)"""


def _changes(spark, folder):
    key = F.col("s_suppkey")
    return scan(spark, folder, "supplier").select(
        key.alias("seq"), F.when(F.col("s_nationkey") < 8, key * 2 + 1).otherwise(0).alias("id"), key.alias("form_id"),
        (F.col("s_acctbal") > 0).cast("int").alias("is_active"), F.lit("changed").alias("type"))


@query("upsert_feeds", sql(FEEDS, CHANGES, """
SELECT id, form_id, is_active, type FROM feeds WHERE id NOT IN (SELECT id FROM changes)
UNION ALL SELECT id, form_id, is_active, type FROM changes WHERE id <> 0
UNION ALL SELECT (SELECT max(id) FROM feeds) + row_number() OVER (ORDER BY seq), form_id, is_active, type
  FROM changes WHERE id = 0"""))
def upsert_feeds(spark, folder):
    return keyed.upsert_with_ids(_feeds(spark, folder), _changes(spark, folder), "id", "seq")


@query("delete_feeds", sql(FEEDS, CHANGES, """
SELECT id, form_id, is_active, type FROM feeds WHERE id NOT IN (SELECT id FROM changes)"""))
def delete_feeds(spark, folder):
    return keyed.delete_keys(_feeds(spark, folder), _changes(spark, folder).select("id"))


@query("toggle_active", sql(FEEDS, CHANGES, """
SELECT f.id, f.form_id, coalesce(c.is_active, f.is_active) AS is_active, f.type FROM feeds f LEFT JOIN changes c ON c.id = f.id"""))
def toggle_active(spark, folder):
    changes = _changes(spark, folder).where(F.col("id") != 0).select("id", "is_active")
    return keyed.set_columns(_feeds(spark, folder), changes, "id")


@query("decode_meta", sql(FEEDS, """
SELECT id, type, addon, floor_policy, update_post_action1, rule_operator, rule_value, desc_pm, mobile_field,
  array_to_string(conf_1, ',') AS conf_1, array_to_string(notif_3, ',') AS notif_3 FROM feeds"""))
def decode_meta(spark, folder):
    """Decode, encode and decode again, so that both directions are seen."""
    decoded = fd.decode_meta(fd.encode_meta(fd.decode_meta(site.feeds(spark, folder))))
    plain = [F.col(f"meta.{c}").alias(a) for c, a in [
        ("type", "type"), ("addon", "addon"), ("floor_policy", "floor_policy"),
        ("update_post_action1", "update_post_action1"), ("conditional_operator", "rule_operator"),
        ("conditional_value", "rule_value"), ("desc_pm", "desc_pm"), ("customer_fields_mobile", "mobile_field")]]
    lists = [F.array_join(f"meta.{c}", ",").alias(c) for c in ("conf_1", "notif_3")]
    return decoded.select("id", *plain, *lists)


@query("meta_pivot", sql(META, """
SELECT lead_id, max(meta_value) FILTER (meta_key = 'payment_gateway') AS payment_gateway,
  max(meta_value) FILTER (meta_key = 'feed_id') AS feed_id, max(meta_value) FILTER (meta_key = 'payment_type') AS payment_type,
  max(meta_value) FILTER (meta_key = 'part_price') AS part_price,
  max(meta_value) FILTER (meta_key = 'crm_is_fulfilled') AS crm_is_fulfilled,
  max(meta_value) FILTER (meta_key = 'user_registration_is_fulfilled') AS user_registration_is_fulfilled,
  max(meta_value) FILTER (meta_key = 'processed_feeds') AS processed_feeds
FROM lead_meta GROUP BY lead_id"""))
def meta_pivot(spark, folder):
    return keyed.pivot_meta(site.lead_meta(spark, folder), site.LEAD_META_KEYS)


@query("meta_upsert", sql(META, """
SELECT lead_id, meta_key, meta_value FROM lead_meta
WHERE NOT (meta_key = 'payment_type' AND lead_id IN (SELECT l_orderkey FROM lineitem))
UNION ALL SELECT DISTINCT l_orderkey, 'payment_type', 'custom' FROM lineitem"""))
def meta_upsert(spark, folder):
    leads = site.callbacks(spark, folder).select("lead_id").distinct()
    changes = leads.select("lead_id", F.lit("payment_type").alias("meta_key"), F.lit("custom").alias("meta_value"))
    return keyed.upsert_meta(site.lead_meta(spark, folder), changes)


@query("meta_delete", sql(META, """
SELECT lead_id, meta_key, meta_value FROM lead_meta
WHERE NOT (meta_key = 'payment_type' AND lead_id IN (SELECT l_orderkey FROM lineitem))"""))
def meta_delete(spark, folder):
    handled = site.callbacks(spark, folder).select("lead_id").distinct()
    return keyed.delete_meta(site.lead_meta(spark, folder), handled.withColumn("meta_key", F.lit("payment_type")))


@query("order_total", """
SELECT l_orderkey AS lead_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(19,2)) * CAST(l_quantity AS INTEGER)) AS DOUBLE) AS total
FROM lineitem GROUP BY l_orderkey""")
def order_total(spark, folder):
    return t.money_as_double(t.order_totals(site.order_lines(spark, folder)), "total")


SIGNUPS = """signups AS (SELECT 'user' || user_id AS user_login, event_id AS activation_key, ts AS registered
  FROM events WHERE event_type = 'signup')"""


@query("latest_per_key", sql(SIGNUPS, """
SELECT * FROM signups QUALIFY row_number() OVER (PARTITION BY user_login ORDER BY registered DESC, activation_key DESC) = 1"""))
def latest_per_key(spark, folder):
    return en.latest_per_key(site.signups(spark, folder), "user_login", "registered", "activation_key")


@query("latest_one", sql(SIGNUPS, """
SELECT * FROM signups WHERE user_login = 'user7' ORDER BY registered DESC, activation_key DESC LIMIT 1"""))
def latest_one(spark, folder):
    return en.latest_one(site.signups(spark, folder), "user_login", "user7", "registered", "activation_key")


@query("form_fields", """
SELECT c_custkey AS form_id, field_id, replace(label, '#', CAST(c_nationkey AS VARCHAR)) AS label
FROM customer, (VALUES ('1', 'Main #'), ('2.3', 'First'), ('2.6', 'Last'), ('3', 'Email'), ('5', 'Size')) v(field_id, label)""")
def form_fields(spark, folder):
    return fm.form_fields(site.forms(spark, folder))


@query("choice_values", """
SELECT c_custkey AS form_id, '5' AS field_id, 0 AS position, 'Size ' || c_nationkey AS value FROM customer
UNION ALL SELECT c_custkey, '5', 1, 'v' || c_nationkey FROM customer""")
def choice_values(spark, folder):
    return fm.choice_values(site.forms(spark, folder))


@query("has_product", """
SELECT c_custkey AS id, c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS has_product FROM customer""")
def has_product(spark, folder):
    return site.forms(spark, folder).select("id", fm.has_product().alias("has_product"))


@query("field_type_allowlist", """
SELECT c_custkey AS form_id, '3' AS field_id FROM customer
UNION ALL SELECT c_custkey, '1' FROM customer WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')
UNION ALL SELECT c_custkey, '5' FROM customer WHERE c_acctbal > 5000""")
def field_type_allowlist(spark, folder):
    fields = site.forms(spark, folder).select(F.col("id").alias("form_id"), F.inline("fields"))
    return fields.where(fd.is_rule_field(F.col("type"), F.col("input_type"))).select(
        "form_id", F.col("id").alias("field_id"))
