"""Feed lookups, rules and follow-up flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import ACTIVE, ENTRIES, FEEDS, FORMS, LEADS, META, sql
from tollbook.functions.values import json_path
from tollbook.operators import feeds as fd, forms as fm
from tollbook.operators.joins import lookup_join
from tollbook.plans import payments as pay
from tollbook.sources import site


@query("feeds_with_form", sql(FEEDS, FORMS, """
SELECT f.id, f.form_id, f.is_active, f.type, title AS form_title FROM feeds f JOIN forms ON forms.id = form_id"""))
def feeds_with_form(spark, folder):
    joined = fd.feeds_with_form(site.feeds(spark, folder), site.forms(spark, folder))
    return joined.select("id", "form_id", "is_active", json_path(F.col("meta"), "type").alias("type"), "form_title")


@query("feed_list", sql(FEEDS, FORMS, """
SELECT f.id, is_active, form_id, title AS form_title,
  CASE type WHEN 'subscription' THEN 'عضویت' ELSE 'محصول معمولی یا فرم ارسال پست' END AS type_label
FROM feeds f JOIN forms ON forms.id = form_id"""))
def feed_list(spark, folder):
    return fd.feed_list(site.feeds(spark, folder), site.forms(spark, folder))


@query("feed_title_lookup", sql(META, FEEDS, FORMS, """
SELECT lead_id, f.id AS feed_id, title AS form_title FROM lead_meta m
JOIN feeds f ON m.meta_key = 'feed_id' AND f.id = CAST(m.meta_value AS BIGINT) JOIN forms ON forms.id = f.form_id"""))
def feed_title_lookup(spark, folder):
    """The title for the feed of every lead, all at once instead of a scan of the feeds for each."""
    recorded = site.lead_meta(spark, folder).where(F.col("meta_key") == "feed_id").select(
        "lead_id", F.col("meta_value").try_cast("bigint").alias("feed_id"))
    titles = fd.feeds_with_form(site.feeds(spark, folder), site.forms(spark, folder)).select(
        F.col("id").alias("feed_id"), "form_title")
    return lookup_join(recorded, titles, "feed_id", "inner").select(
        "lead_id", "feed_id", "form_title")


@query("lead_feed", sql(LEADS, META, FEEDS, """
SELECT l.id, f.id AS feed_id, f.type FROM leads l
LEFT JOIN lead_meta m ON m.lead_id = l.id AND m.meta_key = 'feed_id'
LEFT JOIN feeds f ON f.id = CAST(m.meta_value AS BIGINT)"""))
def lead_feed(spark, folder):
    leads = pay.with_meta(site.leads(spark, folder).select("id"), site.lead_meta(spark, folder), ("feed_id",))
    known = leads.withColumn("feed_id", F.col("feed_id").try_cast("bigint"))
    return fd.with_own_feed(known, site.feeds(spark, folder)).select(
        "id", F.col("feed.id").alias("feed_id"), F.col("feed.type").alias("type"))


@query("first_feed", sql(FEEDS, """
SELECT id, form_id, type FROM feeds WHERE is_active = 1 QUALIFY row_number() OVER (PARTITION BY form_id ORDER BY id) = 1"""))
def first_feed(spark, folder):
    return fd.first_feeds(site.feeds(spark, folder)).select(
        "id", "form_id", json_path(F.col("meta"), "type").alias("type"))


@query("rule_match", sql(LEADS, ENTRIES, FEEDS, ACTIVE, """
SELECT t.entry_id AS id, t.id AS feed_id, a.entry_id IS NOT NULL AS passes FROM tested t LEFT JOIN active a USING (entry_id)"""))
def rule_match(spark, folder):
    joined = fd.with_first_feed(site.entries(spark, folder), site.feeds(spark, folder), "inner")
    return fd.with_rule_result(joined, "passes").select("id", F.col("feed.id").alias("feed_id"), "passes")


@query("active_feed", sql(LEADS, ENTRIES, FEEDS, ACTIVE, """
SELECT e.id, a.id AS feed_id FROM entries e LEFT JOIN active a ON a.entry_id = e.id"""))
def active_feed(spark, folder):
    matched = fd.with_active_feed(site.entries(spark, folder), site.feeds(spark, folder))
    return matched.select("id", F.col("feed.id").alias("feed_id"))


@query("defer_flag", sql(LEADS, ENTRIES, FEEDS, ACTIVE, """
SELECT e.id, a.id IS NOT NULL OR is_delayed AS defer_post, a.id IS NOT NULL OR is_delayed AS defer_notification,
  coalesce(a.type = 'subscription', FALSE) OR is_delayed AS defer_registration
FROM entries e LEFT JOIN active a ON a.entry_id = e.id"""))
def defer_flag(spark, folder):
    flagged = fd.with_defer_flags(site.entries(spark, folder), site.feeds(spark, folder))
    return flagged.select("id", "defer_post", "defer_notification", "defer_registration")


@query("defer_addon", sql(LEADS, ENTRIES, META, FEEDS, ACTIVE, """
state AS (SELECT lead_id, coalesce(max(meta_value) FILTER (meta_key = 'crm_is_fulfilled'), '') AS crm,
    coalesce(max(meta_value) FILTER (meta_key = 'user_registration_is_fulfilled'), '') AS reg,
    coalesce(max(meta_value) FILTER (meta_key = 'processed_feeds'), '') AS processed FROM lead_meta GROUP BY lead_id)""", """
SELECT e.id,
  CASE WHEN a.addon = 'true' THEN crm IN ('', '0') AND processed = '' ELSE is_delayed END AS defer_crm,
  CASE WHEN a.type = 'subscription' THEN reg IN ('', '0') ELSE is_delayed END AS defer_user_registration
FROM entries e JOIN state ON lead_id = e.id LEFT JOIN active a ON a.entry_id = e.id"""))
def defer_addon(spark, folder):
    keys = ("crm_is_fulfilled", "user_registration_is_fulfilled", "processed_feeds")
    known = pay.with_meta(site.entries(spark, folder), site.lead_meta(spark, folder), keys)
    flagged = fd.with_defer_flags(known, site.feeds(spark, folder), ("crm", "user_registration"))
    return flagged.select("id", "defer_crm", "defer_user_registration")


@query("selected_semi", sql(FEEDS, FORMS, """
SELECT forms.id AS form_id, n AS notification_id FROM forms, (VALUES ('n1'), ('n2'), ('n3')) v(n)
WHERE EXISTS (SELECT 1 FROM feeds f WHERE f.form_id = forms.id AND f.is_active = 1 AND list_contains(notif_3, n))"""))
def selected_semi(spark, folder):
    """The notifications of a form that an active feed of it has selected for a failed payment."""
    triggered = site.forms(spark, folder).select(
        F.col("id").alias("form_id"), F.explode("notifications").alias("notification_id"))
    feeds = fd.decode_meta(fd.feeds_by_form(site.feeds(spark, folder), only_active=True))
    selected = feeds.select("form_id", F.explode("meta.notif_3").alias("notification_id"))
    return fm.selected_only(triggered, selected)
