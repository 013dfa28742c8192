"""From a submitted entry to a payment request, and from a callback to a settled payment.

The tables that belong to one lead (attributes, order total, first callback) are each brought to one
row per lead before they meet, so the joins by lead are one to one and share one partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tollbook.functions import money, status as st
from tollbook.operators import feeds as fd, forms as fm, settle as s
from tollbook.operators.hooks import NO_HOOKS, Hooks
from tollbook.operators.joins import hot_key_join, lookup_join
from tollbook.operators.keyed import largest, number_rows, pivot_meta
from tollbook.operators.totals import GATEWAY

SETTLEMENT_KEYS = ("feed_id", "payment_type", "part_price")
FORM_PRICE_KEY = "part_price_"

# The feed settings each step needs; no others are decoded or carried along.
AMOUNT_SETTINGS = ("type", "floor_policy")
REQUEST_SETTINGS = (*AMOUNT_SETTINGS, "desc_pm", "customer_fields_desc", "customer_fields_email",
                    "customer_fields_mobile")
CONFIRMATION_SETTINGS = (*AMOUNT_SETTINGS, "conf_1", "conf_2", "conf_3")
NOTIFICATION_SETTINGS = (*AMOUNT_SETTINGS, "notif_1", "notif_2", "notif_3", "notif_4")
POST_SETTINGS = (*AMOUNT_SETTINGS, "update_post_action1")


def with_meta(entries: DataFrame, meta: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    wide = pivot_meta(meta, keys).withColumnRenamed("lead_id", "id")
    return entries.join(wide, "id", "left")


def with_attributes(entries: DataFrame, meta: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Entries with `attributes`, a map of their attributes whose names begin with one of the prefixes.

    Of an attribute that is there twice the larger value counts.
    """
    named = reduce(lambda a, b: a | b, [F.startswith(F.col("meta_key"), F.lit(p)) for p in prefixes])
    pairs = F.sort_array(F.collect_list(F.struct("meta_key", "meta_value")), asc=False)
    listed = meta.where(named).groupBy(F.col("lead_id").alias("id")).agg(pairs.alias("_pairs"))
    first = F.filter("_pairs", lambda p, i: (i == 0) | (p["meta_key"] != F.get("_pairs", i - 1)["meta_key"]))
    return entries.join(listed.select("id", F.map_from_entries(first).alias("attributes")), "id", "left")


def settlement_meta(meta: DataFrame) -> DataFrame:
    """The attributes that a settlement looks at."""
    return meta.where(F.col("meta_key").isin(*SETTLEMENT_KEYS) | F.startswith(F.col("meta_key"), F.lit(FORM_PRICE_KEY)))


def with_order_total(entries: DataFrame, order_totals: DataFrame) -> DataFrame:
    totals = order_totals.select(F.col("lead_id").alias("id"), F.col("total").alias("order_total"))
    return entries.join(totals, "id", "left").withColumn(
        "order_total", F.coalesce("order_total", F.lit(0)).cast(money.MONEY))


def with_form(entries: DataFrame, forms: DataFrame, *columns: str, how: str = "left") -> DataFrame:
    renamed = {"title": "form_title", "post_status": "form_post_status"}
    table = forms.select(F.col("id").alias("form_id"), *[F.col(c).alias(renamed.get(c, c)) for c in columns])
    return lookup_join(entries, table, "form_id", how)


def start_payments(entries: DataFrame, feeds: DataFrame, order_totals: DataFrame,
                   gateway: str = GATEWAY, hooks: Hooks = NO_HOOKS, settings: tuple[str, ...] = AMOUNT_SETTINGS) -> DataFrame:
    """Entries with their feed, amount due and path.

    Totals are joined before feeds, so that the shuffle by entry does not carry the feed settings.
    """
    feeds = hooks.run(feeds, "gateway_feeds", "feeds")
    return s.open_requests(fd.with_active_feed(with_order_total(entries, order_totals), feeds, settings), gateway, hooks)


def payment_requests(entries: DataFrame, feeds: DataFrame, forms: DataFrame,
                     order_totals: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """The request rows of all entries that have something to pay.

    Entries without a passing feed or without an amount are dropped as early as each is known.
    """
    feeds = hooks.run(feeds, "gateway_feeds", "feeds")
    matched = fd.with_passing_feed(with_order_total(entries, order_totals), feeds, REQUEST_SETTINGS)
    return s.request_payload(with_form(s.payable(matched, hooks), forms, "title"))


def start_custom_payments(entries: DataFrame, meta: DataFrame, gateway: str = GATEWAY, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """New entries for the custom payments that are asked for, numbered on from the largest id, with the entry they
    come from in `from_id`.

    An entry asks for one by a price among its attributes that is named after its form. From these rows follow what is
    sent (`custom_payload`) and the new entries' attributes (`custom_attributes`).
    """
    asking = s.custom_parts(with_attributes(entries, meta, s.CUSTOM_PARTS)).drop("attributes")
    opened = s.open_custom_requests(asking, gateway, hooks).withColumnRenamed("id", "from_id")
    return number_rows(opened, "from_id", "id", largest(entries, "id"))


def enrich_callbacks(callbacks: DataFrame, entries: DataFrame, meta: DataFrame, feeds: DataFrame,
                     forms: DataFrame, gateway: str = GATEWAY) -> DataFrame:
    """Every callback with its entry, form and feed, for the entries that are the gateway's.

    One entry may have received most of the callbacks, hence the hot-key join.
    """
    known = with_meta(entries.where(F.col("payment_method") == gateway), meta, ("feed_id", "payment_type"))
    table = known.withColumnsRenamed({"id": "lead_id"})
    joined = hot_key_join(callbacks, table, "lead_id", "inner", spread_by=["ts", "event_id"])
    known = fd.with_own_feed(joined.withColumn("feed_id", F.col("feed_id").try_cast("bigint"))
                             .withColumn("id", F.col("event_id")), feeds).drop("id")
    return with_form(known, forms, "title")


def open_entries(entries: DataFrame, gateway: str = GATEWAY) -> DataFrame:
    """The gateway's entries that are not settled."""
    return entries.where((F.col("payment_method") == gateway) & F.col("payment_date").isNull())


def match_first_callbacks(first: DataFrame, entries: DataFrame, meta: DataFrame, feeds: DataFrame,
                          order_totals: DataFrame, gateway: str = GATEWAY, gateway_name: str = "Gateway",
                          settings: tuple[str, ...] = AMOUNT_SETTINGS, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """First callbacks, one per entry, of open entries, with everything that settling them needs.

    An entry that is not the gateway's, is already settled, or has neither a feed nor a custom
    price is left alone.
    """
    joined = first.withColumnRenamed("lead_id", "id").join(open_entries(entries, gateway), "id")
    known = with_order_total(with_meta(joined, meta, SETTLEMENT_KEYS), order_totals)
    known = with_attributes(known, meta, (FORM_PRICE_KEY,))
    form_price = s.form_attribute(F.col("attributes"), "part_price", F.col("form_id"))
    known = known.withColumns({
        "custom": F.coalesce(F.col("payment_type") == "custom", F.lit(False)),
        "custom_price": F.coalesce(form_price, "part_price").try_cast(money.MONEY),
        "feed_id": F.col("feed_id").try_cast("bigint"),
    }).drop("attributes")
    # A custom payment has no feed of its own.
    known = known.withColumn("feed_id", F.when(~F.col("custom"), F.col("feed_id")))
    feeds = hooks.run(feeds, "gateway_entry_feed", "entry_feed")
    matched = fd.with_own_feed(known, feeds, settings=settings).where(F.col("custom") | F.col("feed").isNotNull())
    return s.with_outcome(matched.withColumnRenamed("id", "lead_id"), gateway_name)


def match_callbacks(callbacks: DataFrame, *tables: DataFrame, **options) -> DataFrame:
    return match_first_callbacks(s.first_callbacks(callbacks), *tables, **options)


def settle_first_callbacks(first: DataFrame, *tables: DataFrame, hooks: Hooks = NO_HOOKS, **options) -> DataFrame:
    """`settle_callbacks` for callbacks of which each entry has only its first."""
    return s.settle(match_first_callbacks(first, *tables, hooks=hooks, **options), hooks)


def settle_callbacks(callbacks: DataFrame, entries: DataFrame, meta: DataFrame, feeds: DataFrame,
                     order_totals: DataFrame, **options) -> DataFrame:
    """Settled payments, one row per entry that a callback settles."""
    return settle_first_callbacks(s.first_callbacks(callbacks), entries, meta, feeds, order_totals, **options)


def settled_entries(entries: DataFrame, settled: DataFrame) -> DataFrame:
    """The entry table after settlement."""
    new = settled.select(F.col("lead_id").alias("id"), F.struct(
        F.col("new_status").alias("payment_status"), F.col("new_amount").alias("payment_amount"),
        F.col("new_fulfilled").alias("is_fulfilled"), F.col("new_method").alias("payment_method"),
        F.col("new_transaction_id").alias("transaction_id"), F.col("new_transaction_type").alias("transaction_type"),
        F.col("ts").alias("payment_date")).alias("_new"))
    joined = entries.join(new, "id", "left")
    fields = new.schema["_new"].dataType.names
    changed = F.col("_new").isNotNull()
    return joined.withColumns({
        c: F.when(changed, F.col("_new")[c]).otherwise(F.col(c)) for c in fields}).drop("_new")


def route_confirmations(settled: DataFrame, forms: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """The confirmation each settled entry is shown; custom payments are routed elsewhere."""
    feed = F.col("feed")
    selected = (F.when(F.col("outcome") == "completed", feed["conf_1"])
                .when(F.col("outcome") == "failed", feed["conf_2"]).otherwise(feed["conf_3"]))
    own = settled.where(~F.col("custom")).withColumn("id", F.col("lead_id"))
    joined = with_form(own, forms, "confirmations")
    picked = fm.pick_confirmation(F.col("confirmations"), selected, F.col("answers"), hooks=hooks)
    return joined.select("lead_id", "outcome", picked["id"].alias("confirmation_id"))


def route_notifications(settled: DataFrame, forms: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    own = settled.where(~F.col("custom")).withColumn("id", F.col("lead_id"))
    return s.notifications_to_send(with_form(own, forms, "notifications"), hooks=hooks)


def decide_post_status(settled: DataFrame, forms: DataFrame) -> DataFrame:
    """The post status that each completed payment asks for."""
    done = settled.where((F.col("outcome") == "completed") & ~F.col("custom") & F.col("post_id").isNotNull())
    joined = with_form(done.withColumn("id", F.col("lead_id")), forms, "post_status")
    asked = st.post_status_after_payment(F.col("feed")["update_post_action1"], F.col("form_post_status"))
    return joined.select(F.col("post_id").alias("id"), "ts", "lead_id", asked.alias("new_status"))
