"""Opening payment requests and settling gateway callbacks into payment records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.functions import calendar as cal, money, status as st
from tollbook.functions.text import answer, fill_template, join_description, phone
from tollbook.functions.values import is_empty_number, is_empty_text
from tollbook.operators.hooks import CUSTOM_PRICE, FORM_PRICE, NO_HOOKS, Hooks
from tollbook.operators.joins import first_per_key
from tollbook.operators.totals import GATEWAY

# The columns that describe a payment, cleared before an entry is processed again.
PAYMENT_COLUMNS = ("payment_status", "payment_amount", "payment_date", "transaction_id", "transaction_type",
                   "is_fulfilled")

# The transaction id of a callback that brought none.
NO_REFERENCE = "-"

# Audit note texts.
NOTE_FREE = "وضعیت پرداخت : رایگان - بدون نیاز به درگاه پرداخت"
NOTE_COMPLETED = "وضعیت پرداخت : موفق - مبلغ پرداختی : %s - کد تراکنش : %s"
NOTE_CANCELLED = "وضعیت پرداخت : منصرف شده - مبلغ قابل پرداخت : %s - کد تراکنش : %s"
NOTE_FAILED = "وضعیت پرداخت : ناموفق - مبلغ قابل پرداخت : %s - کد تراکنش : %s - علت خطا : %s"
NOTE_SUBSCRIPTION = ("تغییرات اطلاعات فیلدها فقط در همین پیام ورودی اعمال خواهد شد و بر روی وضعیت کاربر"
                     " تاثیری نخواهد داشت .")
NOTE_REQUEST_FAILED = "خطا در اتصال به درگاه رخ داده است : %s"
NOTE_CORRECTED = ("اطلاعات تراکنش به صورت دستی ویرایش شد . وضعیت : %s - مبلغ : %s - کد رهگیری : %s"
                  " - تاریخ : %s")


def clear_payment(entries: DataFrame) -> DataFrame:
    """Null the payment columns, keeping the schema."""
    types = {f.name: f.dataType for f in entries.schema.fields}
    return entries.withColumns({c: F.lit(None).cast(types[c]) for c in PAYMENT_COLUMNS if c in types})


def charged(total: Column, currency: Column, policy: Column, hooks: Hooks = NO_HOOKS) -> Column:
    """What is due for an order: its total, the smallest charge, and what hooks make of it."""
    return hooks.run(money.minimum_charge(total, currency, policy), "gateway_order_total", "order_total").cast(money.MONEY)


def _requested(policy: Column, hooks: Hooks) -> Column:
    due = charged(F.col("order_total"), F.col("currency"), policy, hooks)
    return F.coalesce(hooks.run_for_form(due, F.col("form_id"), *FORM_PRICE), F.lit(0)).cast(money.MONEY)


def open_requests(entries: DataFrame, gateway: str = GATEWAY, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """Start payments for entries with `feed` (or null) and `order_total`.

    `path` tells what happens next: `untouched` without a feed, `free` when nothing is due, else `pay`.
    """
    found = F.col("feed").isNotNull()
    feed = F.col("feed")
    due = _requested(feed["floor_policy"], hooks)
    opened = {
        "payment_status": F.lit("Processing"),
        "payment_amount": F.lit(None),
        "payment_date": F.lit(None),
        "transaction_id": F.lit(None),
        "transaction_type": st.transaction_type(feed["type"]),
        "is_fulfilled": F.lit(0),
        "payment_method": F.lit(gateway),
    }
    types = {f.name: f.dataType for f in entries.schema.fields}
    changed = {c: F.when(found, v.cast(types[c])).otherwise(F.col(c)) for c, v in opened.items()}
    path = F.when(~found, "untouched").when(due == 0, "free").otherwise("pay")
    return entries.withColumns({**changed, "amount_due": F.when(found, due), "path": path})


def request_attributes(opened: DataFrame, gateway_name: str) -> DataFrame:
    """The attributes recorded for every entry whose payment was started."""
    pairs = {"feed_id": F.col("feed")["id"].cast("string"), "payment_type": F.lit("form"),
             "payment_gateway": F.lit(gateway_name)}
    rows = F.array(*[F.struct(F.lit(k).alias("meta_key"), v.alias("meta_value")) for k, v in pairs.items()])
    return opened.where(F.col("path") != "untouched").select(F.col("id").alias("lead_id"), F.inline(rows))


def visited_attribute_keys(callbacks: DataFrame, entries: DataFrame, gateway: str = GATEWAY) -> DataFrame:
    """The attribute that any callback of an entry of the gateway removes, whether it settles something or not."""
    leads = callbacks.where(~is_empty_number(F.col("lead_id"))).select("lead_id").distinct()
    own = entries.where(F.col("payment_method") == gateway).select(F.col("id").alias("lead_id"))
    return leads.join(own, "lead_id", "left_semi").withColumn("meta_key", F.lit("payment_type"))


def settled_attribute_keys(settled: DataFrame) -> DataFrame:
    """The attributes that settling removes: the payment type, and the gateway of a free payment."""
    keys = F.filter(F.array(F.lit("payment_type"), F.when(F.col("is_free"), F.lit("payment_gateway"))),
                    lambda k: k.isNotNull())
    return settled.select("lead_id", F.explode(keys).alias("meta_key"))


#: What a custom payment brings, each an attribute named after its form.
CUSTOM_PARTS = ("part_price", "part_desc", "part_name", "part_email", "part_mobile")


def form_attribute(attributes: Column, name: str, form_id: Column) -> Column:
    """An attribute that is kept under its name and the form's id."""
    return F.try_element_at(attributes, F.concat(F.lit(name + "_"), form_id.cast("string")))


def custom_parts(entries: DataFrame) -> DataFrame:
    """The parts of each entry's own form as columns, from its `attributes`; entries without a price for it are left out."""
    parts = {p: form_attribute(F.col("attributes"), p, F.col("form_id")) for p in CUSTOM_PARTS}
    return entries.withColumns(parts).where(F.col(CUSTOM_PARTS[0]).isNotNull())


def open_custom_requests(entries: DataFrame, gateway: str = GATEWAY, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """Start custom payments: the amount is the one recorded for the entry, the type always product.

    The result are new entries; numbering them is left to `number_rows` or `upsert_with_ids`.
    """
    price = F.col("part_price").try_cast(money.MONEY)
    cleared = clear_payment(entries)
    return cleared.withColumns({
        "payment_status": F.lit("Processing"),
        "transaction_type": F.lit(st.PRODUCT_TYPE),
        "is_fulfilled": F.lit(0),
        "payment_method": F.lit(gateway),
        "amount_due": hooks.run_for_form(price, F.col("form_id"), *CUSTOM_PRICE).cast(money.MONEY),
        "path": F.lit("custom"),
    })


def custom_payload(opened: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """What is sent to the gateway for custom payments: the amount as it is, in the gateway's unit."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return opened.select(
        "id", money.base_units(F.col("amount_due"), F.col("currency"), F.lit(True)).alias("amount"),
        hooks.run(text("part_desc"), "custom_description").alias("description"), text("part_email").alias("email"),
        phone(text("part_mobile")).alias("mobile"))


def custom_attributes(opened: DataFrame, gateway_name: str) -> DataFrame:
    """The attributes of the new entries: gateway, type, and their parts, which the settlement looks for."""
    fixed = [F.struct(F.lit(k).alias("meta_key"), F.lit(v).alias("meta_value"))
             for k, v in {"payment_gateway": gateway_name, "payment_type": "custom"}.items()]
    parts = [F.struct(F.concat(F.lit(p + "_"), F.col("form_id").cast("string")).alias("meta_key"), F.col(p).alias("meta_value"))
             for p in CUSTOM_PARTS]
    rows = F.filter(F.array(*fixed, *parts), lambda r: r["meta_value"].isNotNull())
    return opened.select(F.col("id").alias("lead_id"), F.inline(rows))


def payable(matched: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """Entries with their `feed` that have something to pay, with `amount_due` and `path`."""
    due = _requested(F.col("feed")["floor_policy"], hooks)
    return matched.withColumns({"amount_due": due, "path": F.lit("pay")}).where(F.col("amount_due") != 0)


def request_payload(opened: DataFrame) -> DataFrame:
    """What is sent to the gateway for entries that have something to pay."""
    feed, answers = F.col("feed"), F.col("answers")
    template = fill_template(F.coalesce(feed["desc_pm"], F.lit("")), entry_id=F.col("id"),
                             form_title=F.col("form_title"), form_id=F.col("form_id"))
    # Answers are columns of their own, so that each is looked up once.
    texts = opened.withColumns({
        "_template": template,
        "_said": answer(answers, feed["customer_fields_desc"]),
        "_email": answer(answers, feed["customer_fields_email"]),
        "_mobile": answer(answers, feed["customer_fields_mobile"]),
    })
    return texts.select(
        "id", money.base_units(F.col("amount_due"), F.col("currency"), F.col("path") == "custom").alias("amount"),
        join_description(F.col("_template"), F.col("_said")).alias("description"), F.col("_email").alias("email"),
        phone(F.col("_mobile")).alias("mobile"))


def apply_replies(entries: DataFrame, replies: DataFrame, gateway_name: str, order: Sequence[str] = ()) -> DataFrame:
    """Request replies (id, code): a failure marks the entry and leaves a note, success changes nothing.

    Of several replies of an entry the last by `order` counts, and the largest code if they tie.
    """
    replies = first_per_key(replies, ["id"], [*order, "code"], last=True).select("id", "code")
    joined = entries.join(replies.withColumnRenamed("code", "_code"), "id", "left")
    failed = F.col("_code").isNotNull() & (F.col("_code") != st.SUCCESS_CODE)
    message = st.code_message(F.col("_code"), gateway_name)
    return joined.withColumns({
        "payment_status": F.when(failed, F.lit("Failed")).otherwise(F.col("payment_status")),
        "message": F.when(failed, message),
        "note": F.when(failed, F.format_string(NOTE_REQUEST_FAILED, message)),
    }).drop("_code")


def outcome(no_arg: Column, status_arg: Column, code: Column) -> Column:
    """completed, failed or cancelled, from the callback's arguments and the gateway's answer."""
    confirmed = F.lower(F.coalesce(status_arg, F.lit(""))) == "ok"
    return (F.when(is_free(no_arg), "completed")
            .when(confirmed & F.coalesce(code == st.SUCCESS_CODE, F.lit(False)), "completed")
            .when(confirmed, "failed").otherwise("cancelled"))


def is_free(no_arg: Column) -> Column:
    return F.coalesce(no_arg == "true", F.lit(False))


def outcome_message(result: Column, code: Column, gateway_name: str) -> Column:
    """The reason of a failure, no text otherwise."""
    return F.when(result == "failed", st.code_message(code, gateway_name)).otherwise(F.lit(""))


def with_outcome(callbacks: DataFrame, gateway_name: str) -> DataFrame:
    result = outcome(F.col("no_arg"), F.col("status_arg"), F.col("result_code"))
    return callbacks.withColumns({
        "outcome": result,
        "is_free": is_free(F.col("no_arg")),
        "message": outcome_message(result, F.col("result_code"), gateway_name),
    })


def first_callbacks(callbacks: DataFrame) -> DataFrame:
    """The first callback of each entry; later ones are ignored for good."""
    valid = callbacks.where(~is_empty_number(F.col("lead_id")))
    return first_per_key(valid, ["lead_id"], ["ts", "event_id"])


def settle(matched: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """Payment records from first callbacks that were matched to their open entry.

    Needs outcome, is_free, ts, ref_id, currency, `custom`, `custom_price`, `order_total` and `feed`.
    A free payment is settled without status, amount and method.
    """
    custom = F.col("custom")
    feed = F.col("feed")
    ordered = charged(F.coalesce(F.col("order_total"), F.lit(0)), F.col("currency"), feed["floor_policy"], hooks)
    total = F.when(custom, F.col("custom_price")).otherwise(ordered)
    done, free = F.col("outcome") == "completed", F.col("is_free")
    txn_type = F.when(custom, F.lit(st.PRODUCT_TYPE)).otherwise(st.transaction_type(feed["type"]))
    reference = F.when(is_empty_text(F.col("ref_id")), F.lit(NO_REFERENCE)).otherwise(F.col("ref_id"))
    drawn = hooks.run(st.free_transaction_id(F.col("lead_id")), "free_transaction_id")
    status = (F.when(done, st.paid_status(txn_type)).when(F.col("outcome") == "cancelled", F.lit("Cancelled"))
              .otherwise(F.lit("Failed")))
    return matched.withColumns({
        "total": total.cast(money.MONEY),
        "new_status": F.when(~free, status),
        "new_amount": F.when(free, F.lit(None)).when(done, total).otherwise(F.lit(0)).cast(money.MONEY),
        "new_fulfilled": F.when(~free, done.cast("int")),
        "new_method": F.when(~free, F.col("payment_method")),
        "new_transaction_id": hooks.run(F.when(free, drawn).otherwise(reference), "transaction_id"),
        "new_transaction_type": txn_type,
    })


def settlement_note(total_text: Column) -> Column:
    """The audit note of a settlement."""
    txn = F.col("new_transaction_id")
    return (F.when(F.col("is_free"), F.lit(NOTE_FREE))
            .when(F.col("outcome") == "completed", F.format_string(NOTE_COMPLETED, total_text, txn))
            .when(F.col("outcome") == "cancelled", F.format_string(NOTE_CANCELLED, total_text, txn))
            .otherwise(F.format_string(NOTE_FAILED, total_text, txn, F.col("message"))))


def note_list(total_text: Column) -> Column:
    """The notes of a settlement: one, and one before it for a subscription that became active."""
    activated = (F.col("outcome") == "completed") & (F.col("new_transaction_type") == st.SUBSCRIPTION_TYPE)
    return F.filter(F.array(F.when(activated, F.lit(NOTE_SUBSCRIPTION)), settlement_note(total_text)), lambda n: n.isNotNull())


def settlement_notes(settled: DataFrame) -> DataFrame:
    """One note per settlement, and one more for a subscription that became active."""
    notes = note_list(money.money_text(F.col("total"), F.col("currency")))
    return settled.select("lead_id", F.posexplode(notes).alias("position", "text"))


def correct_payments(leads: DataFrame, corrections: DataFrame, offset: str | float,
                     gateway: str = GATEWAY) -> DataFrame:
    """Manual corrections (id, status, amount, transaction_id, date_text), one per lead, of the gateway's leads.

    Amount and transaction id are overwritten. No status keeps the old one. A date is Jalali local
    text; without one the old date stays, or else the creation date is taken.
    """
    new = corrections.select("id", F.struct("status", "amount", "transaction_id", "date_text").alias("_new"))
    joined = leads.join(new, "id", "left")
    applies = F.col("_new").isNotNull() & (F.col("payment_method") == gateway)
    given = ~is_empty_text(F.col("_new.date_text"))
    local = cal.parse_jalali_datetime(F.col("_new.date_text"))
    date = F.when(given, cal.to_utc(local, offset)).otherwise(F.coalesce("payment_date", "date_created"))
    status = F.when(is_empty_text(F.col("_new.status")), F.col("payment_status")).otherwise(F.col("_new.status"))
    values = {
        "payment_status": status,
        "payment_amount": F.col("_new.amount"),
        "transaction_id": F.col("_new.transaction_id"),
        "payment_date": date,
        "is_fulfilled": st.is_paid_status(status).cast("int"),
    }
    types = {f.name: f.dataType for f in leads.schema.fields}
    changed = {c: F.when(applies, v).otherwise(F.col(c)).cast(types[c]) for c, v in values.items()}
    return joined.withColumns({**changed, "corrected": F.coalesce(applies, F.lit(False))}).drop("_new")


def correction_text() -> Column:
    return F.format_string(NOTE_CORRECTED, st.status_label(F.col("payment_status")),
                           money.money_text(F.col("payment_amount"), F.col("currency")), F.col("transaction_id"),
                           F.date_format("payment_date", "yyyy-MM-dd HH:mm:ss"))


def correction_notes(corrected: DataFrame) -> DataFrame:
    return corrected.where("corrected").select(F.col("id").alias("lead_id"), correction_text().alias("text"))


# The feed's list of notifications for each status.
STATUS_LISTS = {"submit": "notif_1", "completed": "notif_2", "failed": "notif_3", "cancelled": "notif_4"}


def selected_notifications(feed: Column, status: Column) -> Column:
    """The ids that a feed has selected for a status; none without a feed."""
    chosen = F.lit(None).cast("array<string>")
    for name, column in STATUS_LISTS.items():
        chosen = F.when(F.lower(status) == name, feed[column]).otherwise(chosen)
    return F.coalesce(chosen, F.array().cast("array<string>"))


def notifications_to_send(routed: DataFrame, status: str = "outcome", hooks: Hooks = NO_HOOKS, selected: str | None = None) -> DataFrame:
    """The form's notifications that the feed has selected for the payment's status, in form order.

    Needs `notifications` (the ids the form triggers) and `feed`, or `selected` with the feed's choice.
    """
    chosen = F.col(selected) if selected else selected_notifications(F.col("feed"), F.col(status))
    wanted = F.filter("notifications", lambda n: F.array_contains(chosen, n)
                      & hooks.allows("send_notification", n, F.lower(F.col(status))))
    keep = ["lead_id"] + [status] * bool(selected)
    return routed.select(*keep, F.explode(wanted).alias("notification_id"))


def transition_summary(settled: DataFrame) -> DataFrame:
    """Counts and amounts by the status before and after."""
    return (settled.groupBy(F.col("payment_status").alias("before"), F.col("new_status").alias("after"))
            .agg(F.count(F.lit(1)).alias("payments"), F.sum("new_amount").cast("double").alias("amount")))
