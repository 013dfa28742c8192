"""One log of what happens to payments: requests, replies, settlements and corrections, each event appended once.

An event says which entry went from which status to which, who did it, the notes that belong to it, and which notifications the
entry's feed has selected for it. Notes, notifications and the counts of transitions all follow from the log.
An event is known by its kind, its entry and what makes it unique there, so whatever is logged again is not appended again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tollbook.functions import money
from tollbook.operators import settle as s
from tollbook.operators.hooks import NO_HOOKS, Hooks
from tollbook.operators.joins import first_per_key
from tollbook.sources.segments import FANOUT, Segments, append, read, read_keys_like

SCHEMA = ("lead_id bigint, kind string, mark string, form_id bigint, before string, after string, amount decimal(19,2),"
          " route string, selected array<string>, user_id bigint, user_name string, notes array<string>")

# Who acts when nobody is logged in.
GUEST = (0, "مهمان")


def event_table(path: str, fanout: int = FANOUT) -> Segments:
    return Segments(path, SCHEMA, ("lead_id",), slots=16, fanout=fanout)


def _events(rows: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """Rows in the log's columns; what an event does not have is null. Rows with columns `user_id` and `user_name` say who."""
    given = {c: F.col(c) for c in ("user_id", "user_name") if c in rows.columns}
    values = {"user_id": F.lit(GUEST[0]), "user_name": F.lit(GUEST[1]), **given, "kind": F.lit(kind), **columns}
    return rows.select([values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(SCHEMA)])


def request_events(opened: DataFrame) -> DataFrame:
    """Payments that were started and go to the gateway, from `start_payments` with the notification settings."""
    sent = opened.where(F.col("path") == "pay")
    return _events(sent, "request", lead_id=F.col("id"), mark=F.lit(""), form_id=F.col("form_id"), after=F.col("payment_status"),
                   amount=F.col("amount_due"), route=F.lit("submit"),
                   selected=s.selected_notifications(F.col("feed"), F.lit("submit")))


def reply_events(opened: DataFrame, replies: DataFrame, gateway_name: str) -> DataFrame:
    """The started payments that the gateway refused."""
    sent = opened.where(F.col("path") == "pay")
    failed = s.apply_replies(sent, replies, gateway_name).where(F.col("note").isNotNull())
    return _events(failed, "reply", lead_id=F.col("id"), mark=F.lit(""), form_id=F.col("form_id"), before=F.lit("Processing"),
                   after=F.col("payment_status"), amount=F.col("amount_due"), route=F.lit("failed"),
                   selected=s.selected_notifications(F.col("feed"), F.lit("failed")), notes=F.array("note"))


def settlement_events(settled: DataFrame) -> DataFrame:
    """Settled payments; custom ones are routed elsewhere."""
    own = ~F.col("custom")
    notes = s.note_list(money.money_text(F.col("total"), F.col("currency")))
    return _events(settled, "settlement", lead_id=F.col("lead_id"), mark=F.lit(""), form_id=F.col("form_id"),
                   before=F.col("payment_status"), after=F.col("new_status"), amount=F.col("new_amount"),
                   route=F.when(own, F.col("outcome")),
                   selected=F.when(own, s.selected_notifications(F.col("feed"), F.col("outcome"))), notes=notes)


def correction_events(corrected: DataFrame, mark: Column) -> DataFrame:
    """Manual corrections, from `correct_payments`; `mark` tells one correction of an entry from another."""
    return _events(corrected.where("corrected"), "correction", lead_id=F.col("id"), mark=mark, form_id=F.col("form_id"),
                   after=F.col("payment_status"), amount=F.col("payment_amount"), notes=F.array(s.correction_text()))


def log_events(events: DataFrame, table: Segments, batch: int, stream: str = "log") -> None:
    """Append the events that are not in the log yet, as one batch; of events with one key the first by its columns."""
    keys = ["lead_id", "kind", "mark"]
    rest = [c for c in StructType.fromDDL(SCHEMA).names if c not in keys]
    once = first_per_key(events.select(*keys, *rest), keys, rest).persist()
    try:
        known = read_keys_like(once, table, but=(stream, batch)).select(*keys)
        append(once.join(known, keys, "left_anti"), table, batch, stream)
    finally:
        once.unpersist()


def read_events(spark: SparkSession, table: Segments) -> DataFrame:
    return read(spark, table)


def notes(events: DataFrame) -> DataFrame:
    """The notes, in their order within an event, and who left them."""
    return events.select("lead_id", "kind", "mark", "user_id", "user_name", F.posexplode("notes").alias("position", "text"))


def notifications(events: DataFrame, forms: DataFrame, hooks: Hooks = NO_HOOKS) -> DataFrame:
    """lead_id, route, notification_id of what is to be sent: the form's notifications that were selected for the event."""
    routed = events.where(F.col("route").isNotNull() & (F.size("selected") > 0))
    table = forms.select(F.col("id").alias("form_id"), "notifications")
    return s.notifications_to_send(routed.join(table, "form_id"), "route", hooks, selected="selected")


def transitions(events: DataFrame) -> DataFrame:
    """Counts and amounts by kind and the status before and after."""
    return events.groupBy("kind", "before", "after").agg(
        F.count(F.lit(1)).alias("events"), F.sum("amount").cast("double").alias("amount"))
