"""The transition log, custom payments and hooks, on rows made by hand."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import catalog
from conftest import plan_of
from test_settle import CALLBACK, ENTRY
from tollbook.operators import hooks as hk, settle as s, transitions as tr
from tollbook.operators.entries import update_post_status
from tollbook.plans import payments as pay

import datetime as dt

START = dt.datetime(2024, 1, 1)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def site(spark):
    feed = {"type": "product", "notif_1": ["a"], "notif_2": ["b", "c"], "notif_3": ["c", "z"], "notif_4": []}
    feeds = spark.createDataFrame([(1, 10, 1, json.dumps(feed))], "id long, form_id long, is_active int, meta string")
    forms = spark.createDataFrame([(10, "Shop", ["a", "b", "c"])], "id long, title string, notifications array<string>")
    entries = spark.createDataFrame(
        [(i, 10, "gateway", None, None, None, 0, None, None, "IRR", {}, []) for i in range(1, 7)], ENTRY)
    meta = spark.createDataFrame(
        [(i, "feed_id", "1") for i in range(1, 6)] + [(6, "part_price_10", "7000.00"), (6, "part_price_11", "1.00"),
         (6, "part_price_10", "5000.00"), (6, "part_mobile_10", "0912"), (5, "part_price_11", "9.00"), (5, "part_price", "8")],
        "lead_id long, meta_key string, meta_value string")
    totals = spark.createDataFrame([(i, Decimal(5000)) for i in (1, 2, 3)], "lead_id long, total decimal(19,2)")
    calls = spark.createDataFrame([(1, START, 1, "OK", "", 100, "R1"), (2, START, 2, "NOK", "", None, ""), (3, START, 3, "OK", "", -22, "")],
                                  CALLBACK)
    replies = spark.createDataFrame([(1, 100), (2, 100), (3, -2), (4, -2)], "id long, code int")
    return feeds, forms, entries, meta, totals, calls, replies


def test_log_notes_and_routes(spark, site, tmp_path):
    feeds, forms, entries, meta, totals, calls, replies = site
    opened = pay.start_payments(entries, feeds, totals, settings=pay.NOTIFICATION_SETTINGS)
    settled = pay.settle_callbacks(calls, entries, meta, feeds, totals, settings=pay.NOTIFICATION_SETTINGS)
    events = tr.request_events(opened).unionByName(tr.reply_events(opened, replies, "G")).unionByName(tr.settlement_events(settled))
    table = tr.event_table(str(tmp_path / "log"), fanout=2)
    tr.log_events(events.unionByName(events), table, 0)
    before = _rows(tr.read_events(spark, table))
    assert len(before) == 3 + 1 + 3  # entry 4 to 6 have nothing to pay
    for batch in (0, 1, 2, 3, 4):  # replays, as the same batch and as others, with folds between
        tr.log_events(events, table, batch)
    assert _rows(tr.read_events(spark, table)) == before
    log = tr.read_events(spark, table)
    sent = _rows(tr.notifications(log, forms))
    assert sent == sorted([(1, "submit", "a"), (2, "submit", "a"), (3, "submit", "a"), (3, "failed", "c"), (1, "completed", "b"),
                           (1, "completed", "c"), (3, "failed", "c")], key=str)
    notes = tr.notes(log)
    assert {(r.user_id, r.user_name) for r in notes.collect()} == {tr.GUEST}
    assert _rows(notes.where("kind = 'settlement'").select("lead_id", "position", "text")) == _rows(s.settlement_notes(settled))
    assert notes.where("kind = 'reply'").count() == 1 and sum(r.events for r in tr.transitions(log).collect()) == len(before)
    only_b = hk.Hooks().on("send_notification", lambda n, status: n == "b")
    assert _rows(tr.notifications(log, forms, only_b)) == [(1, "completed", "b")]


def test_two_corrections_of_an_entry_are_two_events(spark, site, tmp_path):
    _, _, entries, *_ = site
    rows = entries.withColumns({"date_created": F.col("payment_date"), "corrected": F.col("id") == 2, "user_id": F.lit(5), "user_name": F.lit("x")})
    table = tr.event_table(str(tmp_path / "log"))
    for batch, mark in enumerate(["one", "two", "one"]):
        tr.log_events(tr.correction_events(rows, F.lit(mark)), table, batch)
    assert _rows(tr.read_events(spark, table).select("lead_id", "mark", "user_id", "user_name")) == [(2, "one", 5, "x"), (2, "two", 5, "x")]


def test_custom_payments_end_to_end(spark, site):
    feeds, _, entries, meta, totals, *_ = site
    opened = pay.start_custom_payments(entries, meta)
    # Only entry 6 has a price for its own form; of two the larger text counts.
    assert _rows(opened.select("id", "from_id", "amount_due", "payment_status", "transaction_type")) == [
        (7, 6, Decimal("7000.00"), "Processing", 1)]
    assert _rows(s.custom_payload(opened)) == [(7, Decimal("7000.000"), "", "", "0912")]
    attributes = s.custom_attributes(opened, "G")
    assert _rows(attributes) == [(7, "part_mobile_10", "0912"), (7, "part_price_10", "7000.00"), (7, "payment_gateway", "G"),
                                 (7, "payment_type", "custom")]
    calls = spark.createDataFrame([(9, START, 7, "OK", "", 100, "R"), (10, START, 5, "OK", "", 100, "R")], CALLBACK)
    every = entries.unionByName(opened.select(*entries.columns))
    settled = pay.settle_callbacks(calls, every, meta.unionByName(attributes), feeds, totals)
    assert _rows(settled.select("lead_id", "custom", "new_status", "new_amount")) == [
        (5, False, "Paid", Decimal("0.00")), (7, True, "Paid", Decimal("7000.00"))]
    gone = s.visited_attribute_keys(calls, every)
    assert _rows(gone) == [(5, "payment_type"), (7, "payment_type")]
    hooked = pay.start_custom_payments(entries, meta, hooks=hk.Hooks().on("custom_price", lambda p: p + 1).on("price_10", lambda p: p * 2))
    assert hooked.first().amount_due == Decimal("14002.00")


def test_the_last_decision_on_a_post_counts(spark):
    posts = spark.createDataFrame([(1, "draft"), (2, "draft"), (3, "draft")], "id long, post_status string")
    decided = spark.createDataFrame([(1, "publish", 2, 9), (1, "private", 3, 1), (1, "pending", 3, 0), (2, "draft", 1, 1)],
                                    "id long, new_status string, ts int, lead_id long")
    assert _rows(update_post_status(posts, decided)) == [(1, "private", True), (2, "draft", False), (3, "draft", False)]


def test_events_are_made_once(spark, folder, monkeypatch):
    """Logging twice reads events that are kept; neither time joins the site's tables again."""
    plans, log_events = [], tr.log_events

    def logged(events, *args):
        plans.append(plan_of(events))
        log_events(events, *args)

    monkeypatch.setattr(tr, "log_events", logged)
    if not catalog.QUERIES:
        catalog.load()
    assert catalog.QUERIES["transition_log"](spark, folder).count() > 0
    assert len(plans) == 2 and not any("Join" in p or "Exchange" in p for p in plans)
