from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollbook.operators import settle as s
from tollbook.plans import payments as pay

ENTRY = ("id long, form_id long, payment_method string, payment_status string, payment_amount decimal(19,2),"
         " payment_date timestamp_ntz, is_fulfilled int, transaction_id string, transaction_type int, currency string,"
         " answers map<string,string>, hidden array<string>")
CALLBACK = ("event_id long, ts timestamp_ntz, lead_id long, status_arg string, no_arg string, result_code int,"
            " ref_id string")


@pytest.fixture(scope="module")
def world(spark):
    """Entries with none to many callbacks, a third of all callbacks on entry 3."""
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    feeds = [(1, 10, 1, json.dumps({"type": "subscription", "floor_policy": "sadt"})),
             (2, 20, 1, json.dumps({"type": "product", "floor_policy": "raygan"})), (3, 30, 1, json.dumps({"type": "product"}))]
    entries, meta, totals, calls = [], [], [], []
    for i in range(1, 61):
        method = rng.choice(["gateway", "gateway", "gateway", "other"])
        date = start if rng.random() < 0.2 else None
        entries.append((i, rng.choice([10, 20, 30]), method, "Processing", None, date, 0, None, None,
                        rng.choice(["IRR", "IRT"]), {}, []))
        kind = rng.choice(["form", "custom", None])
        if kind:
            meta.append((i, "payment_type", kind))
        if kind == "custom":
            meta.append((i, "part_price", f"{i}.50"))
        if rng.random() < 0.8:
            meta.append((i, "feed_id", str(rng.choice([1, 2, 3, 99]))))
        if rng.random() < 0.9:
            totals.append((i, Decimal(rng.choice([0, 50, 999, 5000]))))
        calls += [(i, n) for n in range(rng.choice([0, 1, 3]) if i != 3 else 60)]
    calls.append((0, 0))
    rng.shuffle(calls)
    callbacks = [(n, start + dt.timedelta(minutes=rng.randrange(40)), lead, rng.choice(["OK", "ok", "NOK", "", None]),
                  rng.choice(["", "", "true", None]), rng.choice([100, 100, -22, 5, None]), rng.choice(["R1", "", "0", None]))
                 for n, (lead, _) in enumerate(calls)]
    frames = (spark.createDataFrame(callbacks, CALLBACK), spark.createDataFrame(entries, ENTRY),
              spark.createDataFrame(meta, "lead_id long, meta_key string, meta_value string"),
              spark.createDataFrame(feeds, "id long, form_id long, is_active int, meta string"),
              spark.createDataFrame(totals, "lead_id long, total decimal(19,2)"))
    return frames, (callbacks, entries, meta, feeds, dict(totals))


def _by_hand(callbacks, entries, meta, feeds, totals):
    attributes = {(i, k): value for i, k, value in meta}
    settings = {f[0]: json.loads(f[3]) for f in feeds}
    settled = {}
    for event, ts, lead, status, no, code, ref in sorted(callbacks, key=lambda c: (c[1], c[0])):
        entry = next((e for e in entries if e[0] == lead), None)
        if lead == 0 or lead in settled or entry is None or entry[2] != "gateway" or entry[5]:
            continue
        custom = attributes.get((lead, "payment_type")) == "custom"
        feed = settings.get(int(attributes.get((lead, "feed_id"), 0)))
        if not custom and feed is None:
            continue
        if custom:
            total, kind = Decimal(attributes[lead, "part_price"]), 1
        else:
            total, kind = totals.get(lead, Decimal(0)), 2 if feed["type"] == "subscription" else 1
            least = {"IRR": 1000, "IRT": 100}[entry[9]]
            if "floor_policy" in feed and 0 < total < least:
                total = Decimal(least if feed["floor_policy"] == "sadt" else 0)
        free = no == "true"
        ok = (status or "").lower() == "ok"
        outcome = "completed" if free or (ok and code == 100) else "failed" if ok else "cancelled"
        if free:
            result = (None, None, None, None)
        elif outcome == "completed":
            result = ("Active" if kind == 2 else "Paid", total, 1, "gateway")
        else:
            result = ("Failed" if outcome == "failed" else "Cancelled", Decimal(0), 0, "gateway")
        settled[lead] = (event, outcome, *result, kind, None if free else ref if ref not in (None, "", "0") else "-")
    return settled


def test_settlement_by_hand(world):
    frames, plain = world
    rows = pay.settle_callbacks(*frames).collect()
    got = {r.lead_id: (r.event_id, r.outcome, r.new_status, r.new_amount, r.new_fulfilled, r.new_method,
                       r.new_transaction_type, None if r.is_free else r.new_transaction_id) for r in rows}
    assert len(rows) == len(got) and got == _by_hand(*plain)
    assert len({r.outcome for r in rows}) == 3 and any(r.is_free for r in rows) and any(r.custom for r in rows)


def test_settling_again_settles_nothing(world):
    (callbacks, entries, meta, feeds, totals), _ = world
    settled = pay.settle_callbacks(callbacks, entries, meta, feeds, totals)
    after = pay.settled_entries(entries, settled)
    assert after.count() == entries.count() and after.columns != []
    assert pay.settle_callbacks(callbacks, after, meta, feeds, totals).count() == 0


def test_notes(world):
    frames, _ = world
    settled = pay.settle_callbacks(*frames)
    notes = s.settlement_notes(settled).collect()
    rows = {r.lead_id: r for r in settled.collect()}
    activated = {i for i, r in rows.items() if r.outcome == "completed" and r.new_transaction_type == 2}
    assert len(notes) == len(rows) + len(activated)
    assert {n.lead_id for n in notes if n.text == s.NOTE_SUBSCRIPTION} == activated
    assert all(n.text == s.NOTE_FREE for n in notes if rows[n.lead_id].is_free and n.text != s.NOTE_SUBSCRIPTION)


def test_transitions_add_up(world):
    frames, _ = world
    settled = pay.settle_callbacks(*frames)
    assert sum(r.payments for r in s.transition_summary(settled).collect()) == settled.count()


def test_requests_by_rule_and_amount(spark):
    meta = {"type": "product", "desc_pm": "Entry {entry_id} of {form_title}", "customer_fields_desc": "7",
            "customer_fields_email": "5.3", "customer_fields_mobile": "6", "conditional_enabled": "1",
            "conditional_field_id": "1", "conditional_operator": "is", "conditional_value": "yes"}
    feeds = spark.createDataFrame([(1, 10, 0, json.dumps({"type": "off"})), (2, 10, 1, json.dumps(meta)),
                                   (3, 10, 1, json.dumps({"type": "later"}))], "id long, form_id long, is_active int, meta string")
    forms = spark.createDataFrame([(10, "Shop")], "id long, title string")
    said = {"input_1": " YES", "input_5_3": "a@b.c", "input_6": "0098 912", "input_7": "hello"}
    rows = [(1, said, []), (2, {**said, "input_1": "no"}, []), (3, said, ["1"]), (4, said, []), (5, {"input_1": "yes"}, [])]
    entries = spark.createDataFrame(
        [(i, 10, "other", None, None, None, 0, None, None, "IRT" if i == 5 else "IRR", a, h) for i, a, h in rows], ENTRY)
    totals = spark.createDataFrame([(i, Decimal(5000)) for i in (1, 2, 3, 5)], "lead_id long, total decimal(19,2)")
    sent = {r.id: tuple(r)[1:] for r in pay.payment_requests(entries, feeds, forms, totals).collect()}
    assert sent == {1: (Decimal("500.000"), "Entry 1 of Shop - hello", "a@b.c", "+98912"),
                    5: (Decimal("5000.000"), "Entry 5 of Shop", "", "")}
    paths = {r.id: (r.path, r.feed and r.feed.id) for r in pay.start_payments(entries, feeds, totals).collect()}
    assert paths == {1: ("pay", 2), 2: ("untouched", None), 3: ("untouched", None), 4: ("free", 2), 5: ("pay", 2)}


def test_corrections(spark):
    entries = spark.createDataFrame(
        [(i, 10, m, "Processing", Decimal(1), d, 0, "T", 1, "IRR", {}, []) for i, m, d in [
            (1, "gateway", None), (2, "other", None), (3, "gateway", dt.datetime(2020, 1, 1)), (4, "gateway", None)]], ENTRY)
    entries = entries.withColumn("date_created", F.lit(dt.datetime(2019, 5, 5)).cast("timestamp_ntz"))
    fixes = spark.createDataFrame(
        [(1, "Paid", Decimal("7.00"), "M1", "1380-04-24 02:00:00"), (2, "Paid", Decimal("7.00"), "M2", ""),
         (3, "", Decimal("8.00"), "M3", ""), (4, "Cancelled", None, None, None)],
        "id long, status string, amount decimal(19,2), transaction_id string, date_text string")
    rows = {r.id: (r.payment_status, r.payment_amount, r.transaction_id, r.payment_date, r.is_fulfilled, r.corrected)
            for r in s.correct_payments(entries, fixes, "+03:30").collect()}
    assert rows == {
        1: ("Paid", Decimal("7.00"), "M1", dt.datetime(2001, 7, 14, 22, 30), 1, True),
        2: ("Processing", Decimal("1.00"), "T", None, 0, False),
        3: ("Processing", Decimal("8.00"), "M3", dt.datetime(2020, 1, 1), 0, True),
        4: ("Cancelled", None, None, dt.datetime(2019, 5, 5), 0, True)}
