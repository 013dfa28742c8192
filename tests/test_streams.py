"""Streams fed file by file against the batch results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tollbook.operators import settle as s, totals as t
from tollbook.plans import payments as pay
from tollbook.sources import site
from tollbook.sources.segments import listed
from tollbook.sources.tables import scan
from tollbook.streaming import settlement, totals


@pytest.fixture()
def files(spark, folder, tmp_path):
    """The events as one file per batch, later batches reaching back in time a little."""
    events = scan(spark, folder, "events")
    part = F.least(F.floor((F.col("event_id") + (F.col("event_id") % 7) * 10) / 300), F.lit(3))
    for n in range(4):
        events.where(part == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{n}"))
    return str(tmp_path / "in" / "*")


def _stream(spark, folder, files):
    return (spark.readStream.schema(scan(spark, folder, "events").schema)
            .option("maxFilesPerTrigger", 1).parquet(files))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_totals_equal_batch(spark, folder, files, tmp_path, grain):
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # a restart finds nothing new
        leads = site.event_leads(_stream(spark, folder, files))
        totals.start_totals(leads, path, checkpoint, grain, "+03:30").awaitTermination()
    batches = spark.read.parquet(path).select("batch").distinct().count()
    assert batches >= 4
    batch = t.bucket_totals(site.hourly_leads(spark, folder), grain, "+03:30", ("form_id", "payment_method"))
    key = "local_hour" if grain == "hour" else "local_day"
    wanted = batch.select("form_id", "payment_method", F.col(key).cast("timestamp_ntz"), "revenue", "transactions")
    assert _rows(totals.read_totals(spark, path)) == _rows(wanted)


def test_first_arrival_counts_for_ever(spark, folder, files, tmp_path):
    path, checkpoint = str(tmp_path / "settled"), str(tmp_path / "checkpoint")
    seen = []
    calls = site.event_callbacks(_stream(spark, folder, files))
    settlement.start_settlement(calls, path, checkpoint, actions=[lambda df, n: seen.append((n, df.count()))]).awaitTermination()
    settled = settlement.read_settled(spark, path)
    everyone = site.event_callbacks(scan(spark, folder, "events")).where("lead_id <> 0").select("lead_id").distinct()
    assert settled.count() == settled.select("lead_id").distinct().count() == everyone.count()
    assert sum(n for _, n in seen) == settled.count() and len(seen) >= 2
    before = _rows(settled)
    # A batch seen again, under its own number or as new data, adds nothing.
    replay = site.event_callbacks(spark.read.parquet(files.replace("*", "1")))
    settlement.settle_batch(spark, replay, 1, path, "Gateway")
    settlement.settle_batch(spark, replay, 9, path, "Gateway")
    assert len(before) == settlement.read_settled(spark, path).count()


def test_one_batch_equals_the_batch_job(spark, folder, tmp_path):
    calls = site.event_callbacks(scan(spark, folder, "events"))
    settlement.settle_batch(spark, calls, 0, str(tmp_path / "s"), "Gateway")
    wanted = s.with_outcome(s.first_callbacks(calls), "Gateway")
    got = settlement.read_settled(spark, str(tmp_path / "s"))
    assert _rows(got.select(*wanted.columns)) == _rows(wanted)


def test_payments_of_a_stream_equal_settle(spark, folder, tmp_path):
    """Callbacks in the order of their time, a batch each quarter: records, notes, attributes and entries of the batch job."""
    lines = scan(spark, folder, "lineitem")
    ends = lines.agg(F.percentile_approx("l_shipdate", [0.25, 0.5, 0.75])).first()[0]
    part = sum((F.col("l_shipdate") > F.lit(e)).cast("int") for e in ends)
    path = str(tmp_path / "payments")
    tables = settlement.PaymentTables(site.entries(spark, folder), site.lead_meta(spark, folder), site.feeds(spark, folder),
                                      t.order_totals(site.order_lines(spark, folder)))
    for n in [0, 1, 1, 2, 3, 0]:  # two batches are replayed
        settlement.settle_batch(spark, site.line_callbacks(lines.where(part == n)), n, path, "Gateway", tables=tables)
    wanted = pay.settle_callbacks(site.callbacks(spark, folder), *tables)
    got = settlement.read_payments(spark, path)
    assert 0 < got.count() < s.first_callbacks(site.callbacks(spark, folder)).count()
    assert _rows(got) == _rows(wanted.select(got.columns))
    for of in (s.settlement_notes, s.settled_attribute_keys, lambda df: pay.settled_entries(tables.entries, df).drop("answers")):
        assert _rows(of(got)) == _rows(of(wanted))


def test_an_empty_batch_writes_nothing(spark, folder, tmp_path):
    calls = site.event_callbacks(scan(spark, folder, "events")).limit(0)
    settlement.settle_batch(spark, calls, 0, str(tmp_path / "none"), "Gateway")
    assert not (tmp_path / "none").exists()


def test_a_new_checkpoint_on_an_old_path(spark, folder, files, tmp_path):
    path = str(tmp_path / "settled")
    calls = site.event_callbacks(scan(spark, folder, "events"))
    old, new = calls.where("event_id % 2 = 0"), calls
    settlement.settle_batch(spark, old, 0, path, "Gateway", stream="one")
    before = _rows(settlement.read_settled(spark, path))
    settlement.settle_batch(spark, new, 0, path, "Gateway", stream="two")
    settled = settlement.read_settled(spark, path)
    assert set(before) <= set(_rows(settled))
    assert settled.count() == settled.select("lead_id").distinct().count()
    assert settled.count() == new.where("lead_id <> 0").select("lead_id").distinct().count()


def test_totals_refuse_a_path_of_another_stream(spark, folder, files, tmp_path):
    path = str(tmp_path / "out")
    leads = lambda: site.event_leads(_stream(spark, folder, files))
    totals.start_totals(leads(), path, str(tmp_path / "one"), "day").awaitTermination()
    with pytest.raises(ValueError):
        totals.start_totals(leads(), path, str(tmp_path / "two"), "day")
    scopes = {r.scope for r in totals.read_scope_totals(spark, path).collect()}
    assert scopes == {"form_method", "form", "method", "site"}


def test_settling_through_folds_equals_settle(spark, folder, tmp_path):
    """Many small batches, some replayed, each key table folded on the way: every entry settles once."""
    calls = site.event_callbacks(scan(spark, folder, "events"))
    path, wanted = str(tmp_path / "settled"), s.first_callbacks(calls)
    hours = [r.h for r in calls.select(F.date_trunc("day", "ts").alias("h")).distinct().orderBy("h").collect()][:12]
    for n, day in enumerate(hours):
        some = calls.where(F.date_trunc("day", "ts") == F.lit(day))
        for _ in range(2 if n % 5 == 4 else 1):
            settlement.settle_batch(spark, some, n, path, "Gateway", fanout=2)
    state = listed(spark, settlement.settled_table(path, 2))
    assert max(x["level"] for x in state["segments"]) >= 2
    settled = settlement.read_settled(spark, path)
    upto = wanted.where(F.date_trunc("day", "ts") <= F.lit(hours[-1]))
    assert _rows(settled.select("lead_id", "event_id")) == _rows(upto.select("lead_id", "event_id"))


def test_scope_totals_through_folds(spark, folder, tmp_path):
    path = str(tmp_path / "out")
    leads = site.hourly_leads(spark, folder)
    for n in range(7):
        totals.append(totals.batch_sums(leads.where(F.col("id") % 7 == n), "day", "+03:30"), totals.sums_table(path, 2), n, "s")
    wanted = t.scope_rollup(t.bucket_facts(leads, "day", "+03:30", ("form_id", "payment_method")), "local_day")
    wanted = wanted.withColumn("local_day", F.col("local_day").cast("timestamp_ntz")).withColumnRenamed("local_day", "bucket")
    got = totals.read_scope_totals(spark, path)
    assert _rows(got) == _rows(t.money_as_double(wanted, "revenue").select(*got.columns))
