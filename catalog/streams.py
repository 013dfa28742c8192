"""The streaming jobs, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import ORACLES, payments as batch, query
from catalog.reports import scope_sums
from catalog.views import HOURLY, MESSAGES, PAID, sql
from tollbook.operators.totals import order_totals
from tollbook.session import new_path
from tollbook.sources import site
from tollbook.sources.tables import scan
from tollbook.streaming import settlement, totals


def _stream(spark, folder, table="events"):
    schema = scan(spark, folder, table).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def _stream_totals(grain):
    def run(spark, folder):
        path, checkpoint = new_path(spark, "totals"), new_path(spark, "totals-checkpoint")
        leads = site.event_leads(_stream(spark, folder))
        totals.start_totals(leads, path, checkpoint, grain, "+03:30").awaitTermination()
        return totals.read_totals(spark, path)
    return run


def _sums(grain):
    return sql(HOURLY, PAID, f"""
SELECT form_id, payment_method, CAST(date_trunc('{grain}', payment_date + INTERVAL '210 minutes') AS TIMESTAMP) AS bucket,
  CAST(sum(payment_amount) AS DOUBLE) AS revenue, count(id) AS transactions FROM paid GROUP BY ALL""")


query("stream_totals", _sums("hour"))(_stream_totals("hour"))
query("stream_daily_totals", _sums("day"))(_stream_totals("day"))


def _runs(spark, folder, table, order, parts=4):
    """The table as folders of files that arrive one after another, each with rows later than the one before."""
    rows, source = scan(spark, folder, table), new_path(spark, f"arriving-{table}")
    ends = rows.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)])).first()[0]
    place = sum((F.col(order) > F.lit(end)).cast("int") for end in ends)
    for n in range(parts):
        rows.where(place == n).write.mode("append").parquet(source)
        yield spark.readStream.schema(rows.schema).parquet(source)


def _stream_scopes(grain):
    def run(spark, folder):
        """The stream in several runs, with folds between them."""
        path, checkpoint = new_path(spark, "totals"), new_path(spark, "totals-checkpoint")
        for arrived in _runs(spark, folder, "events", "ts"):
            totals.start_totals(site.event_leads(arrived), path, checkpoint, grain, "+03:30", fanout=2).awaitTermination()
        return totals.read_scope_totals(spark, path)
    return run


query("stream_scope_totals", scope_sums(HOURLY, "hour", "bucket", "TIMESTAMP"))(_stream_scopes("hour"))
query("stream_daily_scope_totals", scope_sums(HOURLY, "day", "bucket", "TIMESTAMP"))(_stream_scopes("day"))


@query("stream_outcomes", sql(MESSAGES, """
firsts AS (SELECT * FROM events WHERE user_id <> 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
coded AS (SELECT *, CASE event_type WHEN 'purchase' THEN 100 WHEN 'error' THEN
    CASE event_id % 4 WHEN 0 THEN -1 WHEN 1 THEN -22 WHEN 2 THEN -33 ELSE 7 END END AS reply FROM firsts)""", """
SELECT user_id AS lead_id, event_id, ts,
  CASE event_type WHEN 'signup' THEN 'completed' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'cancelled' END AS outcome,
  event_type = 'signup' AS is_free, CASE WHEN event_type = 'error' THEN coalesce(message, ' ') ELSE '' END AS message
FROM coded LEFT JOIN messages ON code = reply"""))
def stream_outcomes(spark, folder):
    """What the first callback of each entry says, without a look at the entries."""
    path, checkpoint = new_path(spark, "settled"), new_path(spark, "settled-checkpoint")
    calls = site.event_callbacks(_stream(spark, folder))
    settlement.start_settlement(calls, path, checkpoint).awaitTermination()
    return settlement.read_settled(spark, path).select("lead_id", "event_id", "ts", "outcome", "is_free", "message")


def _payment_tables(spark, folder):
    return settlement.PaymentTables(site.entries(spark, folder), site.lead_meta(spark, folder), site.feeds(spark, folder),
                                    order_totals(site.order_lines(spark, folder)))


@query("stream_settle", ORACLES["settle"])
def stream_settle(spark, folder):
    """The records of `settle`, from a stream of its callbacks."""
    path, checkpoint = new_path(spark, "settled"), new_path(spark, "settled-checkpoint")
    calls = site.line_callbacks(_stream(spark, folder, "lineitem"))
    settlement.start_settlement(calls, path, checkpoint, tables=_payment_tables(spark, folder)).awaitTermination()
    return batch.payment_records(settlement.read_payments(spark, path))


@query("stream_payments", ORACLES["settle"])
def stream_payments(spark, folder):
    """The same from several runs, with folds of what is settled between them."""
    path, checkpoint = new_path(spark, "payments"), new_path(spark, "payments-checkpoint")
    for arrived in _runs(spark, folder, "lineitem", "l_shipdate"):
        settlement.start_settlement(site.line_callbacks(arrived), path, checkpoint, tables=_payment_tables(spark, folder),
                                    fanout=2).awaitTermination()
    return batch.payment_records(settlement.read_payments(spark, path))
