"""Settling a stream of callbacks: the first callback of an entry counts, for ever."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tollbook.operators import settle as s
from tollbook.operators.totals import GATEWAY
from tollbook.plans import payments as pay
from tollbook.sources.segments import FANOUT, Segments, append, read, read_keys_like
from tollbook.sources.tables import stream_name

SCHEMA = ("lead_id bigint, event_id bigint, ts timestamp_ntz, status_arg string, no_arg string, result_code int,"
          " ref_id string, outcome string, is_free boolean, message string")

# What a payment record holds besides: enough for `settled_entries`, notes and attributes.
PAYMENT_SCHEMA = (f"{SCHEMA}, form_id bigint, currency string, payment_status string, custom boolean,"
                  " total decimal(19,2), new_status string, new_amount decimal(19,2), new_fulfilled int, new_method string,"
                  " new_transaction_id string, new_transaction_type int")


class PaymentTables(NamedTuple):
    """What callbacks are settled against; read anew by each micro-batch."""

    entries: DataFrame
    meta: DataFrame
    feeds: DataFrame
    order_totals: DataFrame


def settled_table(path: str, fanout: int = FANOUT) -> Segments:
    """What is settled, in slots by lead: the callbacks of a batch look only into the slots of their leads.

    Records without `tables` have the same columns, the payment's being null.
    """
    return Segments(path, PAYMENT_SCHEMA, ("lead_id",), fanout=fanout)


def settle_batch(spark: SparkSession, callbacks: DataFrame, batch: int, path: str, gateway_name: str,
                 actions: Iterable[Callable[[DataFrame, int], None]] = (), stream: str = "s",
                 tables: PaymentTables | None = None, gateway: str = GATEWAY,
                 settings: tuple[str, ...] = pay.AMOUNT_SETTINGS, fanout: int = FANOUT) -> None:
    """Settle one micro-batch: its first callback per entry, unless an earlier batch settled the entry.

    With `tables` the rows are payment records, as `settle_callbacks` gives them, and callbacks that settle no open entry
    of the gateway are ignored. Without, they are the outcomes of the callbacks alone.
    `actions` get all that was matched, also the feed's `settings`.

    What was settled before is read only in the slots of this batch's leads, from a number of segments that grows
    with the logarithm of the batches, whatever the age of the leads. Everything on the path counts as settled but the
    rows of this very stream and batch, so a replay writes the same rows again in their place, and a stream that begins
    anew on an old path neither loses nor doubles an entry.
    """
    table = settled_table(path, fanout)
    first = s.first_callbacks(callbacks).persist()
    try:
        if first.isEmpty():
            return
        earlier = read_keys_like(first, table, but=(stream, batch)).select("lead_id")
        fresh = first.join(earlier, "lead_id", "left_anti")
        if tables is None:
            settled = s.with_outcome(fresh, gateway_name)
        else:
            settled = pay.settle_first_callbacks(
                fresh, *tables, gateway=gateway, gateway_name=gateway_name, settings=settings)
        types = StructType.fromDDL(PAYMENT_SCHEMA)
        kept = settled.select([
            (F.col(f.name) if f.name in settled.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in types])
        append(kept, table, batch, stream)
        for action in actions:
            action(settled, batch)
    finally:
        first.unpersist()


def start_settlement(callbacks: DataFrame, path: str, checkpoint: str, gateway_name: str = "Gateway",
                     actions: Iterable[Callable[[DataFrame, int], None]] = (), tables: PaymentTables | None = None,
                     gateway: str = GATEWAY, settings: tuple[str, ...] = pay.AMOUNT_SETTINGS, fanout: int = FANOUT,
                     **trigger) -> StreamingQuery:
    """Settle callbacks as they arrive, against `tables` if they are given.

    `actions` are called with each batch of settled rows, again if the batch is replayed. Batches are
    numbered by the checkpoint and known by it.
    """
    spark, stream = callbacks.sparkSession, stream_name(checkpoint)
    return (callbacks.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, batch: settle_batch(
                spark, df, batch, path, gateway_name, actions, stream, tables, gateway, settings, fanout))
            .trigger(**(trigger or {"availableNow": True})).start())


def read_settled(spark: SparkSession, path: str) -> DataFrame:
    """The outcomes."""
    return read_payments(spark, path).select(*StructType.fromDDL(SCHEMA).names)


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    """The payment records of a stream that settles against tables; notes and attributes follow from them by
    `settlement_notes` and `settled_attribute_keys`, the entries by `settled_entries`."""
    return read(spark, settled_table(path))
