"""Running totals over a stream of leads: partial sums per micro-batch, added up when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tollbook.operators import totals as t
from tollbook.sources.segments import FANOUT, Segments, append, listed, read
from tollbook.sources.tables import stream_name

SCHEMA = ("form_id bigint, payment_method string, bucket timestamp_ntz, revenue decimal(29,2),"
          " transactions bigint")
KEY = ("form_id", "payment_method", "bucket")


def batch_sums(leads: DataFrame, grain: str, offset: str | float) -> DataFrame:
    """Paid sums of one micro-batch per (form, method) and hour or day of local time."""
    (start,) = t.bucket(grain, offset).values()
    return t.paid(leads).groupBy("form_id", "payment_method", start.cast("timestamp_ntz").alias("bucket")).agg(
        F.sum("payment_amount").cast("decimal(29,2)").alias("revenue"), F.count("id").alias("transactions"))


def add_up(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*KEY).agg(
        F.sum("revenue").cast("decimal(29,2)").alias("revenue"), F.sum("transactions").alias("transactions"))


def sums_table(path: str, fanout: int = FANOUT) -> Segments:
    """The sums of every batch; those of old batches are folded into one sum for each key."""
    return Segments(path, SCHEMA, KEY, slots=16, fanout=fanout, fold=add_up)


def start_totals(leads: DataFrame, path: str, checkpoint: str, grain: str = "hour", offset: str | float = 0,
                 go_on: bool = False, fanout: int = FANOUT, **trigger) -> StreamingQuery:
    """Write the sums of every micro-batch under its stream and number.

    Buckets are added up when they are read, so there is no watermark and no state: a payment that is months late
    counts like any other, and a replayed batch replaces itself. Old batches are folded into sums, so what a reader adds up
    grows with the buckets, not with the batches. A path that another stream has begun is refused, as the
    new stream may read the same payments again; `go_on` says that it reads only new ones.
    """
    spark, stream, table = leads.sparkSession, stream_name(checkpoint), sums_table(path, fanout)
    state = listed(spark, table)
    others = {s["stream"] for s in state["segments"]} | set(state["folded"])
    if not go_on and others - {stream, None}:
        raise ValueError(f"{path} was begun by another stream")
    return (leads.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, batch: append(batch_sums(df, grain, offset), table, batch, stream))
            .trigger(**(trigger or {"availableNow": True})).start())


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The sums of every bucket."""
    return t.money_as_double(add_up(read(spark, sums_table(path))), "revenue")


def read_scope_totals(spark: SparkSession, path: str) -> DataFrame:
    """The sums of every bucket in all four scopes."""
    return t.money_as_double(t.scope_rollup(add_up(read(spark, sums_table(path))), "bucket"), "revenue")
