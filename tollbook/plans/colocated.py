"""Settling over tables that are kept bucketed by lead.

Entries, attributes and order lines are written once in as many buckets of the lead as a shuffle has partitions. A
settlement then shuffles only its callbacks. Which leads they settle is found first, and attributes and lines of other
leads are left out as they are read, before anything is sorted or summed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from tollbook.operators import settle as s
from tollbook.operators.totals import GATEWAY, order_totals
from tollbook.plans import payments as pay
from tollbook.sources.tables import write_bucketed


class LeadTables(NamedTuple):
    """Names of tables in the catalog, all with the same number of buckets."""

    entries: str
    meta: str
    lines: str


def write_lead_tables(entries: DataFrame, meta: DataFrame, lines: DataFrame, name: str, path: str,
                      buckets: int | None = None) -> LeadTables:
    """Keep the tables under `name` and `path`.

    With fewer buckets than a shuffle has partitions, Spark would rather shuffle all sides; hence the default.
    """
    spark = entries.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = LeadTables(f"{name}_entries", f"{name}_meta", f"{name}_lines")
    for table, rows, key in zip(tables, (entries, meta, lines), ("id", "lead_id", "lead_id")):
        # A bucket is one file of one task, not a file of each.
        write_bucketed(rows.repartition(buckets, key), table, f"{path}/{table}", key, buckets)
    return tables


def drop_lead_tables(spark: SparkSession, tables: LeadTables) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def settle_colocated(callbacks: DataFrame, tables: LeadTables, feeds: DataFrame, gateway: str = GATEWAY,
                     **options) -> DataFrame:
    """What `settle_callbacks` gives, over bucketed tables.

    The leads to be settled are looked up by hash in each bucket; they are ids, as many as there are first callbacks.
    """
    spark = callbacks.sparkSession
    entries, meta, lines = (spark.table(t) for t in tables)
    first = s.first_callbacks(callbacks)
    open_leads = pay.open_entries(entries, gateway).select(F.col("id").alias("lead_id"))
    concerned = first.select("lead_id").hint("shuffle_hash").join(open_leads, "lead_id", "left_semi").hint("shuffle_hash")
    wanted = pay.settlement_meta(meta).join(concerned, "lead_id", "left_semi")
    totals = order_totals(lines.join(concerned, "lead_id", "left_semi"))
    return pay.settle_first_callbacks(first, entries, wanted, feeds, totals, gateway=gateway, **options)
