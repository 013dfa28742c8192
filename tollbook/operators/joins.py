"""Equi joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000


def lookup_join(rows: DataFrame, table: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join many rows to a smaller table that has one row per key.

    Nothing is measured beforehand. Adaptive execution knows the table's true size once it has been made: up to
    `spark.sql.adaptive.autoBroadcastJoinThreshold` it is broadcast, beyond that the partitions of keys that hold
    many rows are split.
    """
    return rows.join(table, on, how)


def hot_key_join(rows: DataFrame, table: DataFrame, on: str, how: str = "left", *,
                 spread_by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join rows with repeated keys to a table of like size that has one row per key.

    A key with more than `hot_rows` rows is spread over as many salts as it has times that many, and its
    table row is repeated for each. A salt is a hash of the row's own columns, so a retried task lands on the same one.
    """
    counted = rows.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = counted.select(on, F.ceil(F.col("_n") / hot_rows).alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))
    salted_rows = rows.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts)).drop("_salts")
    salted_table = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
    return salted_rows.join(salted_table, [on, "_salt"], how).drop("_salt")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], *, last: bool = False) -> DataFrame:
    """The first (or last) row of each key by the `order` columns.

    The smallest whole row, the order columns leading, as an aggregate rather than a sorted window:
    every map task keeps one row per key before the shuffle, so a key with most of the rows costs no
    more than any other. The remaining columns break ties, so equal orders still give one answer.
    """
    columns = [*order, *[c for c in rows.columns if c not in keys and c not in order]]
    pick = F.max if last else F.min
    picked = rows.groupBy(*keys).agg(pick(F.struct(*columns)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*rows.columns)
