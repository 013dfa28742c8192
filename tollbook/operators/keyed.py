"""Keyed maintenance of tables: change sets applied as joins, giving the table's next version."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.operators.joins import first_per_key
from tollbook.session import new_path

ID_BLOCK = 1_000_000

#: A row's place in its partition, in the lower bits of an id that increases within it.
LAST_RANK = (1 << 33) - 1


def upsert(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `changes`, one per key, replace the base rows of their key or are added."""
    kept = base.join(changes.select(*key), list(key), "left_anti")
    return kept.unionByName(changes.select(*base.columns))


def latest_changes(changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One change per key, the last one."""
    return first_per_key(changes, key, order, last=True)


def delete_keys(base: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop the base rows whose key is listed."""
    return base.join(keys.distinct(), keys.columns, "left_anti")


def set_columns(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite only the columns that `changes` (one row per key) has, and only where it has a value."""
    columns = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(renamed, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns])


def number_rows(rows: DataFrame, order: str, name: str, after: Column | int, block: int = ID_BLOCK) -> DataFrame:
    """Number rows from `after` + 1 in the order of a unique column.

    A prefix sum over ranges. The rows are dealt to ranges of the order of about `block` rows each, however far apart its
    values lie, ranked inside their range and written. One count for each range comes to the driver, and the rows of
    the ranges before are added. No task sees more than its range.
    """
    spark = rows.sparkSession
    ranges = max(1, -(-rows.count() // block))
    placed = rows.repartitionByRange(ranges, order).sortWithinPartitions(order).withColumns({
        "_range": F.spark_partition_id(),
        "_rank": F.monotonically_increasing_id().bitwiseAND(F.lit(LAST_RANK)) + 1})
    path = new_path(spark, "numbered")
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    sizes = sorted((r["_range"], r["n"]) for r in written.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    table = spark.createDataFrame([(part, start) for (part, _), start in zip(sizes, starts)], "_range int, _start long")
    # One row for each range.
    numbered = written.join(F.broadcast(table), "_range")
    return numbered.select(*rows.columns, (F.col("_start") + F.col("_rank") + after).alias(name))


def largest(base: DataFrame, column: str) -> int:
    """The largest value of a column, 0 for an empty table."""
    return base.agg(F.max(column)).first()[0] or 0


def upsert_with_ids(base: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """Upsert where key 0 asks for a new one, numbered on from the largest in the table.

    New numbers are above every one in use, so only the changes of known keys replace base rows.
    """
    fresh = number_rows(changes.where(F.col(key) == 0).drop(key), order, key, largest(base, key))
    fresh = fresh.withColumn(key, F.col(key).cast(base.schema[key].dataType))
    known = latest_changes(changes.where(F.col(key) != 0), [key], [order])
    return upsert(base, known, [key]).unionByName(fresh.select(*base.columns))


def pivot_meta(meta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key/value attributes as one column per known key."""
    return meta.where(F.col("meta_key").isin(*keys)).groupBy("lead_id").pivot("meta_key", list(keys)).agg(
        F.max("meta_value"))


def upsert_meta(meta: DataFrame, changes: DataFrame) -> DataFrame:
    return upsert(meta, changes, ["lead_id", "meta_key"])


def delete_meta(meta: DataFrame, keys: DataFrame) -> DataFrame:
    return delete_keys(meta, keys.select("lead_id", "meta_key"))
