"""Entry views and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tollbook.functions import calendar as cal, money, status as st
from tollbook.operators.joins import first_per_key
from tollbook.operators.totals import GATEWAY


def entry_detail(entries: DataFrame, order_totals: DataFrame, offset: str | float,
                 gateway: str = GATEWAY) -> DataFrame:
    """One readable row per payment of the gateway; a missing amount is the order total."""
    own = entries.where(F.col("payment_method") == gateway)
    joined = own.join(order_totals.withColumnRenamed("lead_id", "id"), "id", "left")
    amount = F.coalesce(F.nullif(F.col("payment_amount"), F.lit(0)), F.col("total"), F.lit(0)).cast(money.MONEY)
    return joined.select(
        "id", st.status_label(F.col("payment_status")).alias("status_label"),
        cal.jalali_datetime_text(cal.to_local(F.col("payment_date"), offset)).alias("local_date"),
        money.money_text(amount, F.col("currency")).alias("amount_text"), "transaction_id")


def latest_per_key(rows: DataFrame, key: str, order: str, tiebreak: str) -> DataFrame:
    """The newest row of each key."""
    return first_per_key(rows, [key], [order, tiebreak], last=True)


def latest_one(rows: DataFrame, key: str, value, order: str, tiebreak: str) -> DataFrame:
    """The newest row of one key; the one row wanted is the feature."""
    return rows.where(F.col(key) == value).orderBy(F.col(order).desc(), F.col(tiebreak).desc()).limit(1)


def update_post_status(posts: DataFrame, decided: DataFrame) -> DataFrame:
    """Set the decided status (id, new_status); `changed` marks the rows that had another before.

    Of several decisions on a post the last by the other columns of `decided`, in their order, counts, and then by status.
    """
    order = [c for c in decided.columns if c not in ("id", "new_status")] + ["new_status"]
    last = first_per_key(decided, ["id"], order, last=True).select("id", "new_status")
    joined = posts.join(last, "id", "left")
    changed = F.coalesce(F.col("new_status") != F.col("post_status"), F.lit(False))
    return joined.select("id", F.coalesce("new_status", "post_status").alias("post_status"), changed.alias("changed"))
