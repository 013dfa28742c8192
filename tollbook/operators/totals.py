"""Payment totals: the paid filter, the four scopes, and buckets of local time.

`leads` needs form_id, status, is_fulfilled, payment_method, payment_amount and payment_date (UTC
without zone). Money is summed as a decimal, so the result does not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.functions import calendar as cal

SCOPES = ("form_method", "form", "method", "site")
GATEWAY = "gateway"


def is_paid() -> Column:
    return (F.col("status") == "active") & (F.col("is_fulfilled") == 1)


def paid(leads: DataFrame) -> DataFrame:
    return leads.where(is_paid())


def scope_filter(leads: DataFrame, scope: str, form_id: int | None = None, gateway: str = GATEWAY) -> DataFrame:
    """The leads of one scope; a form is only needed by the two form scopes."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}")
    if "form" in scope and form_id is not None:
        leads = leads.where(F.col("form_id") == form_id)
    if "method" in scope:
        leads = leads.where(F.col("payment_method") == gateway)
    return leads


def scope_rows(leads: DataFrame, gateway: str = GATEWAY) -> DataFrame:
    """Every paid lead once for each scope it counts in."""
    by_method = F.col("payment_method") == gateway
    scopes = F.filter(F.array(*[F.when(by_method, F.lit(s)) if "method" in s else F.lit(s) for s in SCOPES]),
                      lambda s: s.isNotNull())
    return paid(leads).withColumn("scope", F.explode(scopes))


def _counted() -> list[Column]:
    return [F.sum("payment_amount").alias("revenue"), F.count("id").alias("transactions")]


def money_as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def totals(leads: DataFrame, scope: str, form_id: int | None = None, gateway: str = GATEWAY) -> DataFrame:
    """All-time revenue and transactions by status in one scope.

    Without a form the form scopes give a row per form, which is one pass instead of one per form.
    """
    keys = (["form_id"] if "form" in scope else []) + ["status"]
    selected = scope_filter(paid(leads), scope, form_id, gateway)
    return (selected.groupBy(*keys).agg(*_counted())
            .withColumn("revenue", F.coalesce(F.col("revenue"), F.lit(0)).cast("double")))


def scope_rollup(facts: DataFrame, *extra: str) -> DataFrame:
    """Roll (form, method) sums up to the four scopes, apart for each value of `extra`.

    Every other column is a sum and is summed on.
    """
    keys = ["form_id", "payment_method"]
    sets = [[*extra, *s] for s in (keys, keys[:1], keys[1:], [])]
    summed = [F.sum(c).alias(c) for c in facts.columns if c not in keys and c not in extra]
    rolled = facts.groupingSets(sets, *extra, *keys).agg(
        F.grouping("form_id").alias("_any_form"), F.grouping("payment_method").alias("_any_method"), *summed)
    # The grouping flags tell a rolled-up key from a key that is null in the data.
    scope = (F.when((F.col("_any_form") == 0) & (F.col("_any_method") == 0), "form_method")
             .when(F.col("_any_form") == 0, "form").when(F.col("_any_method") == 0, "method").otherwise("site"))
    return rolled.withColumn("scope", scope).drop("_any_form", "_any_method")


def totals_cube(leads: DataFrame) -> DataFrame:
    """The totals of all forms and methods in all four scopes, from one scan.

    Rows are summed by (form, method) first, so only those few sums are repeated per scope.
    """
    facts = paid(leads).groupBy("form_id", "payment_method").agg(*_counted())
    rolled = scope_rollup(facts)
    return money_as_double(rolled.select("scope", "form_id", "payment_method", "revenue", "transactions"), "revenue")


def bucket(grain: str, offset: str | float) -> dict[str, Column]:
    """The grouping columns of a time grain in local time."""
    local = cal.to_local(F.col("payment_date"), offset)
    if grain == "day":
        return {"local_day": F.to_date(local)}
    if grain == "hour":
        return {"local_hour": cal.local_hour(F.col("payment_date"), offset)}
    if grain == "hour_dom":
        # Hour and day of month only: the same hour of two months falls together.
        return {"hour": F.hour(local), "dom": F.dayofmonth(local)}
    if grain == "instant":
        return {"local_ts": local}
    raise ValueError(f"unknown grain {grain!r}")


def bucket_facts(leads: DataFrame, grain: str, offset: str | float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Paid sums per time bucket and `keys`, revenue still a decimal."""
    buckets = bucket(grain, offset)
    return paid(leads).withColumns(buckets).groupBy(*keys, *buckets).agg(*_counted())


def daily_facts(leads: DataFrame, offset: str | float) -> DataFrame:
    """Paid sums per (form, method, local day): what every window and report is made from.

    Kept as a table it spares a report the payments themselves.
    """
    return bucket_facts(leads, "day", offset, ("form_id", "payment_method"))


def bucket_totals(leads: DataFrame, grain: str, offset: str | float, keys: tuple[str, ...] = ()) -> DataFrame:
    return money_as_double(bucket_facts(leads, grain, offset, keys), "revenue")


def scope_totals(leads: DataFrame, grain: str, offset: str | float) -> DataFrame:
    """Sums per time bucket in all four scopes, from one scan."""
    name = next(iter(bucket(grain, offset)))
    rolled = scope_rollup(bucket_facts(leads, grain, offset, ("form_id", "payment_method")), name)
    return money_as_double(rolled.select("scope", "form_id", "payment_method", name, "revenue", "transactions"), "revenue")


def order_totals(lines: DataFrame) -> DataFrame:
    """Order total per lead from its lines of price and quantity, never below zero."""
    total = F.sum(F.col("price") * F.col("quantity"))
    return lines.groupBy("lead_id").agg(F.greatest(total, F.lit(0)).cast("decimal(19,2)").alias("total"))
