"""The statistics report: six tiles per scope and window, from one pass over the payments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tollbook.functions import windows as win
from tollbook.operators import totals as t, windows as w
from tollbook.operators.totals import GATEWAY

ALL_TIME = "all"
SUMS = {"revenue": "DOUBLE", "transactions": "BIGINT"}
#: Days and forms, about, that a task makes wide rows of. A wide row takes kilobytes in an aggregate's memory, but a few bytes in
#: the shuffle before it, so that the size of the shuffle is no guide to the number of tasks.
ROWS_IN_TASK = 100_000


def report(leads: DataFrame, forms: DataFrame, as_of: dt.date, offset: str | float, **options) -> DataFrame:
    return report_from_daily(t.daily_facts(leads, offset), forms, as_of, rows=leads.count(), **options)


def form_report(leads: DataFrame, forms: DataFrame, form_id: int, as_of: dt.date, offset: str | float,
                **options) -> DataFrame:
    """The report of one form, next to the scopes of all forms. An unknown form is an error."""
    own = forms.where(F.col("id") == form_id)
    if own.isEmpty():
        raise ValueError(f"there is no form {form_id}")
    rows = report(leads, own, as_of, offset, **options)
    return rows.where((F.col("form_id") == form_id) | F.col("scope").isin("method", "site"))


def report_from_daily(daily: DataFrame, forms: DataFrame, as_of: dt.date, names: Sequence[str] | None = None,
                      gateway: str = GATEWAY, selection: tuple[dt.date, dt.date] | None = None, rows: int | None = None,
                      **options) -> DataFrame:
    """All-time and window revenue, payments and averages, zero where nothing was paid.

    The days of a (form, method) are summed into one wide row, two sums per window, and those rows
    are rolled up to the scopes; no row is repeated per window before the end. A form without
    payments enters as an empty row, so no join with the forms is needed. `rows` says how many days of forms there are at
    most; without it they are counted.
    """
    names = list(names or win.names_for(selection))
    ranges = {n: win.known_range(n, as_of, selection, **options) for n in names}
    sums = {_name(c, ALL_TIME): f"sum({c})" for c in SUMS}
    for name, (lo, hi) in ranges.items():
        inside = f"local_day BETWEEN date'{lo}' AND date'{hi}'"
        sums.update({_name(c, name): f"sum(CASE WHEN {inside} THEN {c} END)" for c in SUMS})
    empty = forms.select(F.col("id").cast(daily.schema["form_id"].dataType).alias("form_id"),
                         F.lit(gateway).alias("payment_method"))
    tasks = max(1, -(-((daily.count() if rows is None else rows) + forms.count()) // ROWS_IN_TASK))
    dealt = daily.unionByName(empty, allowMissingColumns=True).repartition(tasks, "form_id", "payment_method")
    facts = dealt.groupBy("form_id", "payment_method").agg(*[F.expr(s).alias(n) for n, s in sums.items()])
    rolled = t.scope_rollup(facts)
    own = rolled.where(F.col("payment_method").eqNullSafe(gateway) | F.col("scope").isin("form", "site"))
    return _tiles(own, {n: win.divisor(n, *r) for n, r in ranges.items()})


def _name(column: str, window: str) -> str:
    return f"{column}_{window}"


def _tiles(scopes: DataFrame, divisors: dict[str, int]) -> DataFrame:
    value = lambda c, window: f"CAST(coalesce({_name(c, window)}, 0) AS {SUMS[c]})"
    tiles = ", ".join(f"struct('{n}' AS window, {d} AS divisor, {value('revenue', n)} AS revenue,"
                      f" {value('transactions', n)} AS transactions)" for n, d in divisors.items())
    rows = scopes.selectExpr("scope", "form_id", *[f"{value(c, ALL_TIME)} AS total_{c}" for c in SUMS],
                             f"inline(array({tiles}))")
    return w.with_averages(rows).drop("divisor")
