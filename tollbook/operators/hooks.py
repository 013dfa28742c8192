"""Extension points: named functions that receive a value and return it changed.

A hook is a plain function on a DataFrame or a Column, so chained hooks are planned as one query.
They run in the order given, the general point before the specific one.

The plans in `tollbook.plans` call these points:

| points | receive and return |
| --- | --- |
| `gateway_feeds`, `feeds` | the feed table from which entries get their feed |
| `gateway_entry_feed`, `entry_feed` | the feed table in which a callback's entry finds its own |
| `gateway_order_total`, `order_total` | an entry's total, after the smallest charge |
| FORM_PRICE, CUSTOM_PRICE, each also for one form as `<point>_<form id>` | the amount of a request |
| `custom_description` | the description of a custom request |
| `free_transaction_id`, `transaction_id` | the id of a free payment, then of any |
| `send_notification` (notification id, status) | whether it is sent |
| `confirmation` (confirmation) | whether it may be shown |
| `save_feeds` | feeds to be written |
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, functions as F

T = TypeVar("T", DataFrame, Column)

# The points an amount passes, in order.
FORM_PRICE = ("form_gateway_price", "form_price", "gateway_price", "price")
CUSTOM_PRICE = ("custom_gateway_price", "custom_price", "gateway_price", "price")


def apply_hooks(value: T, hooks: Iterable[Callable[[T], T]]) -> T:
    """Pass a value through every hook, each one receiving what the one before returned."""
    return reduce(lambda v, hook: hook(v), hooks, value)


class Hooks:
    """Hooks by the name of their point."""

    def __init__(self) -> None:
        self._points: dict[str, list[Callable]] = defaultdict(list)

    def on(self, point: str, hook: Callable) -> Hooks:
        self._points[point].append(hook)
        return self

    def run(self, value: T, *points: str) -> T:
        """Run the hooks of several points, general points first."""
        return apply_hooks(value, [hook for point in points for hook in self._points.get(point, ())])

    def run_for_form(self, value: Column, form_id: Column, *points: str) -> Column:
        """For each point its general hooks, then those registered as `point_<form id>` on that form's rows."""
        for point in points:
            value = self.run(value, point)
            for name in sorted(self._points):
                suffix = name.removeprefix(point + "_")
                if suffix != name and suffix.isdigit():
                    value = F.when(form_id == int(suffix), self.run(value, name)).otherwise(value)
        return value

    def allows(self, point: str, *args) -> Column:
        """Whether every predicate hook of a point agrees."""
        return reduce(lambda a, hook: a & hook(*args), self._points.get(point, ()), F.lit(True))

    def has(self, point: str) -> bool:
        return bool(self._points.get(point))


#: For plans that are given none.
NO_HOOKS = Hooks()
