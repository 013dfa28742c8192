"""Amount columns: currency base unit, minimum charge, money and average texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Amounts are kept with two decimals.
MONEY = "decimal(19,2)"

# The smallest chargeable amount by currency, and the policy that lifts to it.
MINIMUM = {"IRR": 1000, "IRT": 100}
LIFT_POLICY = "sadt"

# The currency the gateway counts in, and how many units of others make one of it.
BASE_CURRENCY = "IRT"
UNITS_PER_BASE = 10


def minimum_charge(total: Column, currency: Column, policy: Column) -> Column:
    """A positive amount under the minimum is lifted to it or waived, as the policy says.

    No policy (null) or another currency leaves the amount as it is.
    """
    floor = F.lit(None).cast("int")
    for code, least in MINIMUM.items():
        floor = F.when(currency == code, F.lit(least)).otherwise(floor)
    enough = policy.isNull() | floor.isNull() | (total >= floor)
    charged = (F.when(F.coalesce(total, F.lit(0)) <= 0, F.lit(0)).when(enough, total)
               .when(policy == LIFT_POLICY, floor).otherwise(F.lit(0)))
    return charged.cast(MONEY)


def base_units(amount: Column, currency: Column, custom: Column) -> Column:
    """The amount in the gateway's unit; custom payments are already in it."""
    as_is = (currency == BASE_CURRENCY) | custom
    return F.when(as_is, amount.cast("decimal(20,3)")).otherwise((amount / UNITS_PER_BASE).cast("decimal(20,3)"))


def money_text(amount: Column, currency: Column | None = None) -> Column:
    """`1,234.50 IRR`"""
    number = F.format_number(amount, 2)
    return number if currency is None else F.concat_ws(" ", number, currency)


def average_text(value: Column) -> Column:
    """Three decimals, halves away from zero, no thousands separator."""
    return F.round(value, 3).cast("decimal(38,3)").cast("string")
