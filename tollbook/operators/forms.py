"""Form definitions: nested fields, inputs, choices, confirmations and notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.functions.text import answer
from tollbook.operators.feeds import compare
from tollbook.operators.hooks import NO_HOOKS, Hooks

# The field types that make a form chargeable.
CHARGEABLE_TYPES = ("product", "shipping")


def form_fields(forms: DataFrame) -> DataFrame:
    """One row per mappable field: each input of a field that has inputs, else the field itself.

    A field without inputs that is for display only is left out, and so is one whose list of inputs is empty.
    """
    field = F.explode("fields").alias("f")
    own = F.array(F.struct(F.col("f.id").alias("id"), F.col("f.label").alias("label")))
    targets = (F.when(F.col("f.inputs").isNotNull(), F.col("f.inputs"))
               .when(~F.coalesce(F.col("f.display_only"), F.lit(False)), own))
    exploded = forms.select(F.col("id").alias("form_id"), field).select("form_id", F.explode(targets).alias("t"))
    return exploded.select("form_id", F.col("t.id").alias("field_id"), F.col("t.label").alias("label"))


def choice_values(forms: DataFrame) -> DataFrame:
    """One row per choice, its value falling back to its text."""
    choices = (forms.select(F.col("id").alias("form_id"), F.explode("fields").alias("f"))
               .select("form_id", F.col("f.id").alias("field_id"), F.posexplode("f.choices").alias("position", "c")))
    value = F.coalesce(F.nullif(F.col("c.value"), F.lit("")), F.col("c.text"))
    return choices.select("form_id", "field_id", "position", value.alias("value"))


def has_product() -> Column:
    return F.coalesce(F.exists("fields", lambda f: f["type"].isin(*CHARGEABLE_TYPES)), F.lit(False))


def pick_confirmation(confirmations: Column, selected: Column, answers: Column, event: str = "",
                      hooks: Hooks = NO_HOOKS) -> Column:
    """The confirmation an entry is shown, from its form's list in order.

    An event first narrows the list; a list of one wins outright. Otherwise it is the first that is
    for the event, not the default, not switched off, whose condition holds and which the feed has
    selected; failing that the default. The list lives in one row, so nothing is shuffled or sorted.
    """
    wanted = F.filter(confirmations, lambda c: c["event"] == event) if event else confirmations
    selected = F.coalesce(selected, F.array().cast("array<string>"))

    def fits(c: Column) -> Column:
        logic = c["logic"]
        holds = logic.isNull() | compare(answer(answers, logic["field_id"]), logic["operator"], logic["value"])
        return ((F.coalesce(c["event"], F.lit("")) == event) & ~F.coalesce(c["is_default"], F.lit(False))
                & F.coalesce(c["is_active"], F.lit(True)) & holds & F.array_contains(selected, c["id"])
                & hooks.allows("confirmation", c))

    default = F.get(F.filter(confirmations, lambda c: F.coalesce(c["is_default"], F.lit(False))), F.lit(0))
    first = F.get(F.filter(wanted, fits), F.lit(0))
    return F.when(F.size(wanted) <= 1, F.get(wanted, F.lit(0))).otherwise(F.coalesce(first, default))


def selected_only(triggered: DataFrame, selected: DataFrame) -> DataFrame:
    """The triggered ids that the feed has selected."""
    return triggered.join(selected.distinct(), selected.columns, "left_semi")
