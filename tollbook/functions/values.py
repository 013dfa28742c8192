"""Emptiness and null-safe access, with the loose rules the payment records were written under."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_empty_text(col: Column) -> Column:
    """Null, no text, or the text `0`."""
    return col.isNull() | col.isin("", "0")


def is_empty_number(col: Column) -> Column:
    return col.isNull() | (col == 0)


def is_empty_flag(col: Column) -> Column:
    return ~F.coalesce(col, F.lit(False))


def is_empty_list(col: Column) -> Column:
    return F.coalesce(F.size(col), F.lit(0)) <= 0


def is_blank_text(col: Column) -> Column:
    """Empty, but the text `0` counts as a value."""
    return col.isNull() | (col == "")


def text_or_none(col: Column) -> Column:
    return F.when(~col.isin("", "0"), col)


def map_path(col: Column, path: str) -> Column:
    """Follow `a/b/c` through nested maps; a missing step reads as no text."""
    for step in path.split("/"):
        col = F.try_element_at(col, F.lit(step))
    return F.coalesce(col, F.lit(""))


def json_path(col: Column, path: str) -> Column:
    """Follow `a/b/c` through JSON text; a missing step reads as no text."""
    return F.coalesce(F.get_json_object(col, "$." + path.replace("/", ".")), F.lit(""))
