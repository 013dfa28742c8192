"""Text columns: phones, digits, templates, labels and lookups in submitted answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tollbook.functions.values import is_empty_text, text_or_none

# Latin and Persian digits.
LATIN_DIGITS = "0123456789"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"

# Marks of an international number in raw text.
INTERNATIONAL_MARKS = ("+", "%2B")


def digits_fa(col: Column) -> Column:
    return F.translate(col, LATIN_DIGITS, PERSIAN_DIGITS)


def phone(raw: Column) -> Column:
    """One spelling per phone number.

    Digits are collected first, so the 2 of an encoded plus sign stays in the number.
    """
    digits = F.regexp_replace(raw, "[^0-9]", "")
    marked = F.lit(False)
    for mark in INTERNATIONAL_MARKS:
        marked = marked | F.contains(F.upper(raw), F.lit(mark))
    national = F.concat(F.lit("0"), F.regexp_replace(digits, "^0", ""))
    return (F.when(is_empty_text(raw), F.lit(""))
            .when(marked, F.concat(F.lit("+"), digits))
            .when(digits.startswith("00"), F.concat(F.lit("+"), F.substr(digits, F.lit(3))))
            .otherwise(national))


def fill_template(template: Column, **values: Column) -> Column:
    """Replace every `{name}` by its value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def join_description(first: Column, second: Column) -> Column:
    """`first - second`, either one alone, or a single space."""
    joined = F.concat_ws(" - ", text_or_none(first), text_or_none(second))
    return F.when(joined == "", F.lit(" ")).otherwise(joined)


def answer(answers: Column, field_id: Column) -> Column:
    """What was submitted for a field; no text when the field is not mapped or was left out."""
    key = F.concat(F.lit("input_"), F.replace(field_id, F.lit("."), F.lit("_")))
    # A lone zero counts as nothing said.
    return F.regexp_replace(F.coalesce(F.try_element_at(answers, key), F.lit("")), r"\A0\z", "")


def shorten_middle(col: Column, limit: int) -> Column:
    """Keep the two ends of a text longer than `limit` characters."""
    half = limit // 2
    return (F.when(F.coalesce(col, F.lit("")) == "", F.lit(""))
            .when(F.length(col) <= limit, col)
            .otherwise(F.concat(F.left(col, F.lit(half)), F.lit("..."), F.right(col, F.lit(half)))))
