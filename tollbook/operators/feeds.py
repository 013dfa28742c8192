"""Feeds: the per-form payment settings, their rules, and which feed applies to an entry.

A feed is (id, form_id, is_active, meta) with `meta` as JSON text. Entries carry `answers`, a map of
what was submitted by `input_<field>`, and `hidden`, the field ids that were not shown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tollbook.functions import status as st
from tollbook.functions.text import answer
from tollbook.functions.values import is_empty_flag, is_empty_text, json_path
from tollbook.operators.joins import first_per_key, lookup_join

IDS = "array<string>"

# The settings a feed may hold.
META_SCHEMA = ", ".join([
    "type string", "addon string", "floor_policy string", "update_post_action1 string",
    "update_post_action2 string", "delay_notifications string", f"selected_notifications {IDS}",
    f"conf_1 {IDS}", f"conf_2 {IDS}", f"conf_3 {IDS}",
    f"notif_1 {IDS}", f"notif_2 {IDS}", f"notif_3 {IDS}", f"notif_4 {IDS}",
    "conditional_enabled string", "conditional_field_id string", "conditional_operator string",
    "conditional_value string", "desc_pm string", "customer_fields_desc string",
    "customer_fields_email string", "customer_fields_mobile string",
])

META_NAMES = tuple(part.split(" ")[0] for part in META_SCHEMA.split(", "))

# Field types a rule may test.
RULE_FIELD_TYPES = (
    "checkbox", "radio", "select", "text", "website", "textarea", "email", "hidden", "number", "phone",
    "multiselect", "post_title", "post_tags", "post_custom_field", "post_content", "post_excerpt",
)

# The add-on that goes by feed type instead of the add-on setting.
REGISTRATION_ADDON = "user_registration"


# Settings that a site may keep under a name of its gateway, and that name's pattern.
PREFIXED = {
    **{f"conf_{i}": "gf_{gateway}_conf_%d" % i for i in (1, 2, 3)},
    **{f"notif_{i}": "gf_{gateway}_notif_%d" % i for i in (1, 2, 3, 4)},
    **{f"conditional_{part}": "{gateway}_conditional_%s" % part for part in ("enabled", "field_id", "operator", "value")},
    "floor_policy": "{policy}",
}


def stored_names(gateway: str, policy: str = "floor_policy") -> dict[str, str]:
    """The names that a gateway's settings are stored under, for `decode_meta` and `encode_meta`."""
    return {name: pattern.format(gateway=gateway, policy=policy) for name, pattern in PREFIXED.items()}


def _parsed(text: Column, names: dict[str, str]) -> Column:
    """The settings of a text under the library's names; null fields for a text that cannot be read."""
    fields = [part.split(" ", 1) for part in META_SCHEMA.split(", ")]
    stored = F.from_json(text, ", ".join(f"`{names.get(n, n)}` {kind}" for n, kind in fields))
    if not names:
        return stored
    return F.when(stored.isNotNull(), F.struct(*[stored[names.get(n, n)].alias(n) for n, _ in fields]))


def _unnamed(text: Column, names: dict[str, str]) -> Column:
    known = [names.get(n, n) for n in META_NAMES]
    return F.map_filter(F.from_json(text, "map<string,variant>"), lambda k, _: ~k.isin(*known))


def decode_meta(feeds: DataFrame, column: str = "meta", names: dict[str, str] | None = None) -> DataFrame:
    """The settings text as a struct; settings that META_SCHEMA does not name are kept, with their types, in
    `<column>_other`, and the text itself, readable or not, in `<column>_text`.

    `names` says which settings are stored under other names (see `stored_names`).
    """
    text = F.col(column)
    return feeds.withColumns({
        column: _parsed(text, names or {}), f"{column}_other": _unnamed(text, names or {}), f"{column}_text": text})


def has_settings(text: Column) -> Column:
    """Whether a settings text can be read and holds anything."""
    return F.coalesce(~F.get_json_object(text, "$").isin("{}", "[]", "null", "", "0", "false"), F.lit(False))


def encode_meta(feeds: DataFrame, column: str = "meta", names: dict[str, str] | None = None) -> DataFrame:
    """The settings as text again, with those of `<column>_other` if it is there.

    Where the settings still are what `<column>_text` holds, or hold nothing and that text cannot be read, it
    is the text as it was, to the letter.
    """
    names, other, text = names or {}, f"{column}_other", f"{column}_text"
    stored = F.when(F.col(column).isNotNull(), F.struct(*[F.col(column)[n].alias(names.get(n, n)) for n in META_NAMES]))
    written = known = F.to_json(stored)
    if other in feeds.columns:
        more = F.to_json(other)
        written = (F.when(F.coalesce(F.size(other), F.lit(0)) <= 0, known).when(known == "{}", more)
                   .otherwise(F.concat(F.left(known, F.length(known) - 1), F.lit(","), F.right(more, F.length(more) - 1))))
    if text in feeds.columns:
        same = F.to_json(_parsed(F.col(text), names)).eqNullSafe(F.to_json(F.col(column)))
        if other in feeds.columns:
            same = same & F.to_json(_unnamed(F.col(text), names)).eqNullSafe(F.to_json(other))
        written = F.when(same, F.col(text)).otherwise(written)
    return feeds.withColumn(column, written).drop(other, text)


def feed_by_id(feeds: DataFrame, feed_id: int) -> DataFrame:
    return feeds.where(F.col("id") == feed_id)


def feeds_by_form(feeds: DataFrame, form_id: int | None = None, only_active: bool = False) -> DataFrame:
    if form_id is not None:
        feeds = feeds.where(F.col("form_id") == form_id)
    return feeds.where(F.col("is_active") == 1) if only_active else feeds


def feeds_with_form(feeds: DataFrame, forms: DataFrame) -> DataFrame:
    """Feeds with the title of their form; a feed of a missing form is left out."""
    titles = forms.select(F.col("id").alias("form_id"), F.col("title").alias("form_title"))
    return lookup_join(feeds, titles, "form_id", "inner")


def feed_list(feeds: DataFrame, forms: DataFrame) -> DataFrame:
    listed = feeds_with_form(feeds, forms)
    return listed.select("id", "is_active", "form_id", "form_title",
                         st.feed_type_label(json_path(F.col("meta"), "type")).alias("type_label"))


def first_feeds(feeds: DataFrame) -> DataFrame:
    """The first active feed of each form, by id."""
    return first_per_key(feeds_by_form(feeds, only_active=True), ["form_id"], ["id"])


def compare(value: Column, operator: Column, target: Column) -> Column:
    """One rule comparison, chosen row by row by its operator's name.

    Texts are compared trimmed and without case, sizes as numbers; what is no number never matches.
    """
    plain = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))

    def holds(pair: Column) -> Column:
        op, left, right = pair["op"], pair["left"], pair["right"]
        return (F.when(op == "is", left == right)
                .when(op == "isnot", left != right)
                .when(op == ">", left.try_cast("double") > right.try_cast("double"))
                .when(op == "<", left.try_cast("double") < right.try_cast("double"))
                .when(op == "contains", F.contains(left, right))
                .when(op == "starts_with", F.startswith(left, right))
                .when(op == "ends_with", F.endswith(left, right)))

    # As the one element of an array both sides are worked out once, whatever they are made from, and
    # not again in each branch.
    pair = F.struct(operator.alias("op"), plain(value).alias("left"), plain(target).alias("right"))
    return F.coalesce(F.exists(F.array(pair), holds), F.lit(False))


def rule_passes(enabled: Column, field_id: Column, operator: Column, target: Column,
                submitted: Column, hidden: Column, known: Column | None = None) -> Column:
    """A rule that is off, names no field, or names one that is not among the form's `known` ones passes;
    otherwise its field must be shown and match."""
    unused = is_empty_text(enabled) | is_empty_text(field_id)
    if known is not None:
        unused = unused | ~F.coalesce(F.array_contains(known, field_id), F.lit(True))
    shown = ~F.coalesce(F.array_contains(hidden, field_id), F.lit(False))
    return unused | (shown & compare(submitted, operator, target))


def _setting_struct(settings: Sequence[str], name: str) -> Column:
    fields = [F.col("meta")[s].alias(s) for s in settings]
    return F.struct(F.col("id").alias("id"), *fields).alias(name)


RULE_SETTINGS = ("conditional_enabled", "conditional_field_id", "conditional_operator", "conditional_value")


def with_rule_result(entries: DataFrame, name: str, rule: str = "_rule") -> DataFrame:
    """Whether a rule (a struct column, consumed) passes, from the entry's `answers` and `hidden` fields.

    A feed without readable settings never passes. With a column `form_field_ids`, rules on other fields do.
    """
    enabled, field_id, operator, target = (F.col(rule)[s] for s in RULE_SETTINGS)
    # The answer is a column of its own, so that it is looked up once and not per operator.
    looked_up = entries.withColumn("_submitted", answer(F.col("answers"), field_id))
    known = F.col("form_field_ids") if "form_field_ids" in entries.columns else None
    passes = rule_passes(enabled, field_id, operator, target, F.col("_submitted"), F.col("hidden"), known)
    return looked_up.withColumn(name, F.coalesce(F.col(rule)["has_settings"], F.lit(True)) & passes).drop("_submitted", rule)


def with_first_feed(entries: DataFrame, feeds: DataFrame, how: str = "left",
                    settings: Sequence[str] = ("type",)) -> DataFrame:
    """Entries with `feed`, the first active feed of their form, and its rule in `_rule`.

    Only the named settings are decoded and carried along.
    """
    first = decode_meta(first_feeds(feeds).withColumn("_has", has_settings(F.col("meta")))).select(
        "form_id", _setting_struct(settings, "feed"),
        _setting_struct(RULE_SETTINGS, "_rule").withField("has_settings", F.col("_has")).alias("_rule"))
    return lookup_join(entries, first, "form_id", how)


def with_active_feed(entries: DataFrame, feeds: DataFrame, settings: Sequence[str] = ("type",)) -> DataFrame:
    """Entries with `feed`, the first active feed of their form if its rule passes, else null.

    When the first feed's rule fails no later feed is tried.
    """
    tested = with_rule_result(with_first_feed(entries, feeds, settings=settings), "_passes")
    return tested.withColumn("feed", F.when(F.col("feed").isNotNull() & F.col("_passes"), F.col("feed"))).drop("_passes")


def with_passing_feed(entries: DataFrame, feeds: DataFrame, settings: Sequence[str] = ("type",)) -> DataFrame:
    """Only the entries whose form has an active feed with a passing rule, with that `feed`."""
    return with_rule_result(with_first_feed(entries, feeds, "inner", settings), "_passes").where("_passes").drop("_passes")


def with_own_feed(entries: DataFrame, feeds: DataFrame, feed_id: str = "feed_id",
                  settings: Sequence[str] = ("type",)) -> DataFrame:
    """Entries with `feed`, the one recorded for them as an attribute, else null."""
    table = decode_meta(feeds).select(F.col("id").alias(feed_id), _setting_struct(settings, "feed"))
    return lookup_join(entries, table, feed_id)


def is_rule_field(field_type: Column, input_type: Column) -> Column:
    """Whether a rule may test a field, by its input type or else its type."""
    return F.coalesce(F.nullif(input_type, F.lit("")), field_type).isin(*RULE_FIELD_TYPES)


def with_defer_flags(entries: DataFrame, feeds: DataFrame, slugs: tuple[str, ...] = ()) -> DataFrame:
    """Whether an entry's follow-ups wait for the payment.

    An entry whose `is_delayed` is already set keeps waiting.

    Posts and notifications wait for any active feed, registration only for a subscription. An
    add-on waits as long as it is neither fulfilled nor processed, if the feed covers add-ons; one
    that the feed does not cover keeps the flag in `is_delayed`. The add-on state is read from the
    columns `<slug>_is_fulfilled` and `processed_feeds` (JSON).
    """
    matched = with_active_feed(entries, feeds, ("type", "addon"))
    meta = F.col("feed")
    found = F.col("feed").isNotNull()
    subscription = found & F.coalesce(meta["type"] == "subscription", F.lit(False))
    covers_addons = found & F.coalesce(meta["addon"] == "true", F.lit(False))
    before = ~is_empty_flag(F.col("is_delayed")) if "is_delayed" in entries.columns else F.lit(False)
    flags = {"defer_post": found | before, "defer_notification": found | before,
             "defer_registration": subscription | before}
    for slug in slugs:
        waiting = (is_empty_text(F.col(f"{slug}_is_fulfilled"))
                   & is_empty_text(json_path(F.col("processed_feeds"), slug)))
        covered = subscription if slug == REGISTRATION_ADDON else covers_addons
        flags[f"defer_{slug}"] = F.when(covered, waiting).otherwise(~is_empty_flag(F.col("is_delayed")))
    return matched.withColumns(flags)
