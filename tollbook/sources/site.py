"""The given star schema read as a payment site.

Each function is a narrow projection of one given table, so the site grows with the data: orders are
leads, customers are forms and hold their feeds, lines are the callbacks and the order lines of a
lead. Flags and texts follow from the columns so that every rule of the library is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tollbook.sources.tables import scan

MONEY = "decimal(19,2)"
LEAD_META_KEYS = ("payment_gateway", "feed_id", "payment_type", "part_price", "crm_is_fulfilled",
                  "user_registration_is_fulfilled", "processed_feeds")


def _case(column: str, values: dict) -> Column:
    """A value by the value of a column, null for any other."""
    if any(isinstance(v, Column) for v in values.values()):
        result = F.lit(None)
        for key, value in values.items():
            result = F.when(F.col(column) == key, value).otherwise(result)
        return result
    literal = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN '{k}' THEN {literal(v)}" for k, v in values.items())
    return F.expr(f"CASE {column} {whens} END")


def _by_priority(urgent, high, medium, unspecified, low) -> Column:
    return _case("o_orderpriority", {"1-URGENT": urgent, "2-HIGH": high, "3-MEDIUM": medium,
                                     "4-NOT SPECIFIED": unspecified, "5-LOW": low})


def _by_segment(automobile, building, furniture, household, machinery) -> Column:
    return _case("c_mktsegment", {"AUTOMOBILE": automobile, "BUILDING": building, "FURNITURE": furniture,
                                  "HOUSEHOLD": household, "MACHINERY": machinery})


def _lead_columns() -> dict[str, Column]:
    amount = F.col("o_totalprice").cast(MONEY)
    subscription = F.col("o_custkey") % 2 == 0
    return {
        "id": F.col("o_orderkey"),
        "form_id": F.col("o_custkey"),
        "status": F.when(F.col("o_orderkey") % 20 == 0, "spam").otherwise("active"),
        "is_fulfilled": (F.col("o_orderstatus") == "F").cast("int"),
        "payment_method": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "gateway").otherwise("other"),
        "payment_status": F.expr("""CASE o_orderstatus
            WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN 'Active' ELSE 'Paid' END WHEN 'O' THEN 'Processing'
            WHEN 'P' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'Cancelled' ELSE 'Failed' END END"""),
        "transaction_type": F.when(subscription, 2).otherwise(1),
        "transaction_id": F.concat(F.lit("T"), F.col("o_orderkey").cast("string")),
        "currency": F.when(F.col("o_orderkey") % 3 == 0, "IRT").otherwise("IRR"),
        "payment_amount": amount,
        "payment_date": F.col("o_orderdate"),
    }


def leads(spark: SparkSession, folder: str) -> DataFrame:
    """Leads of daily grain over several years."""
    return scan(spark, folder, "orders").select(*[c.alias(n) for n, c in _lead_columns().items()])


def event_leads(events: DataFrame) -> DataFrame:
    """Leads of microsecond grain over one month, from the event table or stream."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("form_id"), F.lit("active").alias("status"),
        kind.isin("purchase", "signup").cast("int").alias("is_fulfilled"),
        F.when(F.col("event_id") % 3 == 0, "other").otherwise("gateway").alias("payment_method"),
        F.col("value").cast(MONEY).alias("payment_amount"), F.col("ts").alias("payment_date"))


def hourly_leads(spark: SparkSession, folder: str) -> DataFrame:
    return event_leads(scan(spark, folder, "events"))


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """Leads with what was submitted; a lead still being processed has no payment date yet."""
    columns = _lead_columns()
    open_ = F.col("o_orderstatus") == "O"
    columns["payment_date"] = F.when(~open_, F.col("o_orderdate"))
    columns["transaction_id"] = F.when(~open_, columns["transaction_id"])
    columns["date_created"] = F.col("o_orderdate")
    key = F.col("o_custkey").cast("string")
    columns["answers"] = F.create_map(
        F.lit("input_1"), F.col("o_orderpriority"),
        F.lit("input_2"), F.col("o_totalprice").cast(MONEY).cast("string"),
        F.lit("input_3"), F.col("o_orderstatus"),
        F.lit("input_5_3"), F.when(open_, F.concat(F.lit("user"), key, F.lit("@example.com"))).otherwise(""),
        F.lit("input_6"), F.concat(_by_priority("+98 ", "0098-", "0", "%2B98", ""), F.lpad(key, 10, "9")),
        F.lit("input_7"), _by_priority("gift", "", "0", "repeat order", "late"))
    columns["hidden"] = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("3"))).otherwise(
        F.array().cast("array<string>"))
    columns["is_delayed"] = F.col("o_orderpriority") == "3-MEDIUM"
    columns["post_id"] = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    return scan(spark, folder, "orders").select(*[c.alias(n) for n, c in columns.items()])


def lead_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Key/value attributes; every lead lacks some."""
    status = F.col("o_orderstatus")
    values = {
        "payment_gateway": F.lit("Gateway"),
        "feed_id": F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_custkey") * 2 + 1).cast("string")),
        "payment_type": _by_priority("custom", "form", "form", None, "form"),
        "part_price": F.when(F.col("o_orderpriority") == "1-URGENT",
                             F.col("o_totalprice").cast(MONEY).cast("string")),
        "crm_is_fulfilled": F.when(status == "F", "1").when(status == "O", "0"),
        "user_registration_is_fulfilled": F.when(status == "P", "1"),
        "processed_feeds": F.when(F.col("o_orderpriority") == "2-HIGH", '{"crm":"1","mail":"1"}'),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("meta_key"), v.cast("string").alias("meta_value"))
                      for k, v in values.items()])
    listed = scan(spark, folder, "orders").select(F.col("o_orderkey").alias("lead_id"), F.inline(pairs))
    return listed.where(F.col("meta_value").isNotNull())


def custom_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of custom payments, named after a form: urgent orders have them for their own form, with and without a
    description, and they and the next ones a price for another."""
    own, key = F.col("o_custkey"), F.col("o_custkey").cast("string")
    named = lambda name, form: F.concat(F.lit(name + "_"), form.cast("string"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    values = [
        (named("part_price", own), F.when(urgent, F.col("o_totalprice").cast(MONEY).cast("string"))),
        (named("part_desc", own), F.when(urgent & (F.col("o_orderstatus") == "O"), F.concat(F.lit("Custom "), F.col("o_orderkey").cast("string")))),
        (named("part_name", own), F.when(urgent, F.concat(F.lit("payer "), key))),
        (named("part_email", own), F.when(urgent & (F.col("o_orderstatus") == "F"), F.concat(F.lit("payer"), key, F.lit("@example.com")))),
        (named("part_mobile", own), F.when(urgent, F.concat(F.lit("0098 "), F.lpad(key, 10, "9")))),
        (named("part_price", own + 1), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "1.00"))]
    pairs = F.array(*[F.struct(k.alias("meta_key"), v.alias("meta_value")) for k, v in values])
    present = F.filter(pairs, lambda p: p["meta_value"].isNotNull())
    return scan(spark, folder, "orders").select(F.col("o_orderkey").alias("lead_id"), F.inline(present))


def feeds(spark: SparkSession, folder: str) -> DataFrame:
    """One or two feeds per form, some inactive; forms of the last nation have none."""
    # Rule operator, field and value go by nation; nation 23 names no field, 24 would compare no number.
    rules = [("is", "1", " 1-urgent "), ("isnot", "1", "5-LOW"), (">", "2", "250000"), ("<", "2", "100000.5"),
             ("contains", "1", "MED"), ("starts_with", "1", "4-"), ("ends_with", "3", "f")]
    nation = F.col("c_nationkey")
    listed = ", ".join(f"struct('{o}' AS operator, '{f}' AS field, '{v}' AS value)" for o, f, v in rules)
    rule = F.expr(f"element_at(array({listed}), c_nationkey % 7 + 1)")
    key = F.col("c_custkey")
    text_list = lambda *ids: F.split(F.lit(",".join(ids)), ",") if ids else F.array().cast("array<string>")
    first = F.to_json(F.struct(
        _by_segment("subscription", "subscription", "product", "product", "product").alias("type"),
        _by_segment("true", "", "true", "", "").alias("addon"),
        F.when(F.col("c_mktsegment") != "MACHINERY",
               F.when(F.col("c_acctbal") > 5000, "sadt").otherwise("raygan")).alias("floor_policy"),
        _by_segment("publish", "draft", "private", "", "other").alias("update_post_action1"),
        _by_segment("dont", "publish", "other", "", "draft").alias("update_post_action2"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", "1").otherwise("").alias("conditional_enabled"),
        F.when(nation == 23, "").otherwise(rule["field"]).alias("conditional_field_id"),
        rule["operator"].alias("conditional_operator"), rule["value"].alias("conditional_value"),
        F.when(F.col("c_mktsegment") != "FURNITURE", "Entry {entry_id} of {form_title} ({form_id})").otherwise("")
        .alias("desc_pm"),
        F.lit("7").alias("customer_fields_desc"), F.lit("5.3").alias("customer_fields_email"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise("6").alias("customer_fields_mobile"),
        text_list("c2", "c3").alias("conf_1"), text_list("c3").alias("conf_2"), text_list().alias("conf_3"),
        text_list("n1").alias("notif_1"), text_list("n1", "n3").alias("notif_2"),
        _by_segment(text_list("n2"), text_list("n2"), text_list(), text_list("n2", "n9"), text_list("n1"))
        .alias("notif_3"), text_list("n3").alias("notif_4")))
    second = F.to_json(F.struct(F.lit("product").alias("type"), F.lit("").alias("addon"),
                                F.lit("sadt").alias("floor_policy"), text_list("c2").alias("conf_1")))
    make = lambda id_, active, meta: F.struct(
        id_.alias("id"), key.alias("form_id"), active.cast("int").alias("is_active"), meta.alias("meta"))
    own = F.array(
        F.when(nation != 24, make(key * 2 + 1, F.col("c_mktsegment") != "HOUSEHOLD", first)),
        F.when((nation != 24) & (F.col("c_acctbal") < 3000), make(key * 2 + 2, F.lit(True), second)))
    return scan(spark, folder, "customer").select(F.inline(F.filter(own, lambda f: f.isNotNull())))


FIELD = ("struct<id:string,type:string,input_type:string,label:string,display_only:boolean,"
         "inputs:array<struct<id:string,label:string>>,choices:array<struct<value:string,text:string>>>")
CONFIRMATION = ("struct<id:string,event:string,is_default:boolean,is_active:boolean,"
                "logic:struct<field_id:string,operator:string,value:string>>")


def forms(spark: SparkSession, folder: str) -> DataFrame:
    """Forms with their nested definition."""
    nation = F.col("c_nationkey").cast("string")

    def field(id_, type_, label, input_type=None, display_only=False, inputs=None, choices=None) -> Column:
        as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(*[as_col(v) for v in (id_, type_, input_type, label, display_only, inputs, choices)]).cast(FIELD)

    pair = lambda a, b: F.struct(*[v if isinstance(v, Column) else F.lit(v) for v in (a, b)])
    fields = F.array(
        field("1", _by_segment("product", "shipping", "text", "section", "radio"), F.concat(F.lit("Main "), nation)),
        field("2", "name", "Name", inputs=F.array(pair("2.3", "First"), pair("2.6", "Last"))),
        field("3", "email", "Email"),
        field("4", "section", "Note", display_only=True),
        field("5", "option", "Size", input_type=F.when(F.col("c_acctbal") > 5000, "select").otherwise(""),
              choices=F.array(pair("", F.concat(F.lit("Size "), nation)), pair(F.concat(F.lit("v"), nation), "Large"))))

    def confirmation(id_, event, default, active, logic=None) -> Column:
        rule = F.lit(None) if logic is None else F.struct(*[F.lit(v) for v in logic])
        as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(F.lit(id_), F.lit(event), F.lit(default), as_col(active), rule).cast(CONFIRMATION)

    confirmations = F.array(
        confirmation("c1", "", True, None),
        confirmation("c2", "", False, F.col("c_mktsegment") != "BUILDING", ("2", ">", "200000")),
        confirmation("c3", "", False, None, ("1", "contains", "h")),
        confirmation("c4", "form_saved", False, None))
    alone = F.array(confirmation("c1", "", True, None))
    return scan(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"),
        _by_segment("draft", "publish", "pending", "private", "draft").alias("post_status"),
        fields.alias("fields"),
        F.when(F.col("c_acctbal") < 1000, alone).otherwise(confirmations).alias("confirmations"),
        F.array(F.lit("n1"), F.lit("n2"), F.lit("n3")).alias("notifications"))


def callbacks(spark: SparkSession, folder: str) -> DataFrame:
    """Gateway callbacks, several per lead; only the first of a lead may count."""
    return line_callbacks(scan(spark, folder, "lineitem"))


def line_callbacks(lines: DataFrame) -> DataFrame:
    """Callbacks from the line table or a stream of it."""
    flag = F.col("l_returnflag")
    failed = F.expr("element_at(array(-1, -2, -11, -22, -33, 7, 101), l_linenumber)")
    rejected = (flag == "A") & (F.col("l_linestatus") == "F")
    return lines.select(
        (F.col("l_partkey") * 8 + F.col("l_linenumber")).alias("event_id"), F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("lead_id"),
        F.when(flag == "R", "OK").when(rejected, "ok").otherwise("NOK").alias("status_arg"),
        F.when((flag == "N") & (F.col("l_linestatus") == "O"), "true").otherwise("").alias("no_arg"),
        F.when(flag == "R", 100).when(rejected, failed).alias("result_code"),
        F.when(flag == "R", F.concat(F.lit("R"), F.col("l_partkey").cast("string"))).alias("ref_id"))


def event_callbacks(events: DataFrame) -> DataFrame:
    """Callbacks from the event table or stream; the users are the leads, each with very many."""
    kind = F.col("event_type")
    by_event = F.element_at(F.array(*[F.lit(c) for c in (-1, -22, -33, 7)]), (F.col("event_id") % 4 + 1).cast("int"))
    return events.select(
        "event_id", "ts", F.col("user_id").alias("lead_id"),
        F.when(kind == "purchase", "OK").when(kind == "error", "ok").otherwise("NOK").alias("status_arg"),
        F.when(kind == "signup", "true").otherwise("").alias("no_arg"),
        F.when(kind == "purchase", 100).when(kind == "error", by_event).alias("result_code"),
        F.when(kind == "purchase", F.concat(F.lit("R"), F.col("event_id").cast("string"))).alias("ref_id"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("lead_id"), F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"))


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        _by_priority("pending", "publish", "draft", "private", "publish").alias("post_status"))


def request_replies(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), _by_priority(100, -22, 100, -2, 55).alias("code"))


def signups(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events").where(F.col("event_type") == "signup")
    return events.select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_login"),
                         F.col("event_id").alias("activation_key"), F.col("ts").alias("registered"))


def phones(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("+98 ", "0098-", "0", "%2B98", "tel: ", "")]),
                          (key % 6 + 1).cast("int"))
    number = F.when(key % 50 == 5, "").otherwise(F.lpad(key.cast("string"), 10, "9"))
    return scan(spark, folder, "customer").select(key.alias("id"), F.concat(prefix, number).alias("raw"))


def amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals around the minimum charge, with every policy and currency."""
    kind, value = F.col("event_type"), F.col("value").cast(MONEY)
    return scan(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.element_at(F.array(F.lit("IRR"), F.lit("IRT"), F.lit("USD")), (F.col("user_id") % 3 + 1).cast("int"))
        .alias("currency"),
        _case("event_type", {"purchase": "sadt", "signup": "raygan", "view": "sadt", "click": "raygan"}).alias("policy"),
        (kind == "error").alias("custom"),
        F.when(kind == "view", -value).when(kind == "purchase", value * 4).otherwise(value).cast(MONEY).alias("total"))


def date_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Dates as typed: Gregorian, Jalali, and some that are neither."""
    key = F.col("o_orderkey")
    gregorian = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    jalali = F.concat_ws("-", 1370 + key % 40, 1 + key % 12, 1 + key % 29)
    return scan(spark, folder, "orders").select(
        key.alias("id"), _case("o_orderstatus", {"F": gregorian, "O": jalali, "P": F.lit("n/a")}).alias("txt"))


def corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Manual corrections of leads, some without status or date."""
    nation = F.col("c_nationkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    typed = F.concat(F.lit("1380-"), two(1 + nation % 12), F.lit("-"), two(1 + nation), F.lit(" "),
                     two(nation % 24), F.lit(":15:30"))
    return scan(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), _by_segment("Paid", "Cancelled", "", "Active", "Failed").alias("status"),
        F.col("c_acctbal").cast(MONEY).alias("amount"),
        F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("transaction_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "").otherwise(typed).alias("date_text"))
