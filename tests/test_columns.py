from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollbook.functions import money, status as st, text as tx, values as v
from tollbook.operators import feeds as fd, forms as fm, hooks

# id, currency, policy, custom, total, after the rule, in base units
AMOUNTS = [
    (1, "IRR", "sadt", False, "999.00", 1000, 100), (2, "IRR", "raygan", False, "999.00", 0, 0),
    (3, "IRR", "sadt", False, "1000.00", 1000, 100), (4, "IRT", "sadt", False, "99.99", 100, 100),
    (5, "IRT", "raygan", False, "99.99", 0, 0), (6, "IRT", "sadt", False, "100.00", 100, 100),
    (7, "IRR", "sadt", False, "0.00", 0, 0), (8, "IRR", "sadt", False, "-5.00", 0, 0),
    (9, "USD", "sadt", False, "5.00", 5, 0.5), (10, "IRR", None, False, "5.00", 5, 0.5),
    (11, "IRR", "sadt", True, "5000.00", 5000, 5000), (12, "IRT", "sadt", True, "5000.00", 5000, 5000),
]


def test_amounts(spark):
    data = [(i, c, p, k, Decimal(t)) for i, c, p, k, t, _, _ in AMOUNTS]
    df = spark.createDataFrame(data, "id int, currency string, policy string, custom boolean, total decimal(19,2)")
    due = money.minimum_charge(F.col("total"), F.col("currency"), F.col("policy"))
    rows = df.withColumn("due", due).select(
        "id", "due", money.base_units(F.col("due"), F.col("currency"), F.col("custom")).alias("base")).collect()
    assert [(r.id, float(r.due), float(r.base)) for r in rows] == [(a[0], a[5], a[6]) for a in AMOUNTS]


PHONES = {
    "+98 9990000012": "+989990000012", "0098-9123": "+989123", "09123": "09123", "9123": "09123",
    "%2B989123": "+2989123", "%2b12": "+212", "tel: 9123": "09123", "": "", "0": "", "none": "0", "00": "+",
    "tel: 0": "0",
}


def _apply(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_phones(spark):
    assert _apply(spark, PHONES, tx.phone) == list(PHONES.values())
    assert _apply(spark, [None], tx.phone) == [""]


def test_emptiness(spark):
    values = [None, "", "0", "0.0", " ", "a"]
    assert _apply(spark, values, v.is_empty_text) == [True, True, True, False, False, False]
    assert _apply(spark, values, v.is_blank_text) == [True, True, False, False, False, False]
    assert _apply(spark, [None, 0, 3], v.is_empty_number, "int") == [True, True, False]
    assert _apply(spark, [None, False, True], v.is_empty_flag, "boolean") == [True, True, False]
    assert _apply(spark, [None, [], [1]], v.is_empty_list, "array<int>") == [True, True, False]


def test_shorten_middle(spark):
    values = [None, "", "abcd", "abcde", "abcdefghij"]
    assert _apply(spark, values, lambda c: tx.shorten_middle(c, 5)) == ["", "", "abcd", "abcde", "ab...ij"]


def test_average_text(spark):
    values = [Decimal("0.3125"), Decimal("2"), Decimal("1234.56789"), Decimal("0.0004")]
    assert _apply(spark, values, money.average_text, "decimal(20,6)") == ["0.313", "2.000", "1234.568", "0.000"]


def test_messages(spark):
    rows = _apply(spark, [-22, 100, 12345, None], lambda c: st.code_message(c, "Shop"), "int")
    assert rows == ["تراکنش نا موفق میباشد .", "اتصال با Shop به خوبی برقرار شد و همه چیز صحیح است .", " ", " "]


RULES = [
    ("is", "Building ", "building", True), ("is", "a", "b", False), ("isnot", "a", "A", False), ("isnot", "a", "b", True),
    (">", "10", "9", True), (">", "9", "10", False), (">", "abc", "1", False), ("<", "9.5", "10", True),
    ("<", None, "10", False), ("contains", "Customer", "tom", True), ("contains", "Customer", "x", False),
    ("starts_with", "Machinery", "MA", True), ("ends_with", "name7", "7", True), ("ends_with", "name7", "8", False),
    ("unheard_of", "a", "a", False), ("is", None, "", True),
]


@pytest.mark.parametrize("operator,value,target,result", RULES)
def test_rule_operators(spark, operator, value, target, result):
    row = spark.range(1).select(fd.compare(F.lit(value).cast("string"), F.lit(operator), F.lit(target)).alias("r"))
    assert row.first().r is result


def test_rules_that_always_pass_and_hidden_fields(spark):
    df = spark.createDataFrame(
        [("", "1", []), ("0", "1", []), ("1", "", []), ("1", None, []), ("1", "1", []), ("1", "1", ["1"])],
        "enabled string, field string, hidden array<string>")
    passes = fd.rule_passes(F.col("enabled"), F.col("field"), F.lit("is"), F.lit("x"), F.lit("y"), F.col("hidden"))
    assert [r[0] for r in df.select(passes).collect()] == [True, True, True, True, False, False]
    match = fd.rule_passes(F.col("enabled"), F.col("field"), F.lit("is"), F.lit("x"), F.lit("x"), F.col("hidden"))
    assert [r[0] for r in df.select(match).collect()] == [True, True, True, True, True, False]


CONFIRMATION = ("array<struct<id:string,event:string,is_default:boolean,is_active:boolean,"
                "logic:struct<field_id:string,operator:string,value:string>>>")


def _pick(spark, confirmations, selected, event=""):
    df = spark.createDataFrame([(confirmations, selected, {"input_1": "red"})],
                               f"c {CONFIRMATION}, s array<string>, a map<string,string>")
    picked = fm.pick_confirmation(F.col("c"), F.col("s"), F.col("a"), event)
    return df.select(picked["id"].alias("id")).first().id


def test_confirmations(spark):
    default = ("d", "", True, None, None)
    red, blue = ("r", "", False, None, ("1", "is", "red")), ("b", "", False, None, ("1", "is", "blue"))
    off, other = ("o", "", False, False, None), ("e", "saved", False, None, None)
    assert _pick(spark, [default, blue, off, red], ["b", "o", "r"]) == "r"
    assert _pick(spark, [default, red], []) == "d"
    assert _pick(spark, [default, red], None) == "d"
    assert _pick(spark, [red], []) == "r"
    assert _pick(spark, [default, other], ["e"], "saved") == "e"
    assert _pick(spark, [default, other], ["e"]) == "d"


def test_hook_order(spark):
    first = lambda c: c + 1
    second = lambda c: c * 10
    points = hooks.Hooks().on("amount", first).on("amount", second).on("gateway", first)
    row = spark.range(1).select(points.run(F.lit(1), "amount", "gateway").alias("a"),
                                hooks.apply_hooks(F.lit(1), [second, first]).alias("b"),
                                points.allows("nobody").alias("c")).first()
    assert tuple(row) == (21, 11, True)


def test_free_ids_have_ten_digits(spark):
    ids = spark.range(2000).select(st.free_transaction_id(F.col("id")).alias("t")).collect()
    assert all(len(r.t) == 10 and r.t[0] != "0" for r in ids) and len({r.t for r in ids}) == 2000
