"""Rows that the given tables do not hold: unreadable settings, unknown rule fields, flags set before, doubled replies."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tollbook.operators import feeds as fd, forms as fm, settle as s

ENTRY = "id int, form_id int, answers map<string,string>, hidden array<string>, form_field_ids array<string>, is_delayed boolean"
FEED = "id int, form_id int, is_active int, meta string"


def _entries(spark):
    return spark.createDataFrame([(k, k, {"input_1": "a"}, [], ["1"], k == 9) for k in range(1, 10)], ENTRY)


def test_feeds_without_settings_and_rules_on_unknown_fields(spark):
    rule = '{{"type":"product","conditional_enabled":"1","conditional_field_id":"{}","conditional_operator":"is","conditional_value":"{}"}}'
    feeds = spark.createDataFrame([
        (1, 1, 1, None), (2, 2, 1, ""), (3, 3, 1, "{}"), (4, 4, 1, "no json"), (5, 5, 1, '{"type":"product"}'),
        (6, 6, 1, rule.format("7", "x")), (7, 7, 1, rule.format("1", "a")), (8, 8, 1, rule.format("1", "b"))], FEED)
    found = fd.with_active_feed(_entries(spark), feeds)
    assert {r.id for r in found.where("feed is not null").collect()} == {5, 6, 7}
    passing = fd.with_passing_feed(_entries(spark), feeds)
    assert {r.id for r in passing.collect()} == {5, 6, 7}
    flags = {r.id: r for r in fd.with_defer_flags(_entries(spark), feeds).collect()}
    assert flags[9].defer_post and flags[9].defer_registration and not flags[8].defer_post and flags[5].defer_notification


def test_the_last_reply_counts(spark):
    entries = spark.createDataFrame([(1, "Processing"), (2, "Processing"), (3, "Processing")], "id int, payment_status string")
    replies = spark.createDataFrame([(1, -1, 1), (1, 100, 2), (2, 100, 1), (2, -1, 2)], "id int, code int, at int")
    found = {r.id: r.payment_status for r in s.apply_replies(entries, replies, "G", ["at"]).collect()}
    assert found == {1: "Processing", 2: "Failed", 3: "Processing"}
    assert s.apply_replies(entries, replies, "G").count() == 3


def test_an_empty_list_of_inputs_gives_no_field(spark):
    field = "struct<id:string,label:string,display_only:boolean,inputs:array<struct<id:string,label:string>>>"
    forms = spark.createDataFrame([(1, [("1", "A", False, []), ("2", "B", False, None), ("3", "C", True, None),
                                        ("4", "D", True, [("4.1", "E")])])], f"id int, fields array<{field}>")
    assert sorted(r.field_id for r in fm.form_fields(forms).collect()) == ["2", "4.1"]


def test_building_queries_runs_no_measuring(spark, folder):
    import catalog

    if not catalog.QUERIES:
        catalog.load()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries are only built")
    try:
        for name in ("active_feed", "request_payload", "callback_enrich"):
            catalog.QUERIES[name](spark, folder)
        # Reading the schema of a table is the only job; none has more than its one task.
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("building")]
        stages = [tracker.getStageInfo(k) for j in jobs if j for k in j.stageIds]
        assert all(stage is None or stage.numTasks <= 1 for stage in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_settings_without_a_name_of_their_own_survive(spark):
    texts = ['{"type":"product","conf_1":["a"],"colour":"1","size":1,"deep":{"x":[1,"2"]},"none":null}', '{"only":"other"}',
             '{"type":"product"}', "{}", "not json", None]
    feeds = spark.createDataFrame(list(enumerate(texts)), "id int, meta string")
    decoded = fd.decode_meta(feeds)
    after = {r.id: r.meta for r in fd.encode_meta(decoded).collect()}
    assert fd.encode_meta(decoded).columns == feeds.columns
    assert [json.loads(after[i]) for i in range(4)] == [json.loads(t) for t in texts[:4]]
    assert after[5] is None


def test_every_settings_text_comes_back_to_the_letter(spark):
    texts = ['{"type":"product"}', ' { "type" : "product" , "b":1, "a" : [ 1.50, true ] } ', "", "no json", "{", "[]", "null", "0", None,
             '{"type":7}', '{"conf_1":"one"}', '{"type":"a","type":"b"}', '{"g":"\\u0627"}', "{}", '{"gf_x_conf_1":["c"],"conf_1":["d"]}']
    feeds = spark.createDataFrame(list(enumerate(texts)), "id int, meta string")
    for names in (None, fd.stored_names("x", "shop_policy")):
        after = {r.id: r.meta for r in fd.encode_meta(fd.decode_meta(feeds, names=names), names=names).collect()}
        assert [after[i] for i in range(len(texts))] == texts
    # A change is written, the settings without a name stay.
    changed = fd.decode_meta(feeds).withColumn("meta", F.col("meta").withField("desc_pm", F.lit("new")))
    after = {r.id: r.meta for r in fd.encode_meta(changed).collect()}
    assert json.loads(after[1]) == {"type": "product", "desc_pm": "new", "b": 1, "a": [1.5, True]}


def test_settings_under_the_names_of_a_gateway(spark):
    text = ('{"type":"product","gf_x_conf_1":["c2"],"gf_x_notif_4":["n"],"x_conditional_enabled":"1","x_conditional_value":"v",'
            '"shop_policy":"sadt","conf_1":["other"]}')
    names = fd.stored_names("x", "shop_policy")
    decoded = fd.decode_meta(spark.createDataFrame([(1, text)], "id int, meta string"), names=names)
    row = decoded.first()
    assert (row.meta.type, row.meta.conf_1, row.meta.notif_4, row.meta.conditional_enabled, row.meta.conditional_value,
            row.meta.floor_policy) == ("product", ["c2"], ["n"], "1", "v", "sadt")
    assert list(row.meta_other) == ["conf_1"]
    edited = decoded.withColumn("meta", F.col("meta").withField("conf_1", F.array(F.lit("c9"))))
    stored = json.loads(fd.encode_meta(edited, names=names).first().meta)
    assert stored == {**json.loads(text), "gf_x_conf_1": ["c9"]}
