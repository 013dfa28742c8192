"""The queries with lookups again, with every broadcast ruled out and few rows counting as hot."""

from __future__ import annotations

import pytest

from compare import compare, connect
from tollbook.operators import joins

QUERIES = ("feed_list", "feed_title_lookup", "lead_feed", "rule_match", "active_feed", "defer_addon", "open_requests",
           "request_payload", "callback_enrich", "settle", "notify_route", "confirmation_route", "post_status_update",
           "upsert_feeds", "post_status_map")


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    monkeypatch.setitem(joins.hot_key_join.__kwdefaults__, "hot_rows", 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_without_broadcasts(spark, folder, no_broadcast, name):
    count, problem = compare(spark, connect(folder), folder, name)
    assert not problem
    assert count
