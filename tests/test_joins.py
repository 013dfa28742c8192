"""Skewed joins against plain ones: a third and more of the rows share one key."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import plan_of
from tollbook.operators.joins import first_per_key, hot_key_join, lookup_join


def _rows(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    return spark.range(3000).select("id", key.alias("k"))


def _table(spark):
    return spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def _sorted(df):
    return sorted((tuple(r[c] for c in ("id", "k", "v")) for r in df.collect()), key=str)


def test_lookup_join(spark):
    rows, table = _rows(spark), _table(spark)
    for how in ("left", "inner"):
        assert _sorted(lookup_join(rows, table, "k", how)) == _sorted(rows.join(table, "k", how))


def test_hot_key_join(spark):
    rows, table = _rows(spark), _table(spark)
    for how in ("left", "inner"):
        for hot_rows in (100, 10**6):
            joined = hot_key_join(rows, table, "k", how, spread_by=["id"], hot_rows=hot_rows)
            assert _sorted(joined) == _sorted(rows.join(table, "k", how))


def test_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hot_key_join(_rows(spark), _table(spark), "k", "inner", spread_by=["id"], hot_rows=100)
        tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_first_per_key_breaks_ties(spark):
    rows = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 6, "c"), (2, None, "z"), (2, 1, "y")],
                                 "k int, o int, v string")
    assert sorted(map(tuple, first_per_key(rows, ["k"], ["o"]).collect()), key=str) == [(1, 5, "a"), (2, None, "z")]
    assert sorted(map(tuple, first_per_key(rows, ["k"], ["o"], last=True).collect())) == [(1, 6, "c"), (2, 1, "y")]
    plan = plan_of(first_per_key(rows, ["k"], ["o"]))
    assert "partial_min" in plan and "Window" not in plan
