"""Segmented tables: folding loses and doubles nothing, replays replace, readers keep what they began with."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tollbook.sources.files import names
from tollbook.sources.segments import Segments, append, folders, listed, read, read_keys_like

SCHEMA = "k bigint, v bigint"


def _summed(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("v"))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _batch(spark, n, size=20):
    """Keys that come again in every batch, and one of its own."""
    return spark.createDataFrame([(k, n) for k in range(size)] + [(1000 + n, 1)], SCHEMA)


@pytest.fixture()
def table(tmp_path):
    return Segments(str(tmp_path / "t"), SCHEMA, ("k",), slots=8, fanout=3, fold=_summed)


def test_sums_through_folds_and_replays(spark, table):
    for n in range(14):
        append(_batch(spark, n), table, n, "s")
        if n in (4, 9):
            append(_batch(spark, n), table, n, "s")  # the newest batch again
        wanted = sorted([(k, n * (n + 1) // 2) for k in range(20)] + [(1000 + m, 1) for m in range(n + 1)])
        assert _rows(_summed(read(spark, table))) == wanted
    state = listed(spark, table)
    levels = [s["level"] for s in state["segments"]]
    assert max(levels) >= 2 and all(levels.count(n) <= table.fanout for n in set(levels))
    append(_batch(spark, 0), table, 0, "s")  # folded long ago
    assert _rows(_summed(read(spark, table))) == wanted


def test_a_batch_written_again_replaces_itself(spark, table):
    append(_batch(spark, 1), table, 0, "s")
    append(_batch(spark, 7), table, 0, "s")
    append(_batch(spark, 2), table, 0, "other")
    assert _rows(read(spark, table)) == sorted(_rows(_batch(spark, 7)) + _rows(_batch(spark, 2)))


def test_readers_keep_their_list_while_others_fold(spark, table):
    for n in range(3):
        append(_batch(spark, n), table, n, "s")
    before = read(spark, table)  # planned, not run
    wanted = sorted(r for n in range(3) for r in _rows(_batch(spark, n)))
    for n in range(3, 6):
        append(_batch(spark, n), table, n, "s")
    assert any(s["level"] for s in listed(spark, table)["segments"])
    assert _rows(before) == wanted


def test_old_segments_are_deleted_in_the_end(spark, table):
    for n in range(24):
        append(_batch(spark, n, 2), table, n, "s")
    state = listed(spark, table)
    kept = {s["path"] for s in state["segments"]} | {path for _, path in state["gone"]}
    there = [f"{table.path}/stream=s/{n}" for n in names(spark, f"{table.path}/stream=s")]
    there += [f"{table.path}-folded/{n}" for n in names(spark, f"{table.path}-folded")]
    assert {p for p in there if not p.endswith("_SUCCESS")} <= kept
    assert len(names(spark, f"{table.path}-lists")) <= 20


def test_one_old_key_opens_few_files(spark, table):
    """However many batches there were, the rows of a key stand in one slot of a few segments."""
    for n in range(20):
        append(_batch(spark, n, 200), table, n, "s")
    one = spark.createDataFrame([(3,)], "k bigint")
    found = read_keys_like(one, table)
    state = listed(spark, table)
    assert len(found.inputFiles()) <= len(state["segments"]) <= 3 * table.fanout < 20
    assert len(folders(state)) >= table.slots * len(found.inputFiles()) - table.slots
    assert found.where("k = 3").agg(F.sum("v")).first()[0] == sum(range(20))
    newest = max(s["batch"] for s in state["segments"] if not s["level"])
    without = read_keys_like(one, table, but=("s", newest)).where("k = 3").agg(F.sum("v")).first()[0]
    assert without == sum(range(20)) - newest


def test_nothing_written_reads_as_nothing(spark, table):
    assert read(spark, table).count() == 0 and read(spark, table).columns == ["k", "v"]
    append(_batch(spark, 0).limit(0), table, 0, "s")
    assert read(spark, table).count() == 0


def test_a_writer_that_failed_before_its_list_changed_nothing(spark, table):
    append(_batch(spark, 0), table, 0, "s")
    before = _rows(read(spark, table))
    _batch(spark, 5).withColumn("slot", F.lit(0)).write.partitionBy("slot").parquet(f"{table.path}/stream=s/batch=1")
    assert _rows(read(spark, table)) == before
    append(_batch(spark, 1), table, 1, "s")
    assert _rows(read(spark, table)) == sorted(before + _rows(_batch(spark, 1)))
