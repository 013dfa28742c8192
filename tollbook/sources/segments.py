"""A table that grows by small batches and is folded as it grows.

Every batch is a segment of its own, laid out in slots by a hash of the key. When FANOUT segments of one level have gathered they
are folded into one of the next level, so the table has at most FANOUT segments of each of a few levels, however many batches
it has taken: reading the rows of some keys opens at most that many folders for each slot that the keys fall into. Folding
is a function of the rows, such as summing them.

What counts is named in a numbered list, written after the segments: a reader holds to the list it began with, and a writer that fails
before its list has changed nothing. Folded segments are deleted only GRACE lists later, so that long readers end first. A
batch is known by its stream and number. One that is written again replaces itself; one that has been folded already is in
the table, and is left out. The newest batch of a stream is never folded, as it may be written again.

A path has one writer at a time; a second one that begins from the same list fails when it comes to write the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tollbook.sources.files import names, remove

FANOUT = 16
GRACE = 8
#: A list that this many newer ones follow is deleted.
LISTS_KEPT = 2 * GRACE

Fold = Callable[[DataFrame], DataFrame]


class Segments(NamedTuple):
    """The layout of one table."""

    path: str
    schema: str
    key: tuple[str, ...]
    slots: int = 64
    fanout: int = FANOUT
    #: What becomes of the rows of several segments; the same rows unless told otherwise.
    fold: Fold = lambda rows: rows


def slot(table: Segments):
    return F.pmod(F.xxhash64(*table.key), F.lit(table.slots)).cast("int")


def _lists(table: Segments) -> str:
    return f"{table.path}-lists"


def _versions(spark: SparkSession, table: Segments) -> list[int]:
    return [int(n) for n in names(spark, _lists(table)) if n.isdigit()]


def listed(spark: SparkSession, table: Segments) -> dict:
    """The newest list: the segments that count, those that wait to be deleted, and how far each stream is folded."""
    for version in reversed(_versions(spark, table)):
        where = f"{_lists(table)}/{version:012d}"
        if "_SUCCESS" in names(spark, where):
            (row,) = spark.read.text(where, wholetext=True).collect()
            return json.loads(row.value)
    return {"version": 0, "segments": [], "gone": [], "folded": {}}


def _publish(spark: SparkSession, table: Segments, state: dict) -> None:
    where = f"{_lists(table)}/{state['version']:012d}"
    if "_SUCCESS" not in names(spark, where):
        remove(spark, where)  # what a writer left that failed
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("errorifexists").text(where)
    for old in _versions(spark, table)[:-LISTS_KEPT]:
        remove(spark, f"{_lists(table)}/{old:012d}")


def _write(rows: DataFrame, table: Segments, where: str) -> list[int]:
    """Write one file for each slot; the slots that there are."""
    dealt = rows.select(*StructType.fromDDL(table.schema).names).withColumn("slot", slot(table)).repartition(table.slots, "slot")
    dealt.write.mode("overwrite").partitionBy("slot").parquet(where)
    return [int(n.removeprefix("slot=")) for n in names(rows.sparkSession, where) if n.startswith("slot=")]


def append(rows: DataFrame, table: Segments, batch: int, stream: str) -> None:
    """Add one batch, and fold what has gathered."""
    spark = rows.sparkSession
    state = listed(spark, table)
    if batch <= state["folded"].get(stream, -1):
        return
    # A batch that is written again gets a new folder: readers of the old list keep theirs.
    again = [s for s in state["segments"] if (s["stream"], s["batch"]) == (stream, batch)]
    where = f"{table.path}/stream={stream}/batch={batch}" + f"-{uuid.uuid4().hex[:8]}" * bool(again)
    added = {"path": where, "level": 0, "stream": stream, "batch": batch, "slots": _write(rows, table, where)}
    version = state["version"] + 1
    state = state | {
        "version": version, "segments": [s for s in state["segments"] if s not in again] + [added],
        "gone": state["gone"] + [[version, s["path"]] for s in again]}
    _publish(spark, table, _swept(spark, state))
    fold(spark, table)


def _swept(spark: SparkSession, state: dict) -> dict:
    """Delete what no reader can still hold."""
    late = [g for g in state["gone"] if g[0] + GRACE <= state["version"]]
    for _, path in late:
        remove(spark, path)
    return state | {"gone": [g for g in state["gone"] if g not in late]}


def fold(spark: SparkSession, table: Segments) -> int:
    """Fold every level that is full, the lowest first; how many folds there were."""
    folds = 0
    while True:
        state = listed(spark, table)
        newest = {}
        for s in state["segments"]:
            if s["level"] == 0:
                newest[s["stream"]] = max(newest.get(s["stream"], -1), s["batch"])
        ready: dict[int, list[dict]] = {}
        for s in state["segments"]:
            if s["level"] or s["batch"] < newest[s["stream"]]:
                ready.setdefault(s["level"], []).append(s)
        level = next((n for n in sorted(ready) if len(ready[n]) >= table.fanout), None)
        if level is None:
            return folds
        old = ready[level]
        where = f"{table.path}-folded/{level + 1}-{uuid.uuid4().hex}"
        slots = _write(table.fold(_rows(spark, table, old)), table, where)
        folded = dict(state["folded"])
        for s in old:
            if not s["level"]:
                folded[s["stream"]] = max(folded.get(s["stream"], -1), s["batch"])
        version = state["version"] + 1
        merged = {"path": where, "level": level + 1, "stream": None, "batch": None, "slots": slots}
        _publish(spark, table, _swept(spark, {
            "version": version, "segments": [s for s in state["segments"] if s not in old] + [merged],
            "gone": state["gone"] + [[version, s["path"]] for s in old], "folded": folded}))
        folds += 1


def folders(state: dict, slots: Iterable[int] | None = None, but: tuple[str, int] | None = None) -> list[str]:
    """The folders that hold the rows of some slots (all without any), but for one batch."""
    wanted = None if slots is None else set(slots)
    return [f"{s['path']}/slot={n}" for s in state["segments"] if (s["stream"], s["batch"]) != but
            for n in s["slots"] if wanted is None or n in wanted]


def _rows(spark: SparkSession, table: Segments, segments: list[dict]) -> DataFrame:
    return _scan(spark, table, folders({"segments": segments}))


def _scan(spark: SparkSession, table: Segments, paths: list[str]) -> DataFrame:
    return spark.read.schema(table.schema).parquet(*paths) if paths else spark.createDataFrame([], table.schema)


def read(spark: SparkSession, table: Segments) -> DataFrame:
    """All rows that count now. Rows of the same key may stand in several segments, as `fold` would find them."""
    return _rows(spark, table, listed(spark, table)["segments"])


def read_keys_like(rows: DataFrame, table: Segments, but: tuple[str, int] | None = None) -> DataFrame:
    """The rows in the slots that the keys of `rows` fall into, but for those of one batch.

    The slots of `rows`, at most as many as the table has, come to the driver.
    """
    spark = rows.sparkSession
    slots = [r.slot for r in rows.select(slot(table).alias("slot")).distinct().collect()]
    return _scan(spark, table, folders(listed(spark, table), slots, but))
