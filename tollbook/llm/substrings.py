"""Removal of repeated byte strings of LENGTH bytes, found by suffix arrays over shards of candidate segments.

Every window of LENGTH bytes has a key: the hash of its GRAM-byte string whose hash is smallest (the first, on ties). Equal
windows have equal keys, and neighbouring windows mostly share one, so a text is a list of runs, each a key, a start and
a number of windows. Runs whose key occurs once in the whole table hold no repeat and are dropped. The segments of the others
are dealt out by key; a shard of them is one text whose suffixes are sorted in two stages, and neighbours with a common
prefix of LENGTH bytes are equal windows. Of equal windows the first by (doc_id, start) stays.

A text that an earlier row has as a whole loses all its bytes and is not looked at further. A segment that recurs is kept once per task before it is sent and once per shard after, with its first place;
the other places are removed there and then. So a passage in a third of all documents meets as one row per task. Keys that recur
inside a task are known as repeated there and are not sent to the key's own partition either. A key with more than GROUP bytes of different
segments is cut into pieces, and what is left of each is compared by an aggregation over whole windows.

Null texts count as empty; texts under LENGTH bytes are never touched. A null doc_id comes before all others. Rows of one
doc_id are one document: of equal strings the one of smaller start is earlier, and none if the starts are equal; rows of one
doc_id and text lose the same bytes. Different texts of one doc_id are numbered, so what one of them loses is taken from it alone; a
doc_id may have 2 ** 23 of them, and rows without a doc_id any number. A text may have 2 ** 31 bytes. Empty tables give no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import id_and_text, kept_table
from tollbook.llm.partenum import mix
from tollbook.llm.suffixes import common_prefixes, suffix_order, words_at

LENGTH = 100
GRAM = 32
#: Bytes of a text that are looked at together; bytes of a shard; bytes of one key's segments; runs held in a task.
SLICE = 1 << 22
SHARD = 1 << 22
GROUP = 1 << 25
HELD = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 24) - 1)
#: A place: the start, eight bits of windows, the text's number among those of its doc_id, and whether its key is known to recur.
TEXT_BITS = 23
TEXTS = (1 << TEXT_BITS) - 1
WINDOW_AT, START_AT = TEXT_BITS + 1, TEXT_BITS + 9
NO_ID = -(1 << 63)


def runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each run, over at most 2 ** 24 bytes."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    power, width = _BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % (1 << 64), 2 * width
    h = mix(h)
    least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    wide, span = 1, LENGTH - GRAM + 1
    while 2 * wide <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return (h[(least[start] & _LOW).astype(np.int64)].view(np.int64), start, np.diff(np.r_[start, len(least)]))


def numbered_texts(docs: DataFrame) -> DataFrame | None:
    """doc_id, sha, pos and check of the texts whose doc_id other texts have too, or none; None if there are none."""
    rows = id_and_text(docs)
    shared = kept_table(rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "shared")
    if shared.isEmpty():
        return None
    texts = rows.join(shared, rows["doc_id"].eqNullSafe(shared["doc_id"]), "left_semi").select(
        "doc_id", _sha(F.col("text")).alias("sha")).distinct()
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("sha")).cast("long") - 1
    fits = F.when(F.col("doc_id").isNull() | (F.col("n") <= TEXTS), F.col("n")).otherwise(
        F.raise_error(F.lit("too many texts of one doc_id")).cast("long"))
    return kept_table(texts.withColumn("n", number).withColumn("n", fits).select(
        "doc_id", "sha", F.coalesce("doc_id", F.lit(NO_ID) + F.shiftright("n", TEXT_BITS)).alias("pos"),
        F.col("n").bitwiseAND(TEXTS).alias("check")), "numbered")


def _sha(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def placed(docs: DataFrame, numbered: DataFrame | None) -> DataFrame:
    """doc_id, pos (doc_id, those without one first), check (the text's number among those of its doc_id) and text."""
    rows = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if numbered is None:
        return rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("pos"), F.lit(0).cast("long").alias("check"), "text")
    ids = numbered.select(F.col("doc_id").alias("_id")).distinct()
    # Only texts that share their doc_id are hashed.
    marked = rows.join(ids, rows["doc_id"].eqNullSafe(ids["_id"]) , "left_semi").withColumn("_sha", _sha(F.col("text")))
    known = numbered.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"), "pos", "check")
    shared = marked.join(known, marked["doc_id"].eqNullSafe(known["_id"]) & (marked["_sha"] == known["_sha"])).select(
        "doc_id", "pos", "check", "text")
    alone = rows.join(ids, rows["doc_id"].eqNullSafe(ids["_id"]), "left_anti").select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("pos"), F.lit(0).cast("long").alias("check"), "text")
    return alone.unionByName(shared)


def run_rows(rows: DataFrame) -> DataFrame:
    """key, pos, and place: start, windows, check and whether the key is known to recur, in one number.

    A row with no windows only tells the key's partition that the key recurs elsewhere.
    """

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            key, pos, place = (np.concatenate(x) for x in zip(*held))
            same, back, n = np.unique(key, return_inverse=True, return_counts=True)
            twice = n > 1
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(np.r_[key, same[twice]]),
                "pos": pa.array(np.r_[pos, np.zeros(twice.sum(), np.int64)]),
                "place": pa.array(np.r_[place + twice[back], np.zeros(twice.sum(), np.int64)])})

        for batch in batches:
            for pos, check, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for at in range(0, max(len(data) - LENGTH + 1, 0), SLICE):
                    key, start, n = runs(data[at : at + SLICE + LENGTH - 1])
                    held.append((key, np.full(len(key), pos, np.int64), place_of(start + at, n, check)))
                    size += len(key)
                if size >= HELD:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return rows.select("pos", "check", "text").mapInArrow(run, "key long, pos long, place long")


def place_of(start, windows, check):
    return (start << START_AT) | (windows << WINDOW_AT) | (check << 1)


def start_of(place):
    return place >> START_AT


def windows_of(place):
    return (place >> WINDOW_AT) & 0xFF


def text_of(place):
    return (place >> 1) & TEXTS


def repeated_runs(rows: DataFrame) -> DataFrame:
    """The rows whose key occurs more than once. Known ones are spread by document, the others meet by key."""

    def run(batches):
        left = [np.zeros(0, np.int64)] * 3

        def chosen(key, pos, place):
            new = np.r_[True, key[1:] != key[:-1]]
            group = np.cumsum(new) - 1
            keep = ((np.bincount(group)[group] > 1) | (place & 1 > 0)) & (windows_of(place) > 0)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, pos, place)], ["key", "pos", "place"])

        for batch in batches:
            new = [np.concatenate([x, c.to_numpy()]) for x, c in zip(left, batch.columns)]
            cut = int(np.searchsorted(new[0], new[0][-1])) if len(new[0]) else 0
            if cut:
                yield from chosen(*(x[:cut] for x in new))
            left = [x[cut:] for x in new]
        if len(left[0]):
            yield from chosen(*left)

    deal = F.when(F.col("place").bitwiseAND(1) == 1, F.xxhash64("pos", "place")).otherwise(F.col("key"))
    return rows.repartition(deal).sortWithinPartitions("key").mapInArrow(run, "key long, pos long, place long")


SEGMENTS = "key long, seg binary, pos long, place long"


def segments(found: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of repeated runs, each different segment once per task; rows without bytes are removed windows."""
    listed = found.groupBy("pos", "check").agg(F.collect_set(F.struct("key", "place")).alias("runs"))

    def run(batches):
        first: dict[tuple[int, bytes], tuple[int, int]] = {}
        size, gone = 0, []

        def flush():
            rows = [(k, s, *at) for (k, s), at in first.items()] + [(None, None, *at) for at in gone]
            for i in range(0, len(rows), 20_000):
                key, seg, pos, place = zip(*rows[i : i + 20_000])
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(key, pa.int64()), "seg": pa.array(seg, pa.binary()),
                    "pos": pa.array(pos, pa.int64()), "place": pa.array(place, pa.int64())})
            first.clear()
            gone.clear()

        for batch in batches:
            for pos, text, listing in zip(batch.column("pos").to_pylist(), batch.column("text"), batch.column("runs")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for r in listing.as_py():
                    a, n = start_of(r["place"]), windows_of(r["place"])
                    of, at = (r["key"], data[a : a + n + LENGTH - 1]), (pos, r["place"])
                    known = first.setdefault(of, at)
                    if known is at:
                        size += len(of[1])
                    elif known != at:
                        gone.append(max(known, at))
                        first[of] = min(known, at)
                if size >= 4 * SHARD:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.join(listed, ["pos", "check"]).select("pos", "text", "runs").mapInArrow(run, SEGMENTS)


def equal_windows(segs: list[bytes], pos: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all windows of the segments: segment, offset, and whether an equal window has an earlier place."""
    lengths = np.array([len(s) + 1 for s in segs])
    text = np.frombuffer(b"\xff".join(segs) + b"\xff", np.uint8)  # a byte that UTF-8 never has parts the segments
    owner = np.repeat(np.arange(len(segs)), lengths)
    offset = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    words = words_at(text, LENGTH)
    order = suffix_order(text, LENGTH, words)
    order = order[(lengths[owner] - 1 - offset)[order] >= LENGTH]
    equal = common_prefixes(order, words, LENGTH) >= LENGTH
    seg, off = owner[order], offset[order]
    at = np.stack([pos[seg], start_of(place[seg]) + off], 1)
    by = np.lexsort((at[:, 1], at[:, 0]))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(np.r_[False, (at[by][1:] != at[by][:-1]).any(1)]) if len(by) else 0
    new = np.flatnonzero(~equal)
    least = np.minimum.reduceat(rank, new) if len(new) else rank
    return seg, off, rank > np.repeat(least, np.diff(np.r_[new, len(order)]))


REMOVED = "pos long, place long, win binary"


def _windows(pos, start, check):
    """Places of single windows."""
    return pa.array(pos), pa.array(place_of(start, 1, check))


def removed_windows(rows: DataFrame) -> DataFrame:
    """pos and place of removed windows; rows with `win`, the window itself, are still to be compared."""

    def run(batches):
        shard: list[tuple[bytes, int, int]] = []
        size = 0

        def out(pos, place, win=None):
            return pa.RecordBatch.from_pydict({
                "pos": pos, "place": place, "win": pa.nulls(len(pos), pa.binary()) if win is None else pa.array(win, pa.binary())})

        def solve(part, rest=False):
            segs, pos, place = [x[0] for x in part], np.array([x[1] for x in part]), np.array([x[2] for x in part])
            seg, off, gone = equal_windows(segs, pos, place)
            start, check = start_of(place[seg]) + off, text_of(place[seg])
            if gone.any():
                yield out(*_windows(pos[seg][gone], start[gone], check[gone]))
            if rest:
                left = np.flatnonzero(~gone)
                for i in range(0, len(left), 50_000):
                    s = left[i : i + 50_000]
                    yield out(*_windows(pos[seg][s], start[s], check[s]),
                              [segs[a][b : b + LENGTH] for a, b in zip(seg[s], off[s])])

        key, group, held, cut = None, [], 0, False

        def close():
            """The group of a key is complete: a single segment has no partner and no repeat of its own."""
            nonlocal shard, size
            if cut:
                if group:
                    yield from solve(group, rest=True)
            elif len(group) > 1:
                shard += group
                size += held
                if size >= SHARD:
                    yield from solve(shard)
                    shard, size = [], 0

        for batch in batches:
            gone = []
            for k, seg, pos, place in zip(*(c.to_pylist() for c in batch.columns)):
                if seg is None:
                    gone.append((pos, place))
                    continue
                if k != key:
                    yield from close()
                    key, group, held, cut = k, [], 0, False
                if group and group[-1][0] == seg:  # sorted: the first place of a segment comes first
                    if group[-1][1:] != (pos, place):
                        gone.append((pos, place))
                    continue
                group.append((seg, pos, place))
                held += len(seg) + 1
                if held >= GROUP:
                    yield from solve(group, rest=True)
                    group, held, cut = [], 0, True
            if gone:
                pos, place = zip(*gone)
                yield out(pa.array(pos, pa.int64()), pa.array(place, pa.int64()))
        yield from close()
        if shard:
            yield from solve(shard)

    deal = F.when(F.col("seg").isNull(), F.xxhash64("pos", "place")).otherwise(F.col("key"))
    return rows.repartition(deal).sortWithinPartitions("key", "seg", "pos", "place").mapInArrow(run, REMOVED)


def compared(rows: DataFrame) -> DataFrame:
    """pos and place of removed windows, with those that came as whole windows compared over all tasks."""
    rows = kept_table(rows, "removed")
    done = rows.filter("win is null").select("pos", "place")
    rest = rows.filter("win is not null").withColumn("at", F.struct("pos", F.shiftright("place", START_AT).alias("start")))
    if rest.isEmpty():
        return done
    first = rest.groupBy("win").agg(F.min("at").alias("first"))
    return done.unionByName(rest.join(first, "win").filter("at > first").select("pos", "place"))


def _text_of(place: str):
    return F.shiftright(place, 1).bitwiseAND(TEXTS)


def copies(rows: DataFrame) -> DataFrame:
    """pos and check of texts of LENGTH bytes or more that an earlier row has as a whole: all of their windows are repeats."""
    whole = rows.filter(F.octet_length("text") >= LENGTH).select("pos", "check", _sha(F.col("text")).alias("sha"))
    # As a table of known size, so that a text with very many copies usually need not meet in one place.
    first = kept_table(whole.groupBy("sha").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
                       .filter("first < last").select("sha", "first"), "first")
    return kept_table(whole.join(first, "sha").filter("pos > first").select("pos", "check").distinct(), "copies")


def removals(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """pos, check and spans (start, windows) of what goes, for the texts that lose bytes and are no whole copies."""
    # Rows that repeat are one place, whichever of their tasks knew the key to recur.
    found = repeated_runs(run_rows(rows)).withColumn("place", F.col("place").bitwiseAND(F.lit(-2)))
    found = found.withColumn("check", _text_of("place"))
    gone = removed_windows(segments(found.join(whole, ["pos", "check"], "left_anti"), rows))
    return compared(gone).groupBy("pos", _text_of("place").alias("check")).agg(
        F.collect_list(F.shiftright("place", WINDOW_AT)).alias("gone"))


def clean(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every row."""

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            columns = batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("gone"), batch.column("copy")
            for doc_id, text, gone, copy in zip(*columns):
                data = text.as_py().encode("utf-8", "surrogatepass")
                kept, removed, spans = data, 0, 0
                if copy.is_valid and len(data) >= LENGTH:
                    kept, removed, spans = b"", len(data), 1
                elif gone.is_valid:
                    g = gone.values.to_numpy()
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, g >> 8, 1)
                    np.add.at(edge, (g >> 8) + (g & 0xFF) + LENGTH - 1, -1)
                    out = np.cumsum(edge[:-1]) > 0
                    removed = int(out.sum())
                    spans = int((out & ~np.r_[False, out[:-1]]).sum())
                    kept = np.frombuffer(data, np.uint8)[~out].tobytes()
                for name, value in zip(rows, (doc_id, len(data), removed, spans, kept)):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict({
                n: pa.array(v, pa.binary() if n == "kept" else pa.int64()) for n, v in rows.items()})

    texts = placed(docs, numbered_texts(docs))
    whole = copies(texts)
    return (texts.join(removals(texts, whole), ["pos", "check"], "left")
            .join(whole.withColumn("copy", F.lit(True)), ["pos", "check"], "left")
            .select("doc_id", "text", "gone", "copy").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
