"""The trie of conversation prefixes, by truncation peeling.

Rebuilding a conversation is a window and joins. Each becomes one row: its path, 16 bytes of a hash for every turn, and the
lengths of its texts. The rows are dealt by ranges of (path, conv_id), so a prefix that many conversations share, or a group of
equal ones, spreads over as many tasks as its rows ask for, and stands in one run of each.

A task peels the rows of a block from the greatest depth up. At each depth the conversations that end there join the nodes that
survive from below; what agrees on the path so far is one node, whose counts are sums; then its last turn is cut off and it goes on
as a child of the next depth. A node found in the inside of a block is complete. Only prefixes of the block's first and last row
may go on in a neighbouring block: these two chains leave the block as rows of their own, with what each depth has gathered, and
are peeled again in the same way, in ranges, until one block holds them all. A level has at most an eighth of the rows of
the one before, so there are three or four levels for any table, whatever its depth; no level needs a row of the nodes that
are complete. The ids that end in a chain's node leave as pieces of text, are ordered by node and hashed in a stream.

Defined results: rows without a conv_id are not read. Null role and text are empty. Turns of one number (null comes first) follow
by role, then text; repeated rows are turns like others. Texts have any length; only their hash and length travel, and the
text itself only where a turn's number repeats in its conversation. A turn is known by 128 bits of SHA-256. A conversation is one
row of 24 bytes a turn, so one of tens of millions of turns still fits. An empty table gives no node, as the root would have no
member. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import kept_table, ship

#: Turns taken over from the first conversation of a hundred: fewer than this.
HEADS = 6
HUNDRED = 100
#: Rows and turns of a block; LEAST_ROWS whatever their turns.
BLOCK_ROWS, BLOCK_TURNS, LEAST_ROWS = 1 << 16, 1 << 18, 16
#: A level of as many rows, or of as many turns, is the last one.
LAST_ROWS, LAST_TURNS = 4096, 1 << 21
MARK = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

VALUES = ("n", "least", "kids", "leaves", "saved")
NODE = {"key": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(),
        "parent_key": pa.binary(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
        "saved_tokens": pa.int64(), "ends_sha256": pa.string()}
CHAIN = {"path": pa.binary(), "lens": pa.list_(pa.int64()), "first": pa.int64(), "tie": pa.int64(),
         **{v: pa.list_(pa.int64()) for v in VALUES}}
ENDS = {"ends_key": pa.binary(), "ends_first": pa.int64(), "ends_text": pa.binary()}
ALL = pa.schema([*NODE.items(), *CHAIN.items(), *ENDS.items()])
TYPES = ("key binary, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long,"
         " n_leaves long, saved_tokens long, ends_sha256 string, path binary, lens array<long>, first long, tie long,"
         " n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>,"
         " ends_key binary, ends_first long, ends_text binary")


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, path, lens of every conversation, after the first turns of its hundred's first one took the place of its own."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), text("role").alias("role"),
        text("text").alias("text"))
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    # As a table of known size, so that usually no text is shuffled for it.
    repeats = kept_table(turns.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.lit(True).alias("tied")), "repeats")
    same = (F.col("conv_id") == F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn"))
    marked = turns.join(repeats, same, "left").select(
        "conv_id", "turn", "role", F.when(F.col("tied"), F.col("text")).alias("tie"),
        F.substring(mark, 1, 2 * MARK).alias("mark"), F.length("text").cast("long").alias("len"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "tie")
    own = marked.withColumn("place", F.row_number().over(order)).select("conv_id", "place", "mark", "len")
    base = F.col("conv_id") % HUNDRED == 0
    lent = own.filter(base & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "base")
    asking = own.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED)
    taken = asking.filter(~base).join(lent, "base").filter(F.col("place") <= heads(F.col("conv_id")))
    parts = own.filter(base | (F.col("place") > heads(F.col("conv_id")))).unionByName(taken.drop("base"))
    turn = F.struct("place", "mark", "len").alias("turn")
    # A conversation that loses all its turns still stands there.
    rows = parts.select("conv_id", turn).unionByName(
        asking.select("conv_id", F.lit(None).cast(parts.select(turn).schema["turn"].dataType).alias("turn")))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.col("turns.mark"), "")).alias("path"),
                        F.col("turns.len").alias("lens"))


@dataclass
class Rows:
    """Rows in the order of their paths, and what they bring to the nodes of their paths."""

    paths: list[bytes]
    lens: list[np.ndarray]
    ties: np.ndarray
    #: Of each contribution its row, its depth, and VALUES; of conversations the ids that end there.
    row: np.ndarray
    depth: np.ndarray
    values: dict[str, np.ndarray]
    ids: np.ndarray | None = None


def of_conversations(batch: pa.Table) -> Rows:
    paths, ids = batch["path"].to_pylist(), np.asarray(batch["conv_id"].combine_chunks())
    lens = [np.asarray(x, dtype=np.int64) for x in batch["lens"].to_pylist()]
    zero = np.zeros(len(ids), dtype=np.int64)
    return Rows(paths, lens, ids, np.arange(len(ids)), np.array([len(p) // MARK for p in paths], dtype=np.int64),
                {"n": zero + 1, "least": ids, "kids": zero, "leaves": zero, "saved": zero}, ids)


def of_chains(batch: pa.Table) -> Rows:
    paths, first = batch["path"].to_pylist(), batch["first"].to_pylist()
    lens = [np.asarray(x, dtype=np.int64) for x in batch["lens"].to_pylist()]
    counts = [len(x) for x in batch["n"].to_pylist()]
    depth = np.concatenate([np.arange(f, f + c) for f, c in zip(first, counts)])
    flat = {v: np.asarray(batch[v].combine_chunks().flatten(), dtype=np.int64) for v in VALUES}
    return Rows(paths, lens, np.asarray(batch["tie"].combine_chunks()), np.repeat(np.arange(len(paths)), counts), depth, flat)


class Shared:
    """How many turns rows agree on, by a table of minima over spans of 2 ** i neighbours."""

    def __init__(self, paths: list[bytes]) -> None:
        self.next = np.array([_agree(a, b) for a, b in zip(paths, paths[1:])], dtype=np.int64)
        self.spans = [self.next]
        while (width := 1 << (len(self.spans) - 1)) * 2 <= len(self.next):
            last = self.spans[-1]
            self.spans.append(np.minimum(last[:-width], last[width:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Turns that rows a and b (not before a) share; equal rows share all."""
        out = np.full(len(a), np.iinfo(np.int64).max)
        apart = b > a
        low, width = a[apart], (b - a)[apart]
        step = np.frexp(width)[1] - 1
        found = np.empty(len(low), dtype=np.int64)
        for s in np.unique(step):
            own = step == s
            span = self.spans[s]
            found[own] = np.minimum(span[low[own]], span[low[own] + width[own] - (1 << s)])
        out[apart] = found
        return out


def _agree(a: bytes, b: bytes) -> int:
    short = min(len(a), len(b))
    if a[:short] == b[:short]:
        return short // MARK
    x, y = np.frombuffer(a[:short], np.uint8), np.frombuffer(b[:short], np.uint8)
    return int(np.argmax(x != y)) // MARK


def node_keys(path: bytes) -> list[bytes]:
    """A key for every prefix of a path, from the root's."""
    keys = [hashlib.sha256(b"").digest()[:MARK]]
    for at in range(0, len(path), MARK):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + MARK]).digest()[:MARK])
    return keys


@dataclass
class Chain:
    """Nodes of a block that others may share: the prefixes of one row from a depth on, and what they gathered."""

    path: bytes
    lens: np.ndarray
    first: int
    tie: int
    keys: list[bytes] = field(init=False)
    gathered: dict[str, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        size = len(self.path) // MARK - self.first + 1
        self.keys = node_keys(self.path)
        self.gathered = {v: np.full(size, np.iinfo(np.int64).max if v == "least" else 0) for v in VALUES}


def peel(rows: Rows, last: bool) -> Iterator[pa.RecordBatch]:
    """Nodes that are complete, the two chains that may not be (none at the last level), and the ids that end in chains."""
    shared, size = Shared(rows.paths), len(rows.paths)
    depths = np.array([len(p) // MARK for p in rows.paths], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(depths)[:-1]])
    lens = np.concatenate(rows.lens) if size else np.empty(0, np.int64)
    ends = np.array([0, size - 1])
    both = int(shared.least(ends[:1], ends[1:])[0]) if size > 1 else int(depths[0])
    chains = [Chain(rows.paths[0], rows.lens[0], 0, int(rows.ties[0]))]
    if depths[-1] > both:
        chains.append(Chain(rows.paths[-1], rows.lens[-1], both + 1, int(rows.ties[-1])))
    by_depth = np.argsort(-rows.depth, kind="stable")
    cuts = np.searchsorted(-rows.depth[by_depth], -np.arange(depths.max(), -2, -1))
    below = {"row": np.empty(0, np.int64), **{v: np.empty(0, np.int64) for v in VALUES}, "text": []}
    for turn, depth in enumerate(range(int(depths.max()), -1, -1)):
        come = by_depth[cuts[turn] : cuts[turn + 1]]
        row = np.concatenate([below["row"], rows.row[come]])
        if not len(row):
            continue
        order = np.argsort(row, kind="stable")
        row = row[order]
        begins = np.flatnonzero(np.concatenate([[True], shared.least(row[:-1], row[1:]) < depth]))
        start = row[begins]
        was_child = len(below["row"])
        child = np.concatenate([np.ones(was_child, np.int64), rows.values["kids"][come]])
        merged = {v: np.concatenate([below[v], rows.values[v][come]])[order] for v in ("n", "least", "leaves", "saved")}
        node = {v: np.add.reduceat(merged[v], begins) for v in ("n", "leaves", "saved")}
        node["least"] = np.minimum.reduceat(merged["least"], begins)
        node["kids"] = np.add.reduceat(child[order], begins)
        member = np.searchsorted(begins, np.argsort(order, kind="stable"), side="right") - 1
        opened = np.full(len(start), -1)
        if not last:
            if depth <= depths[-1]:
                opened[shared.least(start, np.full(len(start), size - 1)) >= depth] = len(chains) - 1
            if depth <= depths[0]:
                opened[shared.least(np.zeros(len(start), np.int64), start) >= depth] = 0
        for which in np.flatnonzero(opened >= 0):
            chain = chains[opened[which]]
            for v in VALUES:
                chain.gathered[v][depth - chain.first] = node[v][which]
        closed = opened < 0
        # Children, now that their parents are known.
        if was_child:
            yield _nodes(below, depth + 1, member[:was_child], node, closed, [
                chains[o].keys[depth] if o >= 0 else None for o in opened])
        ended: list = [None] * len(start)
        if rows.ids is not None and len(come):
            group, at = member[was_child:], np.flatnonzero(np.diff(member[was_child:], prepend=-1))
            for begin, end in zip(at, [*at[1:], len(come)]):
                text = ",".join(map(str, rows.ids[come[begin:end]].tolist())).encode()
                which = group[begin]
                if closed[which]:
                    ended[which] = hashlib.sha256(text).hexdigest()
                else:
                    yield _batch({"ends_key": [chains[opened[which]].keys[depth]],
                                  "ends_first": [int(rows.ids[come[begin]])], "ends_text": [text]})
        own = lens[offsets[start] + depth - 1] if depth else np.zeros(len(start), np.int64)
        node["saved"] = node["saved"] + (node["n"] - 1) * own
        node["leaves"] = np.where(node["kids"] == 0, 1, node["leaves"])
        kept = np.flatnonzero(closed)
        keys = None if rows.ids is not None else [node_keys(rows.paths[r][: depth * MARK])[-1] for r in start[kept]]
        below = {"row": start[kept], **{v: node[v][kept] for v in VALUES}, "keys": keys,
                 "text": [ended[w] or NO_ENDS for w in kept]}
    if len(below["row"]):  # the root itself, at the last level
        yield _nodes(below, 0, np.zeros(1, np.int64), None, None, [None])
    if not last:
        yield _batch({
            "path": [c.path for c in chains], "lens": [c.lens.tolist() for c in chains], "first": [c.first for c in chains],
            "tie": [c.tie for c in chains], **{v: [c.gathered[v].tolist() for c in chains] for v in VALUES}})


def _nodes(below: dict, depth: int, parent: np.ndarray, above: dict | None, closed: np.ndarray | None,
           keys: list[bytes | None]) -> pa.RecordBatch:
    known = [None] if above is None else [
        int(above["least"][p]) if closed[p] else None for p in parent]
    return _batch({
        "key": below["keys"] or [None] * len(parent), "conv_id": below["least"], "depth": np.full(len(parent), depth),
        "parent_conv_id": known, "parent_key": [keys[p] for p in parent], "n_convs": below["n"],
        "n_children": below["kids"], "n_leaves": below["leaves"], "saved_tokens": below["saved"],
        "ends_sha256": below["text"]})


def _batch(columns: dict) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in ALL], schema=ALL)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows put together to blocks of BLOCK_ROWS or BLOCK_TURNS."""
    held: list[pa.RecordBatch] = []
    rows = turns = 0
    for batch in batches:
        sizes = np.diff(np.asarray(batch.column("lens").offsets))
        start = 0
        for i, n in enumerate(sizes.tolist()):
            rows, turns = rows + 1, turns + n
            if rows >= BLOCK_ROWS or turns >= BLOCK_TURNS and rows >= LEAST_ROWS:
                yield pa.Table.from_batches([*held, batch.slice(start, i + 1 - start)])
                held, rows, turns, start = [], 0, 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _peeled(ordered: DataFrame, level: int, last: bool) -> DataFrame:
    make = of_chains if level else of_conversations

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches(list(batches))] if last else _blocks(batches)
        for table in tables:
            if table.num_rows:
                yield from peel(make(table), last)

    return kept_table(ordered.mapInArrow(run, TYPES), f"peel{level}")


def _end_hashes(pieces: DataFrame) -> DataFrame:
    """The hash of each key's pieces, joined in the order of their first id; one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for new, text in zip(batch.column(0), batch.column(2)):
                if new.as_py() == key:
                    state.update(b",")
                else:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = new.as_py(), hashlib.sha256()
                state.update(text.as_buffer())
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(("key", "sha"), map(list, zip(*done)))))
                done = []
        if state:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha": [state.hexdigest()]})

    dealt = pieces.select("ends_key", "ends_first", "ends_text").repartition("ends_key").sortWithinPartitions(
        "ends_key", "ends_first")
    return dealt.mapInArrow(run, "key binary, sha string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    spark = conversations.sparkSession
    ship(spark)
    rows = kept_table(rebuilt(conversations), "rebuilt")
    peeled = [_peeled(rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id"), 0, False)]
    while True:
        chains = peeled[-1].filter(F.col("path").isNotNull()).select(*CHAIN)
        count, turns = chains.agg(F.count("*"), F.coalesce(F.sum(F.size("lens")), F.lit(0))).first()
        if not count:
            break
        last = count <= LEAST_ROWS or count <= LAST_ROWS and turns <= LAST_TURNS
        dealt = chains.coalesce(1) if last else chains.repartitionByRange(-(-count // LAST_ROWS) * 4, "path", "tie")
        peeled.append(_peeled(dealt.sortWithinPartitions("path", "tie"), len(peeled), last))
    inner = peeled[0].filter(F.col("n_convs").isNotNull()).select(*NODE)
    if len(peeled) == 1:
        return _output(inner)
    border = peeled[1]
    for more in peeled[2:]:
        border = border.unionByName(more)
    border = kept_table(border.filter(F.col("n_convs").isNotNull()).select(*NODE), "border")
    hashes = _end_hashes(peeled[0].filter(F.col("ends_key").isNotNull()))
    ended = border.drop("ends_sha256").join(hashes, "key", "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(NO_ENDS))).select(*NODE)
    # Adaptive execution broadcasts the border's keys, or splits the rows of a key with many children.
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    nodes = inner.unionByName(ended)
    asking = nodes.filter(F.col("parent_key").isNotNull()).join(parents, "parent_key").withColumn("parent_conv_id", F.col("_parent"))
    return _output(nodes.filter(F.col("parent_key").isNull())).unionByName(_output(asking))


def _output(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
