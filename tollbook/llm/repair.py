"""Token ids on disk, compressed by Re-Pair.

Ids are written in shards, in ascending doc_id order, a row of a Parquet table each. A shard's ids are reduced to a body by
rules: in rounds, pairs that are frequent in the shard become a new symbol each, until a round gains too little. A row keeps
the body, the two sides of every rule and how many ids each rule expands to, so that any range of ids can be read by
expanding only the symbols that cover it.

A shard is given ROUNDS rounds of at most RULES_A_ROUND rules each; a pair counts from LEAST_COUNT occurrences on, and the rounds end when
one shortens the shard by less than LEAST_GAIN. So no rule covers more than 2 ** ROUNDS ids; the ids are whole all the same.

Null texts count as empty and hold the end id alone. Null ids come first. Repeated rows are written each time; rows of one
doc_id are ordered by their text. A document longer than a shard has one of its own. An empty table gives no rows; other columns
are not read, whatever their names.

A shard knows how many ids of its part are before it; adding up the parts, whose number is the number of partitions, is all
that is done on the driver.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm.common import chunks, id_and_text
from tollbook.llm.tokenization import byte_encoder
from tollbook.session import new_path

#: Ids of a shard (a longer document has a shard of its own), the first symbol of the rules, and when to stop.
SHARD = 1 << 20
FIRST_RULE = 1 << 20
ROUNDS = 4
RULES_A_ROUND = 4096
LEAST_COUNT = 8
CELL_BITS = 20
LEAST_GAIN = 0.03
#: Characters of text that are encoded at a time.
CHUNK_CHARS = 1 << 22

SHARDS = ("part int, shard int, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, body binary, "
          "rules binary, rule_tokens binary")


def nth_largest(counts: np.ndarray, n: int) -> int:
    """The n-th largest of counts of which there are at least n, by how often each number occurs."""
    return int(np.flatnonzero(np.cumsum(np.bincount(counts)[::-1])[::-1] >= n)[-1])


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Body, rules (left and right symbol of each) and the number of ids each rule expands to."""
    seq = ids.astype(np.uint32)
    rules, tokens = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)]
    made = 0
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        pairs = (seq[:-1].astype(np.uint64) << np.uint64(32)) | seq[1:]
        cell = ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CELL_BITS)).astype(np.int32)
        counts = np.bincount(cell, minlength=1 << CELL_BITS)
        cells = np.flatnonzero(counts >= max(LEAST_COUNT, nth_largest(counts, RULES_A_ROUND)))
        if not len(cells):
            break
        rank = np.full(1 << CELL_BITS, -1, np.int32)
        rank[cells] = np.arange(len(cells))
        number = rank[cell]
        at = np.flatnonzero(number >= 0)
        number = number[at]
        found = np.zeros(len(cells), np.uint64)
        found[number] = pairs[at]  # the pair of a cell; others that share the cell wait for the next round
        chosen = pairs[at] == found[number]
        at, number = at[chosen], number[chosen]
        frequent = np.bincount(number, minlength=len(cells))[number] >= LEAST_COUNT
        at, number = at[frequent], number[frequent]
        if not len(at):
            break
        # Of overlapping pairs, every second one of a run counts, from the left.
        new_run = np.r_[True, np.diff(at) > 1]
        first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - first) % 2 == 0
        at, number = at[taken], number[taken]
        held = np.bincount(number, minlength=len(cells)) > 0
        used, number = np.flatnonzero(held), (np.cumsum(held) - 1)[number]
        pair = found[used]
        sides = np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        known = np.concatenate(tokens)
        seq[at] = FIRST_RULE + made + number
        left = np.ones(len(seq), bool)
        left[at + 1] = False
        seq = seq[left]
        sizes = np.where(sides >= FIRST_RULE, known[np.where(sides >= FIRST_RULE, sides - FIRST_RULE, 0)]
                         if made else 1, 1).sum(1)
        rules.append(sides)
        tokens.append(sizes.astype(np.uint32))
        made += len(used)
        if len(at) < LEAST_GAIN * len(seq):
            break
    return seq, np.concatenate(rules), np.concatenate(tokens)


def expand(body: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """Ids of symbols: each rule is written out, in as many steps as the grammar is deep, and copied to where it stands."""
    rule = body >= FIRST_RULE
    if not rule.any():
        return body
    own = body[rule] - FIRST_RULE
    ids, owner = rules.reshape(-1), np.repeat(np.arange(len(rules)), 2)
    while (inner := ids >= FIRST_RULE).any():
        times = 1 + inner
        at = np.cumsum(times) - times
        sides, out = rules[ids[inner] - FIRST_RULE], np.empty(len(ids) + int(inner.sum()), np.uint32)
        out[at] = ids
        out[at[inner]], out[at[inner] + 1] = sides[:, 0], sides[:, 1]
        ids, owner = out, np.repeat(owner, times)
    size = np.bincount(owner, minlength=len(rules))
    length, start = np.ones(len(body), np.int64), len(ids) + np.arange(len(body))
    length[rule], start[rule] = size[own], (np.cumsum(size) - size)[own]
    before = np.cumsum(length) - length
    return np.concatenate([ids, body])[np.repeat(start - before, length) + np.arange(int(length.sum()))]


def expand_range(body: np.ndarray, rules: np.ndarray, rule_tokens: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Ids start to stop, by expanding only the symbols that cover them."""
    sizes = np.ones(len(body), np.int64)
    rule = body >= FIRST_RULE
    sizes[rule] = rule_tokens[body[rule] - FIRST_RULE]
    ends = np.cumsum(sizes)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    begin = int(ends[a] - sizes[a]) if a < len(body) else start
    return expand(body[a:b].copy(), rules)[start - begin : stop - begin]


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> None:
    """Encode every text and write the shards. Rows are dealt out by ranges of doc_id, so shards follow its order."""
    ordered = id_and_text(docs).repartitionByRange(F.col("doc_id"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches):
        encoder, end = byte_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        part, shard, first, ids, owns, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def row():
            flat = np.frombuffer(b"".join(owns), "<u4")
            body, rules, tokens = compress(flat)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_tokens": pa.array([len(flat)], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "doc_tokens": pa.array([[len(x) // 4 for x in owns]], pa.list_(pa.int64())),
                "body": [body.astype("<u4").tobytes()], "rules": [rules.astype("<u4").tobytes()],
                "rule_tokens": [tokens.astype("<u4").tobytes()]})

        for chunk, texts in chunks(batches, CHUNK_CHARS):
            for doc_id, own in zip(chunk, encoder.encode(texts)):
                if owns and held + len(own) // 4 + 1 > SHARD:
                    yield row()
                    shard, first, ids, owns, held = shard + 1, first + held, [], [], 0
                ids.append(doc_id)
                owns.append(own + end)
                held += len(own) // 4 + 1
        if owns:
            yield row()

    ordered.mapInArrow(run, SHARDS).write.parquet(path)


def part_starts(shards: DataFrame) -> dict[int, int]:
    """The number of ids before each part; as many rows as the table was written with partitions."""
    sizes = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    return dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0)))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, decoded from the shards."""
    shards = spark.read.parquet(path)
    starts = part_starts(shards)
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rules = np.frombuffer(r["rules"], "<u4").reshape(-1, 2)
                ids = expand(np.frombuffer(r["body"], "<u4").copy(), rules).astype("<u4")
                ends = np.cumsum(r["doc_tokens"])
                owns = [ids[e - n : e].tobytes() for e, n in zip(ends, r["doc_tokens"])]
                first = starts[r["part"]] + r["first"]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "start": pa.array(first + ends - np.array(r["doc_tokens"]), pa.int64()),
                    "n_tokens": pa.array(r["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in owns], pa.int64())} | (
                        {"ids": pa.array(owns, pa.binary())} if with_ids else {}))

    return shards.drop("n_tokens", "rule_tokens").mapInArrow(run, out)


def read_range(spark: SparkSession, path: str, part: int, shard: int, start: int, stop: int) -> list[int]:
    """Ids start to stop of a shard."""
    r = spark.read.parquet(path).filter((F.col("part") == part) & (F.col("shard") == shard)).select(
        "body", "rules", "rule_tokens").first()
    return expand_range(np.frombuffer(r.body, "<u4"), np.frombuffer(r.rules, "<u4").reshape(-1, 2),
                        np.frombuffer(r.rule_tokens, "<u4"), start, stop).tolist()


def store(docs: DataFrame, tokenizer: str, end_id: int = 0) -> str:
    """write_ids to a new path in the shared folder; gives the path."""
    path = new_path(docs.sparkSession, "llm-ids")
    write_ids(docs, tokenizer, path, end_id)
    return path
