"""Exact Jaccard self-join of word shingles by PartEnum signatures, and its connected components.

Sets are put into bands of sizes such that a set and a linked larger one are in the same band or the next. For a band, the
domain of shingles is cut into more parts than two linked sets of that band can differ in, so some parts of the two
are equal; the signature of a part is a hash of all that the set holds there. The enumerated subsets are the single parts
(the paper's second level with no further cut), which needs the fewest signatures.

A part with fewer than HEAVY shingles says little, so a set leaves such parts out, unless it has so many of them that
all its equal parts might be among them; how many may differ follows from the set's own size, as linked sets are no larger than it
allows. Then it gives all parts that hold something, and empty ones only if all others might differ. Whether a part is light depends on what it holds alone, so equal parts are left out
on both sides or on none, and no link is lost. There are some parts more than needed (SLACK), so a set may leave out as many
signatures: those of its largest buckets, if these have more than BUCKET sets. All sets order buckets alike, so the last one
that two linked sets share comes after as many others as either may leave out, and both are still in it.

Sets that are equal are one node from the start (a 63-bit hash of the set). All pairs of a bucket of at most BUCKET sets are
candidates. In a large bucket, sets are first compared with the one that is in the most buckets, so a large group of near
copies costs a star and not all its pairs. A large bucket whose sets are then not all in one component is cut into blocks,
and each two blocks meet in a task, which holds sets of different components against each other by the parities of their
shingles (a bitmap; linked sets differ in no more bits than shingles) and gives only the pairs that may link: first those
that join the block's components, and, once these are decided, all that are left. So a group that lies just under the
similarity costs bitmaps in memory and no rows, and no pair that could join two components stays unseen. Candidates are held
against the whole sets in the end.

A text with fewer words than a shingle has its whole sequence as its one shingle. A text without words, or null, has no
shingle and is linked with nothing. Repeated rows are equal sets. Rows of one doc_id are one document if their texts are
equal, else each is judged by itself. A document with a null id takes part; it never gives a component its name unless
no other document can. Texts of any length are read whole; a similarity of just `percent` is a link. An empty table gives no
rows; other columns are not read, whatever their names. Components that do not settle in sixty turns of stars are an error (each
turn at least halves the longest path).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import id_and_text, kept_table, map_chunks
from tollbook.llm.components import components

HEAVY = 2
BUCKET = 8
#: One part in so many is there only to be left out.
SLACK = 4
#: Sets of a large bucket that are compared in one task, against as many others.
BLOCK = 1024
#: Bits of a set's bitmap: at least so many for each shingle in which linked sets may differ, but no more than MOST_BITS.
BITS, MOST_BITS = 32, 1 << 16
#: Words whose hash a worker remembers.
WORDS = 500_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    width = min(width, n)
    rolled = h[: n - width + 1].copy()
    for i in range(1, width):
        rolled = rolled * _A + h[i : n - width + 1 + i]
    return np.unique(mix(rolled + np.uint64(width)))


def node_of(found: np.ndarray) -> int:
    """One even number for a set; odd ones stand for the set as the smaller one of the next band."""
    return (xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)) & ~1


def bands(percent: int, largest: int) -> np.ndarray:
    """The largest size of each band, up to a size."""
    ends, end = [], 0
    while end < largest:
        end = max(end + 1, (end + 1) * 100 // percent)
        ends.append(end)
    return np.array(ends)


def most_differing(size: int, largest: int, percent: int) -> int:
    """In how many shingles a set may differ from one that it is linked with and that is no larger than `largest`."""
    return (size + min(size * 100 // percent, largest)) * (100 - percent) // (100 + percent)


def layouts(found: np.ndarray, percent: int, ends: np.ndarray):
    """As a member of its band and as the smaller set of the next one: the band, how many shingles the set and a linked one may
    differ in there (-1 if no linked set is that large), and how many of the set's each part holds."""
    own, size = int(np.searchsorted(ends, len(found))), len(found)
    high = found >> np.uint64(32)
    for band in (own, own + 1):
        if band > own and size * 100 // percent <= ends[own]:
            yield band, -1, np.zeros(0, np.int64)
            continue
        most = 2 * int(ends[band]) * (100 - percent) // (100 + percent)  # of any two sets of the band
        parts = most + 1 + -(-most // SLACK)
        part = (high * np.uint64(parts)) >> np.uint64(32)  # ascending, as the hashes are
        yield (band, most_differing(size, int(ends[band]), percent), np.bincount(part.astype(np.int64), minlength=parts))


def given_of(differ: int, held: np.ndarray) -> tuple[np.ndarray, int]:
    """Which parts a set gives, and how many of them it may leave out: the heavy ones if some of those must be equal, else all that
    hold anything and, if even these may all differ, empty ones too. A linked set gives the equal ones among them in any case;
    but it may give no light ones, so light ones do not count for what may be left out (-1)."""
    spare = int((held >= HEAVY).sum()) - differ - 1
    if spare >= 0:
        return held >= HEAVY, spare
    some = held > 0
    return some if int(some.sum()) > differ else np.ones(len(held), bool), -1


def parts_of(found: np.ndarray, percent: int, ends: np.ndarray):
    """For both bands: signatures of a set's parts, which of them it gives, and how many more it may leave out."""
    mixed = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(found + _A), dtype=np.uint64)]
    for band, differ, held in layouts(found, percent, ends):
        stop = np.cumsum(held)
        place = mix(np.arange(len(held), dtype=np.uint64) + np.uint64((band * int(_A) + int(_C)) % (1 << 64)))
        sigs = mix((mixed[stop] - mixed[stop - held]) ^ place)
        yield sigs, *given_of(differ, held)


def parities(found: np.ndarray, percent: int) -> bytes:
    """A bit for each place, the parity of the shingles there; half as many places are the two halves, XORed."""
    differ = 2 * len(found) * (100 - percent) // (100 + percent)
    places = min(max(64, 1 << (BITS * differ).bit_length()), MOST_BITS)
    held = np.bincount((found & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((held & 1).astype(bool)).tobytes()


def folded(bitmaps: list) -> np.ndarray:
    """Bitmaps of one size, that of the smallest, as rows of 64-bit words."""
    words = min(len(x) for x in bitmaps) // 8
    out = np.empty((len(bitmaps), words), np.uint64)
    for i, x in enumerate(bitmaps):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0)
    return out


def may_link(x: np.ndarray, n: int, y: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which sets, of so many shingles and with bitmaps y, may be linked with the set of bitmap x and n shingles."""
    near = (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes))
    at = np.flatnonzero(near)
    differ = np.bitwise_count(y[at] ^ x).sum(axis=1, dtype=np.int64)
    near[at] = differ * (100 + percent) <= (n + sizes[at]) * (100 - percent)
    return near


class Bands:
    """Band ends for sets of any size."""

    def __init__(self, percent: int):
        self.percent, self.ends = percent, bands(percent, 1 << 16)

    def of(self, size: int) -> np.ndarray:
        if 2 * size > self.ends[-1]:
            self.ends = bands(self.percent, 4 * size)
        return self.ends


NODES = "doc_id long, n_shingles long, node long, spare_own int, spare_next int, bits binary"


def node_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and node (null for an empty set) of every row, with the signatures it may leave out in both bands and its bitmap."""

    def make():
        known = Bands(percent)

        def fn(ids, texts):
            rows = []
            for text in texts:
                found = shingles(text, width)
                if not len(found):
                    rows.append((0, None, None, None, None))
                    continue
                spares = [given_of(differ, held)[1] for _, differ, held in layouts(found, percent, known.of(len(found)))]
                rows.append((len(found), node_of(found), *spares, parities(found, percent)))
            n, node, own, next_, bits = zip(*rows)
            return {"doc_id": pa.array(ids, pa.int64()), "n_shingles": pa.array(n, pa.int64()),
                    "node": pa.array(node, pa.int64()), "spare_own": pa.array(own, pa.int32()),
                    "spare_next": pa.array(next_, pa.int32()), "bits": pa.array(bits, pa.binary())}

        return fn

    return map_chunks(docs, make, NODES)


def signature_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """sig and member (the node, odd for its second band): of each set once per task."""

    def make():
        met: set[int] = set()
        known = Bands(percent)

        def fn(ids, texts):
            sigs, members, n = [], [], []
            for text in texts:
                found = shingles(text, width)
                if not len(found) or (node := node_of(found)) in met:
                    continue
                met.add(node)
                for i, (all_, given, _) in enumerate(parts_of(found, percent, known.of(len(found)))):
                    sigs.append(all_[given])
                    members.append(node | i)
                    n.append(len(sigs[-1]))
            if not sigs:
                return None
            return {"sig": pa.array(np.concatenate(sigs).view(np.int64)),
                    "member": pa.array(np.repeat(np.array(members, np.int64), np.array(n)))}

        return fn

    return map_chunks(docs, make, "sig long, member long")


def buckets(sigs: DataFrame) -> DataFrame:
    """Pairs a < b of members (sig is null) from buckets of two to BUCKET, and the rows (sig, a) of larger ones."""

    def run(batches):
        left, flushed = (np.zeros(0, np.int64),) * 2, None

        def large_rows(sig, member):
            return pa.RecordBatch.from_pydict(
                {"sig": pa.array(sig), "a": pa.array(member), "b": pa.nulls(len(sig), pa.int64())})

        def grouped(sig, member):
            fresh = np.r_[True, (sig[1:] != sig[:-1]) | (member[1:] != member[:-1])]
            sig, member = sig[fresh], member[fresh]
            start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            size = np.diff(np.r_[start, len(sig)])
            if sig[0] == flushed:
                size[0] += BUCKET
            pairs = []
            for n in range(2, BUCKET + 1):
                of = member[start[size == n][:, None] + np.arange(n)]
                pairs += [of[:, [i, j]] for i in range(n) for j in range(i + 1, n)]
            pairs = np.unique(np.concatenate(pairs) & ~1, axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_pydict({
                    "sig": pa.nulls(len(pairs), pa.int64()), "a": pa.array(np.ascontiguousarray(pairs[:, 0])),
                    "b": pa.array(np.ascontiguousarray(pairs[:, 1]))})
            large = np.repeat(size > BUCKET, np.diff(np.r_[start, len(sig)]))
            if large.any():
                yield large_rows(sig[large], member[large])

        for batch in batches:
            sig = np.concatenate([left[0], batch.column(0).to_numpy()])
            member = np.concatenate([left[1], batch.column(1).to_numpy()])
            cut = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0  # the last group may go on
            if cut:
                yield from grouped(sig[:cut], member[:cut])
            left = (sig[cut:], member[cut:])
            distinct = np.unique(left[1])
            if len(distinct) > BUCKET + 1:  # large already: a few sets stay, so that what follows is known to be large too
                yield large_rows(np.full(len(distinct) - 1, sig[-1]), distinct[:-1])
                left, flushed = (left[0][-1:], left[1][-1:]), sig[-1]
        if len(left[0]):
            yield from grouped(*left)

    return (sigs.repartition("sig").sortWithinPartitions("sig", "member")
            .mapInArrow(run, "sig long, a long, b long"))


def large_buckets(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """sig, node, leader and size: the rows of large buckets that still have to be compared there."""
    rows = shared.filter("sig is not null").select("sig", F.col("a").alias("member"))
    rows = rows.join(rows.groupBy("sig").agg(F.count("*").alias("size")), "sig")
    of = Window.partitionBy("member")  # at most the parts of a set
    even = F.col("member").bitwiseAND(F.lit(-2))
    rows = rows.select(
        "sig", "member", even.alias("node"), F.count("*").over(of).alias("n"),
        F.row_number().over(of.orderBy(F.desc("size"), "sig")).alias("rank"))
    spare = F.when(F.col("member") == F.col("node"), F.col("spare_own")).otherwise(F.col("spare_next"))
    rows = rows.join(parts.select("node", "spare_own", "spare_next"), "node").filter(F.col("rank") > spare)
    # The set of the most buckets leads: one in the middle of a group, and the same one in all its buckets.
    first = rows.groupBy("sig").agg(
        F.count("*").alias("size"), F.max(F.struct("n", "node")).getField("node").alias("leader")).filter("size > 1")
    return rows.join(first, "sig").select("sig", "node", "leader", "size")


def possible(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps do not rule out a link."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            keep = np.zeros(len(n), bool)
            for i, both in enumerate(zip(batch.column("bits_a"), batch.column("bits_b"))):
                x = folded([v.as_buffer() for v in both])
                keep[i] = may_link(x[0], int(n[i]), x[1:], m[i : i + 1], percent)[0]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    of = lambda c: parts.select(
        F.col("node").alias(c), F.col("n_shingles").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select(
        "a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def block_pairs(members: DataFrame, parts: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs a < b of sets that share a bucket, are of different roots and may link, from blocks of the buckets.

    All of them if every; else of each two blocks the pairs that would join all roots there that could be joined."""

    def compare(rows: pa.Table):
        i, j, block, node, root, size = (rows.column(c).to_numpy() for c in ("i", "j", "block", "node", "root", "size"))
        bits = folded([x.as_buffer() for x in rows.column("bits").combine_chunks()])
        root = np.unique(root, return_inverse=True)[1]
        same = i[0] == j[0]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        for k, x in enumerate(left):
            others = right[k + 1 :] if same else right
            others = others[root[others] != root[x]]
            if not len(others):
                continue
            hits = others[may_link(bits[x], int(size[x]), bits[others], size[others], percent)]
            if not every and len(hits):
                joined, at = np.unique(root[hits], return_index=True)
                hits = hits[at]
                root[np.isin(root, joined)] = root[x]
            found.append(np.stack([np.full(len(hits), node[x]), node[hits]], axis=1))
        return np.sort(np.concatenate(found), axis=1) if found else np.zeros((0, 2), np.int64)

    def run(batches):
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            keys = np.stack([rows.column(c).to_numpy() for c in ("sig", "i", "j")], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)]
            for x, y in zip(starts, starts[1:]):
                yield from out(compare(rows.slice(x, y - x)))
            left = rows.slice(starts[-1])  # the last group may go on
        if left is not None:
            yield from out(compare(left))

    def out(pairs):
        if len(pairs):
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.ascontiguousarray(pairs[:, 0])),
                                              "b": pa.array(np.ascontiguousarray(pairs[:, 1]))})

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.select("sig", "node", "root", blocks.alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "node", "root")
    held = parts.select("node", F.col("n_shingles").alias("size"), "bits")
    return (dealt.join(held, "node").select("sig", "i", "j", "block", "node", "root", "size", "bits")
            .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())


def set_rows(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and its shingles as binary, of the wanted nodes."""
    first = nodes.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    first = first.join(wanted, "node", "left_semi").filter("doc_id is not null")
    texts = id_and_text(docs)
    chosen = texts.join(first.select("doc_id").distinct(), "doc_id", "left_semi").unionByName(
        texts.filter("doc_id is null"))

    def make():
        def fn(ids, found):
            sets = [s for t in found if len(s := shingles(t, width))]
            return {"node": pa.array([node_of(s) for s in sets], pa.int64()),
                    "held": pa.array([s.tobytes() for s in sets], pa.binary())}

        return fn

    return map_chunks(chosen, make, "node long, held binary").join(wanted, "node", "left_semi").dropDuplicates(["node"])


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by their whole sets."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("held_a"), batch.column("held_b")
            keep = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: sets.select(F.col("node").alias(c), F.col("held").alias(f"held_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "held_a", "held_b").mapInArrow(
        run, "a long, b long")


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row of docs."""
    nodes = kept_table(node_rows(docs, width, percent), "nodes")
    parts = nodes.filter("node is not null").drop("doc_id").dropDuplicates(["node"])
    shared = kept_table(buckets(signature_rows(docs, width, percent)), "buckets")
    large = kept_table(large_buckets(shared, parts), "large")

    def check(near: DataFrame) -> DataFrame:
        near = kept_table(near, "pairs")
        wanted = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
        return kept_table(linked(near, set_rows(docs, nodes, wanted, width), percent), "links")

    star = large.filter("node <> leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    tested = shared.filter("sig is null").select("a", "b").unionByName(star).distinct()
    links = check(possible(tested, parts, percent))
    roots = kept_table(components(links), "roots")
    for every in (False, True):
        members = large.select("sig", "node", "size").join(roots, "node", "left").withColumn(
            "root", F.coalesce("root", "node"))
        open_ = members.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        members = kept_table(members.join(open_.select("sig"), "sig", "left_semi"), "members")
        if members.isEmpty():
            break
        found = check(block_pairs(members, parts, percent, every))
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = kept_table(components(links), "roots")
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
