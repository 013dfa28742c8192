"""Approximate nearest neighbours: a forest of random-projection trees behind one shared priority queue.

Fit: a sample of at most SAMPLE vectors, those of lowest hash, comes to the driver. Each of TREES trees cuts it by the
plane between two random vectors, at the median, until leaves hold about LEAF of them. How many leaves a search visits is
measured, not set: CALIBRATION vectors of the sample are held against all of it, and VISITS is the number of leaves within
which TARGET of their true neighbours stand. Vectors that cluster need few, vectors without structure many.

Index: every vector of the table goes to its leaf in every tree. Leaves are dealt in parts of some MOST rows; a leaf beyond that
is split over several parts by a hash of the id, so no part grows with a leaf. Of equal vectors only the k + 1 smallest
ids are indexed: no result can hold another one of them. Which vectors stand in many rows is counted by their hash first, so
only those rows are ordered by vector, and each task keeps k + 1 of them before the shuffle.

Search: all trees share one queue; the subtree whose cutting planes are nearest comes next, whichever tree it is in, until VISITS
leaves are out. A query goes once to each part that has one of its leaves. There the distances to the vectors of its leaves
are estimated by a matrix product, and whatever may be among the nearest k by the bound of its rounding is measured again
as the root of the sum of squared differences in double precision. The nearest k of each part meet by query.

Defined results: rows without a vec_id, and vectors that are null, zero or hold a null, infinite or not-a-number component take no
part, neither as query nor as candidate; nor do vectors of another length than the most frequent one (of ties the
longest). A vec_id with several rows has the nearest of its vectors, and is never a neighbour of itself. Equal distances are
ordered by vec_id. With fewer than k candidates all that were found are returned; with fewer vectors than a leaf holds that is all
of them. Empty tables, or no queries, give no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollbook.llm.common import ship
from tollbook.llm.vectors import finite, id_and_vector, matrix

TREES = 3
SAMPLE = 131_072
LEAF = 128
CALIBRATION = 200
TARGET = 0.96
#: Rows of a part at most, and parts at least, as far as there are MIN_PART rows for each.
MOST, PARTS, MIN_PART = 131_072, 48, 1024
#: Queries measured together, and searched together.
TOGETHER, BLOCK = 32, 256

#: Vectors travel with the type of component that the table has.
ROUTED = "part string, kind int, leaf int, id long, vector {}, leaves array<int>"


@dataclass
class Tree:
    """A full binary tree: the children of node i are 2 i + 1 (below the plane) and 2 i + 2."""

    normals: np.ndarray
    offsets: np.ndarray

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, from 0."""
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(int(math.log2(len(self.offsets) + 1))):
            above = np.einsum("ij,ij->i", self.normals[node], vectors) > self.offsets[node]
            node = 2 * node + 1 + above
        return node - len(self.offsets)


@dataclass
class Forest:
    trees: list[Tree]
    visits: int
    #: Leaves of a part, and the parts of a leaf: one of them is 1.
    leaves_a_part: int = 1
    parts_a_leaf: int = 1

    def parts(self, tree: int, leaf: int) -> list[str]:
        if self.parts_a_leaf == 1:
            return [f"{tree}:{leaf // self.leaves_a_part}"]
        return [f"{tree}:{leaf}:{i}" for i in range(self.parts_a_leaf)]

    def part_of(self, tree: int, leaf: int, key: int) -> str:
        parts = self.parts(tree, leaf)
        return parts[key * 0x9E3779B97F4A7C15 % (1 << 64) * len(parts) >> 64]

    def search(self, queries: np.ndarray, visits: int) -> Iterator[list[tuple[int, int]]]:
        """For each query the (tree, leaf) that one queue over all trees gives first."""
        inner = len(self.trees[0].offsets)
        sides = np.stack([queries @ t.normals.T - t.offsets for t in self.trees], axis=1)
        for side in sides:
            queue = [(0.0, tree, 0) for tree in range(len(self.trees))]
            found: list[tuple[int, int]] = []
            while queue and len(found) < visits:
                away, tree, node = heapq.heappop(queue)
                if node >= inner:
                    found.append((tree, node - inner))
                    continue
                above = side[tree, node] > 0
                heapq.heappush(queue, (away, tree, 2 * node + 1 + above))
                heapq.heappush(queue, (max(away, abs(side[tree, node])), tree, 2 * node + 2 - above))
            yield found


def grow(sample: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
    size, width = (1 << depth) - 1, sample.shape[1]
    normals, offsets = np.zeros((size, width)), np.zeros(size)
    members = {0: np.arange(len(sample))}
    for node in range(size):
        mine = members.pop(node)
        normal = np.subtract(*sample[rng.choice(mine, 2, replace=False)]) if len(mine) > 1 else np.zeros(width)
        if not normal.any():
            normal = rng.normal(size=width)
        normals[node] = normal / np.linalg.norm(normal)
        along = sample[mine] @ normals[node]
        offsets[node] = np.median(along) if len(mine) else 0.0
        above = along > offsets[node]
        members[2 * node + 1], members[2 * node + 2] = mine[~above], mine[above]
    return Tree(normals, offsets)


def fit(sample: np.ndarray, k: int, seed: int = 0) -> Forest:
    """Trees over the sample, and the visits that find TARGET of the k neighbours of vectors in it."""
    rng = np.random.default_rng(seed)
    depth = max(0, math.ceil(math.log2(max(len(sample), 1) / LEAF)))
    forest = Forest([grow(sample, depth, rng) for _ in range(TREES)], TREES << depth)
    if not depth:
        return forest
    homes = np.stack([t.leaves(sample) for t in forest.trees], axis=1)
    asked = sample[:CALIBRATION]
    first_seen = []
    for i, visited in enumerate(forest.search(asked, forest.visits)):
        apart = np.einsum("ij,ij->i", sample - asked[i], sample - asked[i])
        apart[i] = np.inf
        order = {place: turn for turn, place in enumerate(visited, 1)}
        for near in np.argsort(apart, kind="stable")[:k]:
            first_seen.append(min(order[tree, int(leaf)] for tree, leaf in enumerate(homes[near])))
    forest.visits = int(np.quantile(first_seen, TARGET, method="higher"))
    return forest


def _usable(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding")
    return id_and_vector(rows).filter(
        F.col("vec_id").isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0))


def _without_spare_copies(rows: DataFrame, most: int) -> DataFrame:
    """The rows but for equal vectors beyond their `most` smallest ids, and repeated rows of such vectors."""
    keyed = rows.withColumn("_hash", F.xxhash64("embedding"))
    heavy = keyed.groupBy("_hash").agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select("_hash")
    # A row that repeats many times must not take the place of other ids.
    copies = keyed.join(heavy, "_hash", "left_semi").select("vec_id", "embedding").distinct()
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = copies.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")
    return keyed.join(heavy, "_hash", "left_anti").select("vec_id", "embedding").unionByName(few)


def _sample(rows: DataFrame, count: int) -> np.ndarray:
    """About SAMPLE vectors of lowest hash, in that order, and SAMPLE of them at most."""
    key = F.xxhash64("vec_id", "embedding")
    share = min(1.0, 1.1 * SAMPLE / max(count, 1))
    bound = int(-(1 << 63) + share * ((1 << 64) - 1)) if share < 1 else (1 << 63) - 1
    table = rows.withColumn("_key", key).filter(F.col("_key") <= bound).select(
        "_key", "vec_id", F.col("embedding").cast("array<double>").alias("embedding")).toArrow()
    table = table.sort_by([("_key", "ascending"), ("vec_id", "ascending")]).slice(0, SAMPLE)
    return matrix(table["embedding"].combine_chunks())


def _routes(forest: Forest, rows: DataFrame) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0), matrix(batch.column(1))
            for number, tree in enumerate(planes.trees):
                leaves = tree.leaves(vectors)
                yield pa.RecordBatch.from_pydict({
                    "part": [planes.part_of(number, leaf, key) for leaf, key in zip(leaves.tolist(), ids.to_pylist())],
                    "kind": np.zeros(len(ids), dtype=np.int32), "leaf": leaves.astype(np.int32), "id": ids,
                    "vector": batch.column(1), "leaves": pa.nulls(len(ids), pa.list_(pa.int32()))})

    return rows.mapInArrow(run, ROUTED.format(dict(rows.dtypes)["embedding"]))


def _requests(forest: Forest, queries: DataFrame) -> DataFrame:
    """Each query, once for every part that has a leaf of its search."""
    shared = queries.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = shared.value
        for block in (b.slice(i, BLOCK) for b in batches for i in range(0, b.num_rows, BLOCK)):
            rows, parts, leaves = [], [], []
            for row, found in enumerate(planes.search(matrix(block.column(1)), planes.visits)):
                wanted = defaultdict(list)
                for tree, leaf in found:
                    for part in planes.parts(tree, leaf):
                        wanted[part].append(leaf)
                rows += [row] * len(wanted)
                parts += wanted
                leaves += wanted.values()
            taken = block.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_pydict({
                "part": parts, "kind": np.ones(len(rows), dtype=np.int32), "leaf": np.full(len(rows), -1, dtype=np.int32),
                "id": taken.column(0), "vector": taken.column(1), "leaves": pa.array(leaves, pa.list_(pa.int32()))})

    return queries.mapInArrow(run, ROUTED.format(dict(queries.dtypes)["embedding"]))


@dataclass
class Part:
    """The vectors of a part, in the order of their leaves."""

    leaves: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray

    def __post_init__(self) -> None:
        self.norms = np.einsum("ij,ij->i", self.vectors, self.vectors)

    def nearest(self, ids: np.ndarray, queries: np.ndarray, wanted: list[list[int]], k: int) -> Iterator[tuple]:
        """query, candidate, distance of the nearest k of each query among the leaves it wants."""
        norms = np.einsum("ij,ij->i", queries, queries)
        guess = np.full((len(queries), len(self.ids)), np.inf)
        askers = defaultdict(list)
        for row, leaves in enumerate(wanted):
            for leaf in leaves:
                askers[leaf].append(row)
        for leaf, rows in askers.items():
            own = slice(*np.searchsorted(self.leaves, [leaf, leaf + 1]))
            estimate = norms[rows, None] + self.norms[None, own] - 2 * (queries[rows] @ self.vectors[own].T)
            guess[rows, own] = np.nan_to_num(estimate, nan=0.0, posinf=1e308, neginf=0.0)
        slack = 1e-11 * (norms + (self.norms.max() if len(self.norms) else 0))
        for row, query in enumerate(queries):
            own = np.flatnonzero(self.ids == ids[row])
            guess[row, own] = np.inf
            there = np.flatnonzero(np.isfinite(guess[row]))
            if len(there) > k and len(set(self.ids[there].tolist())) == len(there):
                cut = np.partition(guess[row, there], k - 1)[k - 1]
                there = there[guess[row, there] <= cut + slack[row]]
            gap = self.vectors[there] - query
            distance = np.sqrt((gap * gap).sum(axis=1))
            best: dict[int, float] = {}
            for i in np.lexsort((self.ids[there], distance)).tolist():
                best.setdefault(int(self.ids[there[i]]), float(distance[i]))
                if len(best) == k:
                    break
            for candidate, apart in best.items():
                yield int(ids[row]), candidate, apart


def _measured(routed: DataFrame, k: int) -> DataFrame:
    def answers(part: Part, asked: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(asked).combine_chunks()
        rows = list(part.nearest(
            np.asarray(table["id"]), matrix(table["vector"].combine_chunks()), table["leaves"].to_pylist(), k))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by part, the vectors of a part before its queries."""
        name, held, part = None, [], None
        for batch in batches:
            names, kinds = batch.column(0), np.asarray(batch.column(1))
            codes = np.asarray(names.dictionary_encode().indices)
            cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (kinds[1:] != kinds[:-1])) + 1), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if (new := names[start].as_py()) != name:
                    name, held, part = new, [], None
                rows = batch.slice(start, end - start)
                if kinds[start] == 0:
                    held.append(rows)
                    continue
                if held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    part, held = Part(np.asarray(table["leaf"]), np.asarray(table["id"]), matrix(table["vector"].combine_chunks())), []
                if part:
                    for i in range(0, rows.num_rows, TOGETHER):
                        yield answers(part, [rows.slice(i, TOGETHER)])

    return routed.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest k found of each query (vec_id, embedding), but for itself."""
    spark = vectors.sparkSession
    ship(spark)
    usable = _usable(vectors)
    sizes = usable.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n")).orderBy(
        F.col("n").desc(), F.col("width").desc()).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, count = sizes[0]
    of_width = lambda rows: rows.filter(F.size("embedding") == width)
    indexed = _without_spare_copies(of_width(usable), k + 1)
    forest = fit(_sample(indexed, count), k)
    a_leaf = count / (len(forest.trees[0].normals) + 1)
    most = min(MOST, max(MIN_PART, TREES * count // PARTS))
    forest.leaves_a_part, forest.parts_a_leaf = max(1, int(most / a_leaf)), max(1, math.ceil(a_leaf / most))
    asked = of_width(_usable(queries)).withColumn("embedding", F.col("embedding").cast(indexed.schema["embedding"].dataType))
    routed = _routes(forest, indexed).unionByName(_requests(forest, asked))
    found = _measured(routed.repartition("part").sortWithinPartitions("part", "kind", "leaf"), k)
    merged = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
