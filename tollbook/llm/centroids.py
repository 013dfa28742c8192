"""Centroid clustering in whole numbers, with a vantage-point tree over the centroids.

A vector's components become floor(256 * x). The first centroids are the vectors whose ids hash lowest. Each round a
vantage-point tree is built over the centroids and broadcast (K centroids of DIMENSIONS numbers, whatever the table
holds). Every vector searches it best first: the subtree whose least possible distance is smallest comes next, and
the search ends when that least distance is beyond the best one found. The bound is inclusive, with a slack for the
rounding of roots, so that a centroid as near as the best one is still looked at, and the smaller number wins. All
distances that decide are whole numbers. A batch of vectors is searched together: a step takes, for each vector, its next
subtree, and handles the vectors of one subtree at once. Tasks send one sum for each centroid, not rows.

Defined results: vectors that are null, of another length, or hold a null, infinite or not-a-number component take no part;
nor do rows without a vec_id, nor vectors with a component of 2 ** 19 or more either way, whose distances no long would
hold. Repeated rows count as often as they stand there. Vectors of equal hash (one vec_id) start in the order of their
components. With fewer vectors than centroids, every vector starts one; centroids that are equal are legal, and the
smaller number gets the vectors. A centroid without vectors stays. An empty table gives no rows. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import kept_table, ship
from tollbook.llm.vectors import finite, id_and_vector, matrix

K = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
LARGEST = 1 << 19
#: Centroids in a leaf of the tree.
LEAF = 4
#: Vectors searched together.
BATCH = 4096


@dataclass
class Node:
    """A leaf of centroids, or a vantage point with what lies near and far of it, each with its range of distances."""

    members: list[int]
    vantage: int = -1
    children: tuple[int, ...] = ()
    ranges: tuple[tuple[float, float], ...] = ()


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = rows - point
    return np.einsum("ij,ij->i", gap, gap)


def build_tree(centroids: np.ndarray) -> list[Node]:
    """Nodes, the root first. The vantage point is the centroid farthest from the first one of its set."""
    nodes: list[Node] = []

    def add(members: list[int]) -> int:
        number = len(nodes)
        nodes.append(node := Node(members))
        if len(members) <= LEAF:
            return number
        node.vantage = members[int(np.argmax(squared(centroids[members], centroids[members[0]])))]
        rest = np.array([m for m in members if m != node.vantage])
        distance = np.sqrt(squared(centroids[rest], centroids[node.vantage]).astype(np.float64))
        parts = np.array_split(np.argsort(distance, kind="stable"), 2)
        node.members = []
        node.ranges = tuple((float(distance[p].min()), float(distance[p].max())) for p in parts)
        node.children = tuple(add(rest[p].tolist()) for p in parts)
        return number

    add(list(range(len(centroids))))
    return nodes


def assign(vectors: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and its squared distance."""
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    cluster = np.full(len(vectors), len(centroids))
    bounds = np.full((len(vectors), len(nodes)), np.inf)
    bounds[:, 0] = 0.0

    def measure(rows: np.ndarray, centroid: int) -> np.ndarray:
        found = squared(vectors[rows], centroids[centroid])
        better = (found < best[rows]) | ((found == best[rows]) & (centroid < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = found[better], centroid
        return found

    active = np.arange(len(vectors))
    while len(active):
        following = np.argmin(bounds[active], axis=1)
        least = bounds[active, following]
        going = least <= np.sqrt(best[active].astype(np.float64))
        active, following, least = active[going], following[going], least[going]
        for number in np.unique(following):
            node, mine = nodes[number], following == number
            rows = active[mine]
            bounds[rows, number] = np.inf
            for centroid in node.members:
                measure(rows, centroid)
            if node.vantage < 0:
                continue
            distance = np.sqrt(measure(rows, node.vantage).astype(np.float64))
            for child, (low, high) in zip(node.children, node.ranges):
                reach = np.maximum(distance - high, low - distance) - 1e-9 * (distance + high + 1)
                bounds[rows, child] = np.maximum(least[mine], reach)
    return cluster, best


def _whole(column: pa.Array) -> np.ndarray:
    return np.floor(SCALE * matrix(column)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def _usable(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding")
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) < LARGEST)
    return id_and_vector(rows).filter(
        F.col("vec_id").isNotNull() & (F.size(vector) == DIMENSIONS) & finite(vector) & small)


def first_centroids(usable: DataFrame, k: int) -> np.ndarray:
    """The k vectors of lowest hash; k rows come to the driver."""
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = usable.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return np.floor(SCALE * np.array([r["embedding"] for r in rows], dtype=np.float64).reshape(-1, DIMENSIONS)).astype(np.int64)


def moved(usable: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round; len(centroids) * DIMENSIONS sums come to the driver."""
    shared = usable.sparkSession.sparkContext.broadcast((centroids, build_tree(centroids)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, nodes = shared.value
        total, count = np.zeros_like(points), np.zeros(len(points), dtype=np.int64)
        for batch in _batches(batches):
            vectors = _whole(batch.column(0))
            cluster, _ = assign(vectors, points, nodes)
            np.add.at(total, cluster, vectors)
            count += np.bincount(cluster, minlength=len(points))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": np.repeat(some, DIMENSIONS), "place": np.tile(np.arange(DIMENSIONS), len(some)),
            "total": total[some].ravel(), "n": np.repeat(count[some], DIMENSIONS)})

    parts = usable.select("embedding").mapInArrow(sums, "cluster long, place long, total long, n long")
    summed = parts.groupBy("cluster", "place").agg(
        F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for row in summed:
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    shared.unpersist()
    return out


def clusters(rows: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance of every vector, the sums of distance over its cluster and over all (null if no long
    holds them), and the hash of its centroid."""
    spark = rows.sparkSession
    ship(spark)
    usable = _usable(rows)
    centroids = first_centroids(usable, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(usable, centroids)
    shared = spark.sparkContext.broadcast((centroids, build_tree(centroids)))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, nodes = shared.value
        for batch in _batches(batches):
            cluster, distance = assign(_whole(batch.column(1)), points, nodes)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0), "cluster": cluster.astype(np.int32), "distance": distance})

    found = kept_table(usable.mapInArrow(nearest, "vec_id long, cluster int, distance long"), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    own = {r["cluster"]: int(r["own"]) for r in sums}
    whole = sum(own.values())
    about = [(c, _long(own[c]), _long(whole), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c in own]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each centroid that has vectors, k at most.
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(number: int) -> int | None:
    return number if number < 1 << 63 else None
