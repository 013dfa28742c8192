"""The conversation trie, nearest neighbours and clusters against brute force, on odd rows as well."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tollbook.llm import centroids, neighbours, turntrie
from tollbook.llm.common import read, ship

TURNS = "conv_id long, turn long, role string, text string, path string, lens string, n long"
VECTORS = "vec_id long, embedding array<float>, label int, kind int, part string, rank int"


# --- op11 ---------------------------------------------------------------------------------------------------------


def rebuilt(rows) -> dict[int, tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    plain = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in plain}
    return {c: tuple(plain.get(c - int(math.fmod(c, 100)), [])[: heads[c]] + plain[c][heads[c] :]) for c in plain}


def trie_of(sequences: dict[int, tuple]) -> list[tuple]:
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        own = (len(convs) - 1) * len(node[-1][1]) if node else 0
        for depth in range(len(node) + 1):
            saved[node[:depth]] += own
            leaves[node[:depth]] += not kids[node]
    ends = lambda node: ",".join(map(str, sorted(c for c in members[node] if len(sequences[c]) == len(node))))
    return sorted((min(c), len(n), min(members[n[:-1]]) if n else None, len(c), kids[n], leaves[n], saved[n],
                   hashlib.sha256(ends(n).encode()).hexdigest()) for n, c in members.items())


def conversations() -> list[tuple]:
    rng = np.random.default_rng(4)
    rows = []
    for conv in [*range(0, 260), 700, 705, 1301, -5]:  # 705 has its hundred's first, 1301 has none
        for turn in range(int(rng.integers(1, 9))):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"t{int(rng.integers(0, 2))}é"))
    for conv in range(400, 480):  # copies
        rows += [(conv, k, "user", "same") for k in range(3)]
    rows += [(901, k, "user", "long" * 50) for k in range(300)]  # deep
    rows += [(902, 5, None, None), (902, None, "z", "first"), (902, 5, "b", "x" * 100_000), (902, 5, "b", None), (902, 5, None, None)]
    rows += [(903, 1, "u", "twice"), (903, 1, "u", "twice"), (None, 1, "u", "no id"), (None, None, None, None)]
    return rows


def with_more(rows):
    return [(*r, "p", "l", 7) for r in rows]


def test_trie_against_brute_force(spark):
    rows = conversations()
    got = turntrie.trie(spark.createDataFrame(with_more(rows), TURNS).repartition(5)).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1], str(r))) == sorted(
        trie_of(rebuilt(rows)), key=lambda r: (r[0], r[1], str(r)))


def test_trie_of_nothing(spark):
    assert turntrie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert turntrie.trie(spark.createDataFrame([(None, 1, "u", "x", "", "", 1)], TURNS)).count() == 0


def peel_in_blocks(sequences: dict[int, tuple], size: int) -> list[tuple]:
    """What the jobs do, with blocks of `size` rows, and chains that are peeled again until they fit into one."""
    mark = lambda turn: hashlib.sha256(repr(turn).encode()).digest()[: turntrie.MARK]
    rows = sorted((b"".join(map(mark, turns)), conv, [len(t[1]) for t in turns]) for conv, turns in sequences.items())
    table = pa.table({"path": pa.array([r[0] for r in rows], pa.binary()), "conv_id": pa.array([r[1] for r in rows], pa.int64()),
                      "lens": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})
    nodes, pieces, level, last = [], defaultdict(list), 0, False
    while table.num_rows:
        last = level > 0 and table.num_rows <= 2 * size
        make = turntrie.of_chains if level else turntrie.of_conversations
        step = table.num_rows if last else size
        out = [b for i in range(0, table.num_rows, step) for b in turntrie.peel(make(table.slice(i, step).combine_chunks()), last)]
        found = pa.Table.from_batches(out, turntrie.ALL)
        nodes += [r for r in found.select(list(turntrie.NODE)).to_pylist() if r["n_convs"] is not None]
        for r in found.select(list(turntrie.ENDS)).to_pylist():
            if r["ends_key"] is not None:
                pieces[r["ends_key"]].append((r["ends_first"], r["ends_text"]))
        chains = [r for r in found.select(list(turntrie.CHAIN)).to_pylist() if r["path"] is not None]
        assert last == (not chains)
        chains.sort(key=lambda r: (r["path"], r["tie"]))
        table = pa.Table.from_pylist(chains, pa.schema(turntrie.CHAIN.items()))
        level += 1
    keyed = {r["key"]: r for r in nodes if r["key"]}
    out = []
    for r in nodes:
        parent = r["parent_conv_id"] if r["parent_key"] is None else keyed[r["parent_key"]]["conv_id"]
        ends = r["ends_sha256"]
        if r["key"] in pieces:
            ends = hashlib.sha256(b",".join(text for _, text in sorted(pieces[r["key"]]))).hexdigest()
        out.append((r["conv_id"], r["depth"], parent, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], ends))
    return sorted(out, key=lambda r: (r[0], r[1], str(r)))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 10**6), st.lists(st.sampled_from("abc"), max_size=7), min_size=1, max_size=40),
       st.integers(1, 9))
def test_peeling_in_blocks_of_any_size(lists, size):
    sequences = {c: tuple(("u", "x" * (ord(t) - 96)) for t in turns) for c, turns in lists.items()}
    size = max(size, 3)  # two chains leave a block, so a level must be shorter than the one before
    assert peel_in_blocks(sequences, size) == sorted(trie_of(sequences), key=lambda r: (r[0], r[1], str(r)))


def test_peeling_a_group_of_copies_and_a_deep_conversation():
    sequences = {c: (("u", "same"),) * 4 for c in range(300)} | {c: (("u", "same"),) * (c % 7) for c in range(300, 400)}
    sequences[999] = (("u", "same"),) * 150
    for size in (16, 64):
        assert peel_in_blocks(sequences, size) == sorted(trie_of(sequences), key=lambda r: (r[0], r[1], str(r)))


# --- op12 ---------------------------------------------------------------------------------------------------------


def by_distance(rows, k=10):
    """Of every vec_id that 100 divides its nearest, by (distance, vec_id), from all usable vectors."""
    usable = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v
              and np.isfinite(np.array(v, float)).all() and any(v)]
    width = Counter(len(v) for _, v in usable).most_common(1)[0][0] if usable else 0
    usable = [(i, v) for i, v in usable if len(v) == width]
    out = defaultdict(dict)
    for q, vector in usable:
        if q % 100 == 0:
            for i, other in usable:
                if i != q:
                    apart = float(np.sqrt(((other - vector) ** 2).sum()))
                    out[q][i] = min(apart, out[q].get(i, math.inf))
    return {q: sorted((d, i) for i, d in near.items())[:k] for q, near in out.items() if near}


def odd_vectors() -> list[tuple]:
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(1, 90)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]  # copies
    rows += [(7, rows[6][1])] * 30 + [(3, rows[50][1])]  # repeated rows, and an id of two vectors
    rows += [(300, None), (301, [None] + [1.0] * 7), (302, [math.nan] * 8), (303, [math.inf] + [0.0] * 7), (304, [0.0] * 8),
             (305, []), (306, [1.0, 2.0]), (None, [1.0] * 8), (400, [1e18] * 8), (500, [1e-30] + [0.0] * 7)]
    return rows


def vector_frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, 1, 2, "p", 3) for i, v in rows], VECTORS).repartition(4)


def found_by(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return dict(out)


def test_neighbours_of_odd_vectors_are_exact(spark):
    """So few vectors are one leaf, so that all are looked at."""
    rows = odd_vectors()
    frame = vector_frame(spark, rows)
    got, wanted = found_by(neighbours.nearest(frame, frame.where("vec_id % 100 = 0"))), by_distance(rows)
    assert got.keys() == wanted.keys() and {200, 400, 500} <= got.keys()
    for q in wanted:
        assert [i for _, i in got[q]] == [i for _, i in wanted[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in wanted[q]], rtol=1e-12)


def test_neighbours_of_few_or_none(spark):
    few = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (100, [5.0, 5.0])]
    frame = vector_frame(spark, few)
    got = found_by(neighbours.nearest(frame, frame.where("vec_id % 100 = 0")))
    assert {q: [i for _, i in near] for q, near in got.items()} == {0: [1, 100], 100: [1, 0]}
    empty = vector_frame(spark, []).limit(0)
    assert neighbours.nearest(empty, empty).count() == 0
    assert neighbours.nearest(frame, frame.limit(0)).count() == 0
    alone = vector_frame(spark, [(0, [1.0])])
    assert neighbours.nearest(alone, alone).count() == 0


def test_recall_with_split_leaves(spark, monkeypatch):
    """Clusters of 6,000 vectors, a third of them in one narrow cluster; parts smaller than leaves, many queries."""
    monkeypatch.setattr(neighbours, "MOST", 150)
    monkeypatch.setattr(neighbours, "MIN_PART", 40)
    monkeypatch.setattr(neighbours, "SAMPLE", 2000)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    which = np.where(rng.random(6000) < 0.34, 0, rng.integers(0, 40, 6000))
    vectors = (centres[which] + rng.normal(size=(6000, 16)) * np.where(which == 0, 0.01, 0.3)[:, None]).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = vector_frame(spark, rows)
    got, wanted = found_by(neighbours.nearest(frame, frame.where("vec_id % 100 = 0"))), by_distance(rows)
    shared = [len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted]
    assert got.keys() == wanted.keys() and np.mean(shared) >= 9.3
    exact = {(q, i): d for q, near in wanted.items() for d, i in near}
    assert all(math.isclose(d, exact[q, i], rel_tol=1e-12) for q in got for d, i in got[q] if (q, i) in exact)


def test_recall_on_the_given_vectors(spark):
    frame = read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got, wanted = found_by(neighbours.nearest(frame, frame.where("vec_id % 100 = 0"))), by_distance(rows)
    assert got.keys() == wanted.keys()
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in wanted[q]}) for q in wanted]) >= 9.0


def test_the_queue_is_shared_by_all_trees():
    sample = np.random.default_rng(2).normal(size=(2000, 6))
    forest = neighbours.fit(sample, 10)
    assert 0 < forest.visits < len(forest.trees) * (len(forest.trees[0].offsets) + 1)
    (found,) = forest.search(sample[:1], 10**6)
    assert len(found) == len(set(found)) == len(forest.trees) * (len(forest.trees[0].offsets) + 1)
    assert {t for t, _ in found[:3]} == set(range(len(forest.trees)))  # the own leaf of each tree comes first
    assert {(t, int(tree.leaves(sample[:1])[0])) for t, tree in enumerate(forest.trees)} == set(found[:3])


# --- op13 ---------------------------------------------------------------------------------------------------------


def clusters_of(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(x)) for x in np.array(v, dtype=np.float32)]) for i, v in rows
            if i is not None and v is not None and len(v) == 64 and None not in v and np.isfinite(np.array(v, float)).all()
            and max(map(abs, v)) < centroids.LARGEST]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    points = [v for _, v in first]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (_, c) in zip(kept, assigned()):
            groups[c].append(v)
        for c, own in groups.items():
            points[c] = [sum(column) // len(own) for column in zip(*own)]
    found, inertia = assigned(), Counter()
    for d, c in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, found))


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=64).astype(np.float32) * (1 + i % 3)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # copies: equal centroids, empty ones
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[1][1]), (300, None), (301, [1.0] * 63), (302, [None] + [1.0] * 63),
             (303, [math.nan] * 64), (304, [math.inf] * 64), (305, []), (306, [0.0] * 64), (307, [-0.001] * 64), (308, [1e30] * 64),
             (309, [500_000.0] * 64)]
    got = centroids.clusters(vector_frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == clusters_of(rows)


def test_clusters_of_few_or_none(spark):
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert sorted(map(tuple, centroids.clusters(vector_frame(spark, few)).collect())) == clusters_of(few)
    assert centroids.clusters(vector_frame(spark, []).limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 45), st.integers(0, 10**6), st.sampled_from([2, 3, 50, 100_000]))
def test_the_tree_finds_the_nearest_with_ties(k, seed, spread):
    rng = np.random.default_rng(seed)
    points, vectors = rng.integers(-spread, spread, (k, 3)), rng.integers(-spread, spread, (60, 3))
    cluster, distance = centroids.assign(vectors, points, centroids.build_tree(points))
    every = ((vectors[:, None] - points[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_the_tree_leaves_out_what_is_far(monkeypatch):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(0, 100, (20, 4)), rng.integers(100_000, 100_100, (20, 4))])
    measured = []
    squared = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda rows, point: measured.append(len(rows)) or squared(rows, point))
    nodes = centroids.build_tree(points)
    measured.clear()
    centroids.assign(rng.integers(0, 100, (200, 4)), points, nodes)
    assert sum(measured) < 0.75 * 200 * len(points)
