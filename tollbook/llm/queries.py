"""The registered queries of this package, each over its whole table, and SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm import (
    centroids, decontaminate, langid, neighbours, packing, partenum, pii, ranking, repair, rules, substrings, token_counts,
    turntrie)
from tollbook.llm.common import held_out, read

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    return langid.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = repair.store(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return repair.read_ids(spark, path)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.classes(read(spark, sf_dir, "documents"), width=4, percent=85)


def repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.clean(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = ranking.learn(docs, labels, ~held_out(F.col("doc_id")))
    return ranking.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= ranking.TAKEN).cast("int").alias("predicted"))


def pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)).drop("ids")


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(read(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", *(of(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.listed(F.array_sort("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.trie(read(spark, sf_dir, "conversations"))


def vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": language, "op2_token_ids": token_ids, "op3_quality_rules": quality_rules,
    "op4_token_counts": count_tokens, "op5_jaccard_join": jaccard_join, "op6_repeated_substrings": repeated_substrings,
    "op7_quality_ranking": quality_ranking, "op8_packing": pack_windows, "op9_personal_data": personal_data,
    "op10_benchmark_leaks": benchmark_leaks, "op11_conversation_trie": conversation_trie,
    "op12_vector_neighbours": vector_neighbours, "op13_vector_clusters": vector_clusters, "pipeline": pipeline,
}

def cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds of the clustering, each as a join of all components and a minimum."""
    steps = ["""
        WITH kept AS (
          SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
          WHERE vec_id IS NOT NULL AND len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        q AS (
          SELECT r, vec_id, pos, floor(256 * embedding[pos]::DOUBLE)::HUGEINT AS x
          FROM (SELECT *, unnest(range(1, 65)) AS pos FROM kept)),
        start AS (
          SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR)) - 1 AS cluster FROM kept),
        c0 AS (SELECT cluster, pos, x AS c FROM q JOIN start USING (r) WHERE cluster < %d)""" % k]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
          SELECT r, any_value(vec_id) AS vec_id, cluster, sum((x - c) * (x - c)) AS distance
          FROM q JOIN c{i} USING (pos) GROUP BY r, cluster
          QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (
          SELECT cluster, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM q JOIN a{i} USING (r) GROUP BY cluster, pos),
        c{i + 1} AS MATERIALIZED (
          SELECT cluster, pos, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
          FROM c{i} LEFT JOIN m{i} USING (cluster, pos))""")
    return ",".join(steps) + f"""
        SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
          (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
          centroid_sha256
        FROM a{rounds} JOIN (
          SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256
          FROM c{rounds} GROUP BY cluster) USING (cluster)"""


ORACLES: dict[str, str] = {
    "op5_jaccard_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
          SELECT a.doc_id AS x, b.doc_id AS y
          FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
          JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
        reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM words
          UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
        SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
        FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op11_conversation_trie": r"""
        WITH RECURSIVE ranked AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
          FROM conversations WHERE conv_id IS NOT NULL),
        lists AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY place) AS turns FROM ranked GROUP BY conv_id),
        -- crc32 of the decimal id, bit by bit
        codes AS (
          SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
              string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
              lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) % 6 AS h
          FROM lists),
        whole AS (
          SELECT l.conv_id, list_concat(coalesce(b.turns, [])[1:h], l.turns[h + 1:]) AS turns
          FROM lists l JOIN codes USING (conv_id) LEFT JOIN lists b ON b.conv_id = l.conv_id - l.conv_id % 100),
        members AS (
          SELECT conv_id, len(turns) AS size, d AS depth, turns[1:d] AS path
          FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)),
        nodes AS (
          SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            coalesce(string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
          FROM members GROUP BY path, depth),
        kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        counted AS (
          SELECT nodes.*, coalesce(n, 0) AS n_children,
            CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].t) END AS saved
          FROM nodes LEFT JOIN kids USING (path, depth)),
        subtrees AS (
          SELECT path[1:up] AS path, up AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
          FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY ALL)
        SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children,
          s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
        FROM counted c JOIN subtrees s USING (path, depth)
        LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]""",
    "op13_vector_clusters": cluster_sql(),
}
