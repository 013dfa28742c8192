"""Quality rules as weak supervision.

Each rule votes good, bad or abstains. The counts of vote patterns over all documents (at most
3 ** len(RULES) rows) are all that expectation-maximisation needs to estimate how each rule votes on good
and on bad documents; the posterior probability of "good" replaces passing every rule.

Null or empty texts have no words, every rule abstains or votes bad on them, and they fail the base check.
Texts of any length are counted whole. A posterior of exactly a half is good. Nothing depends on the order of rows; repeated rows count
as often as they stand, rows with a null doc_id too. An empty table gives an empty table; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import kept_table, map_chunks
from tollbook.llm.textstats import FIELDS, SCHEMA, stats


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(value: Column, bad: float, good: float) -> Column:
    """Bad above one bound, good below the other, else no vote."""
    return F.when(value > bad, "-").when(value < good, "+").otherwise("0")


#: name: the vote, from the counts of a text. Pairs of rules look at one fault from two sides.
RULES: dict[str, Column | object] = {
    "symbols": lambda: _vote(_share("n_symbols", "n_words"), 0.3, 0.1),
    "marks": lambda: _vote(_share("n_marks", "word_chars"), 0.2, 0.12),
    "capitals": lambda: _vote(_share("n_upper", "word_chars"), 0.5, 0.2),
    "small": lambda: _vote(1 - _share("n_lower", "word_chars"), 0.6, 0.4),
    "repeats": lambda: _vote(_share("n_repeat_words", "n_words"), 0.5, 0.2),
    "lines": lambda: _vote(_share("n_dup_lines", "n_lines"), 0.4, 0.1),
    "variety": lambda: _vote(1 - F.sqrt(_share("n_distinct", "n_words")), 0.75, 0.55),
    "top": lambda: _vote(_share("n_top", "n_words"), 0.3, 0.15),
    "length": lambda: _vote(F.abs(_share("word_chars", "n_words") - 5.5), 6.0, 3.0),
}


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of textstats.FIELDS, for every row."""

    def make():
        def fn(ids, texts):
            columns = zip(*map(stats, texts))
            return {"doc_id": pa.array(ids, pa.int64())} | {
                f: pa.array(c, pa.int64()) for f, c in zip(FIELDS, columns)}

        return fn

    return map_chunks(docs, make, f"doc_id long, {SCHEMA}")


def votes(counts: DataFrame) -> DataFrame:
    """The counts with base_failed and the vote pattern, a letter for each rule."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    pattern = F.concat(*(F.when(F.col("n_words") == 0, "0").otherwise(rule()) for rule in RULES.values()))
    return counts.withColumn("base_failed", failed).withColumn("pattern", pattern)


def estimate(patterns: list[str], counts: list[int], rounds: int = 100) -> tuple[np.ndarray, dict]:
    """Posterior probability of "good" for each pattern, and the estimated rates.

    The start believes a document in the measure in which its rules agree; each rule's rates are smoothed by the
    belief that it is right nine times of ten when it votes, so classes cannot change places.
    """
    votes_ = np.array([["+0-".index(v) for v in p] for p in patterns], int).reshape(len(patterns), len(RULES))
    n = np.array(counts, float)
    seen = np.eye(3)[votes_]  # pattern, rule, vote
    bad = (votes_ == 2).sum(1)
    good = np.where(bad == 0, 0.95, np.where(bad == 1, 0.4, 0.05))
    prior_good, prior_bad = np.array([9.0, 3.0, 1.0]), np.array([4.0, 3.0, 4.0])
    rates: dict = {}
    for _ in range(rounds):
        w1, w0 = n * good, n * (1 - good)
        share = (w1.sum() + 9) / (n.sum() + 10)
        p1 = (np.einsum("p,prv->rv", w1, seen) + prior_good) / (w1.sum() + prior_good.sum())
        p0 = (np.einsum("p,prv->rv", w0, seen) + prior_bad) / (w0.sum() + prior_bad.sum())
        p0[:, 2] = np.maximum(p0[:, 2], p1[:, 2])  # a vote of "bad" never speaks for a document
        odds = np.log(share / (1 - share)) + np.einsum("prv,rv->p", seen, np.log(p1) - np.log(p0))
        now = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done = np.abs(now - good).max(initial=0) < 1e-9
        good, rates = now, {"share": share, "good": p1, "bad": p0}
        if done:
            break
    return good, rates


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior) and kept, for every document."""
    voted = kept_table(votes(text_counts(docs)), "votes")
    found = voted.groupBy("pattern").count().collect()  # at most 3 ** len(RULES) rows
    good, _ = estimate([r["pattern"] for r in found], [r["count"] for r in found])
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(r["pattern"], float(g)) for r, g in zip(found, good)], "pattern string, quality double")
    return (voted.join(F.broadcast(table), "pattern", "left")
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
