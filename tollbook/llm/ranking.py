"""Quality scores by Bradley-Terry ranking.

A preference pair is a labelled document of quality 1 and one of quality 0. Weights come from logistic loss on
the difference of their features; the threshold is a quantile of the scores of all labelled rows, the one that parts the
labels best, and the score is a logistic curve that is 0.7 there.

The weights are fitted on at most ROWS labelled ids, those whose hash is smallest, one text of each (the smallest), and PAIRS pairs of them. The
threshold comes from every labelled row, by counts of their scores in BINS classes. Without a pair nothing
can be learned: every score is 0.7 and nothing is rejected. Null texts count as empty, and empty texts have a score like others. Texts of
any length are read whole. Rows of one id share its label (the smallest, if labels differ); a null id is scored and never
learned from. Rows that repeat count each time for the threshold. Of cuts that part the labels equally well the lowest is taken.
Empty tables give no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import map_chunks
from tollbook.llm.textstats import FIELDS, stats

ROWS = 20_000
PAIRS = 100_000
#: Classes of scores that the threshold is sought among, and how many of them are a standard deviation of the sample's scores.
BINS, FINE = 1 << 17, 1 << 12
#: A document is taken from this score on.
TAKEN = 0.7

FEATURES = 14


def features(text: str) -> list[float]:
    """Shares of a text's counts, drawn towards 0 for the shortest texts, and how long it is."""
    s = dict(zip(FIELDS, stats(text)))
    words, chars, lines = s["n_words"] + 4, s["word_chars"] + 20, s["n_lines"] + 1
    upper, symbols = s["n_upper"] / chars, s["n_symbols"] / words
    repeats, top = s["n_repeat_words"] / words, s["n_top"] / words
    variety = ((s["n_distinct"] + 4) / words) ** 0.5
    return [min(symbols, 3.0), symbols > 0.2, upper, upper > 0.4, s["n_marks"] / chars, s["n_digits"] / chars,
            repeats, repeats > 0.4, top if words > 24 else 0.0, variety, s["n_dup_lines"] / lines,
            min(chars / words, 30.0), np.log1p(words), float(s["n_words"] == 0)]


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features, for every row."""

    def make():
        def fn(ids, texts):
            return {"doc_id": pa.array(ids, pa.int64()),
                    "x": pa.array([[float(v) for v in features(t)] for t in texts], pa.list_(pa.float64()))}

        return fn

    return map_chunks(docs, make, "doc_id long, x array<double>")


def known_labels(labels: DataFrame, allowed: Column | None = None) -> DataFrame:
    """doc_id and quality, one row for each labelled id."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter("quality in (0, 1) and doc_id is not null"))
    if allowed is not None:
        known = known.filter(allowed)
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def labelled_sample(docs: DataFrame, labels: DataFrame, allowed: Column | None = None) -> DataFrame:
    """At most ROWS rows of (doc_id, text, quality) that have a label, by the order of the hashed id, one for each id."""
    chosen = known_labels(labels, allowed).orderBy(F.xxhash64("doc_id"), "doc_id").limit(ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample has a proven size of ROWS rows of two numbers.
    met = texts.join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, seed: int = 7) -> tuple[np.ndarray, float, float] | None:
    """Weights from the sample, and the threshold from all labelled rows."""
    model = train(labelled_sample(docs, labels, allowed), seed)
    if model is None:
        return None
    w, _, spread = model
    known = known_labels(labels, allowed)
    # Texts are scored where they are; what meets the labels is a number for each row.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        F.col("doc_id").isNotNull() & (F.lit(True) if allowed is None else allowed))

    def make():
        def fn(ids, texts):
            raw = np.array([float(np.dot(features(t), w)) for t in texts])
            return {"doc_id": pa.array(ids, pa.int64()),
                    "bin": pa.array(np.clip(np.floor(raw / spread * FINE), -BINS // 2, BINS // 2 - 1).astype(np.int64))}

        return fn

    counted = map_chunks(texts, make, "doc_id long, bin long").join(known, "doc_id").groupBy("bin", "quality").agg(
        F.count("*").alias("n")).collect()
    bins = np.array([r["bin"] for r in counted])
    at = best_cut((bins + 0.5) * spread / FINE, np.array([r["quality"] for r in counted]), np.array([r["n"] for r in counted]))
    return w, at, spread


def train(sample: DataFrame, seed: int = 7) -> tuple[np.ndarray, float, float] | None:
    """Weights, threshold and spread of the labelled sample's scores; None without a pair."""
    quality = sample.select("doc_id", "quality").dropDuplicates(["doc_id"])
    rows = feature_rows(sample).join(F.broadcast(quality), "doc_id").orderBy("doc_id", F.col("x").cast("string")).collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), FEATURES)
    y = np.array([r["quality"] for r in rows], int)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    spread = x.std(0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    z = x / scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
    w, ridge = np.zeros(FEATURES), 10.0
    for _ in range(30):  # Newton's method on the pairs' logistic loss
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(FEATURES), d.T @ p - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    raw = z @ w
    return w / scale, *cut(raw, y)


def cut(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The score that parts the labels best, and the scores' spread."""
    return best_cut(raw, y, np.ones(len(y), int)), float(max(raw.std(), 1e-6))


def best_cut(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The score quantile that parts the counted labels best, in the middle of its gap."""
    order = np.argsort(scores, kind="stable")
    s, bad, good = scores[order], (counts * (labels == 0))[order], (counts * (labels == 1))[order]
    bad_below, good_below = np.r_[0, np.cumsum(bad)], np.r_[0, np.cumsum(good)]
    right = bad_below / max(bad_below[-1], 1) - good_below / max(good_below[-1], 1)
    right[1:-1][s[1:] == s[:-1]] = -np.inf  # equal scores are not parted
    k = int(np.argmax(right))
    return float(s[0] - 1 if k == 0 else s[-1] + 1 if k == len(s) else (s[k - 1] + s[k]) / 2)


def score_text(text: str, model: tuple[np.ndarray, float, float] | None) -> float:
    if model is None:
        return TAKEN
    w, at, spread = model
    z = (float(np.dot(features(text), w)) - at) / (spread / 2) + np.log(TAKEN / (1 - TAKEN))
    return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def score(docs: DataFrame, model: tuple[np.ndarray, float, float] | None) -> DataFrame:
    """doc_id and score of every document."""

    def make():
        def fn(ids, texts):
            return {"doc_id": pa.array(ids, pa.int64()),
                    "score": pa.array([score_text(t, model) for t in texts], pa.float64())}

        return fn

    return map_chunks(docs, make, "doc_id long, score double")


def score_column(text: Column, model: tuple[np.ndarray, float, float] | None) -> Column:
    """The same score as a column, for a filter that leaves rows as they are."""

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(lambda t: score_text(t or "", model)).astype(float)

    return scored(text)
