"""Language of a text: multinomial naive Bayes over hashed character n-grams.

Counts come from every labelled text of the learning fold. The matrix of log-probabilities has
BUCKETS rows and a column per language, so its size does not grow with the data.

Texts are scored in batches: the buckets of their n-grams are the sparse rows, the rows of the matrix that they name are
summed up by text, at most CELLS numbers of them at a time.

Null or letterless text, an empty one too, gives `und` with score 0; without any labelled text every document does. Ties go to the
first language in alphabetical order. Documents with a null id are never learned from. Texts of any length are read whole, in
slices that count every n-gram once. Rows that repeat are learned from, and answered, each time. Of more than
MAX_LANGUAGES labels, which bound the matrix, the most frequent are learned. Empty tables give no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import map_chunks

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Columns of the matrix at most.
MAX_LANGUAGES = 256
#: Code points of a long text that are read at a time; numbers of the matrix that are summed at a time.
SLICE = 1 << 20
CELLS = 1 << 21
_MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


@cache
def _folded() -> np.ndarray:
    """For each code point its small letter, or a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x40000):  # no letter stands beyond
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(text: str) -> np.ndarray:
    """Small letters of a text with a space at each end and one for every run of other characters."""
    points = _folded()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 32
    return points[np.r_[True, ~(blank[1:] & blank[:-1])]]


def grams(points: np.ndarray, old: int = 0) -> np.ndarray:
    """Bucket of every n-gram that ends after the first `old` letters."""
    out, h = [], np.zeros(len(points), np.uint32)
    for n in ORDERS:
        if len(points) < n:
            break
        h = (h[: len(points) - n + 1] ^ points[n - 1 :]) * _MIX[n - 1]
        h ^= h >> np.uint32(15)
        out.append((h[max(0, old - n + 1) :] * _MIX[0]) >> np.uint32(17))
    return np.concatenate(out)


def gram_parts(text: str):
    """The buckets of a whole text, slice by slice, each with whether a letter is among what is new."""
    tail = np.empty(0, np.uint32)
    for start in range(0, max(len(text), 1), SLICE):
        piece = " " * (start == 0) + text[start : start + SLICE] + " " * (start + SLICE >= len(text))
        points = _folded()[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = points == 32
        points = points[~(blank & np.r_[len(tail) > 0 and tail[-1] == 32, blank[:-1]])]
        known = np.concatenate([tail, points])
        if len(points):
            yield grams(known, len(tail)), bool((points != 32).any())
        tail = known[len(known) - max(ORDERS) + 1 :] if len(known) >= max(ORDERS) else known


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, bucket (-1 for the texts themselves) and count, over all rows of (doc_id, text, lang)."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang").to_pylist()
            for i, lang in enumerate(langs):
                if lang not in counts:
                    counts[lang] = np.zeros(BUCKETS, np.int64)
                seen[lang] = seen.get(lang, 0) + 1
                for part, _ in gram_parts(texts[i].as_py()):
                    counts[lang] += np.bincount(part, minlength=BUCKETS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * (len(at) + 1)), "bucket": pa.array(np.r_[at, -1], pa.int32()),
                "n": pa.array(np.r_[n[at], seen[lang]], pa.int64())})

    return (docs.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-priors, and the matrix of smoothed log-probabilities, of labelled texts."""
    labelled = docs.filter("text is not null and lang is not null")
    frequent = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    langs = sorted(r.lang for r in frequent.collect())
    rows = gram_counts(labelled.filter(F.col("lang").isin(langs))).collect()
    column = {lang: i for i, lang in enumerate(langs)}
    counts, texts = np.full((BUCKETS, len(langs)), 0.5), np.zeros(len(langs))
    for r in rows:
        if r.bucket < 0:
            texts[column[r.lang]] = r.n
        else:
            counts[r.bucket, column[r.lang]] += r.n
    return langs, np.log(texts / max(texts.sum(), 1)), np.log(counts / counts.sum(0))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (the posterior probability) of every document."""
    langs, prior, _ = model
    shared = docs.sparkSession.sparkContext.broadcast(model[2])

    def make():
        matrix = shared.value
        most = max(1024, CELLS // max(len(langs), 1))

        def fn(ids, texts):
            sums = np.tile(prior, (len(texts), 1))
            found = np.zeros(len(texts), bool)
            held, rows, size = [], [], 0

            def add():
                starts = np.cumsum([0, *map(len, held[:-1])])
                np.add.at(sums, rows, np.add.reduceat(matrix[np.concatenate(held)], starts, axis=0))

            for row, text in enumerate(texts if langs else ()):
                for part, letter in gram_parts(text):
                    found[row] |= letter
                    for at in range(0, len(part), most):
                        held.append(part[at : at + most])
                        rows.append(row)
                        size += len(held[-1])
                        if size >= most:
                            add()
                            held, rows, size = [], [], 0
            if held:
                add()
            best = np.argmax(sums, axis=1) if langs else np.zeros(len(texts), int)
            scores = [float(1 / np.exp(s - s[b]).sum()) if f else 0.0 for s, b, f in zip(sums, best, found)]
            return {"doc_id": pa.array(ids, pa.int64()), "lang_pred": [langs[b] if f else "und" for b, f in zip(best, found)],
                    "score": pa.array(scores, pa.float64())}

        return fn

    return map_chunks(docs, make, "doc_id long, lang_pred string, score double")
