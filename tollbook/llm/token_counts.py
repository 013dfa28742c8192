"""Token counts of whole texts, with a shortcut for words that are one token by themselves.

Null texts count as empty: 0 bytes, 0 tokens. Texts of any length are counted whole; one of `limit` tokens is not over it. Every row
is counted by itself, repeated rows and rows with a null doc_id too. An empty table gives no rows; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from tollbook.llm.common import map_chunks
from tollbook.llm.tokenization import piece_counter, single_words

LIMIT = 4096


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document, by a sentencepiece model file."""
    single = single_words(model)
    shared = docs.sparkSession.sparkContext.broadcast(single)

    def make():
        counter = piece_counter(model, shared.value)

        def fn(ids, texts):
            n = counter.count(texts)
            return {"doc_id": pa.array(ids, pa.int64()),
                    "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()), "over_limit": [x > limit for x in n]}

        return fn

    return map_chunks(docs, make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
