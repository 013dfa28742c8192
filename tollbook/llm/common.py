"""What the operators share: document batches, words, work tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.session import new_path

#: Characters of text handled at a time inside a task.
CHUNK_CHARS = 1 << 20

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only what an operator reads, so that other columns, whatever their names, never meet its own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a document without an id belongs to it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def map_chunks(df: DataFrame, make: Callable[[], Callable[[list, list], dict]], schema: str) -> DataFrame:
    """Rows that a function makes of (doc_ids, texts), called with about CHUNK_CHARS characters at a time.

    `make` runs once in each task. A text is never cut; null texts arrive as "".
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for ids, texts in chunks(batches):
            out = fn(ids, texts)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return id_and_text(df).mapInArrow(run, schema)


def chunks(batches: Iterator[pa.RecordBatch], chars: int = CHUNK_CHARS) -> Iterator[tuple[list, list]]:
    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1)
        first, size, texts = 0, 0, []
        for i in range(len(ids)):
            texts.append(column[i].as_py() or "")
            size += len(texts[-1])
            if size >= chars:
                yield ids[first : i + 1], texts
                first, size, texts = i + 1, 0, []
        if texts:
            yield ids[first:], texts


def with_own_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with an id of their own in one more column, and that column's name.

    It is the doc_id where no other row has it. Rows that share one, or have none, get numbers above all doc_ids (above 0 if
    a doc_id is too large for that), written once so that they stay; usually there are none.
    """
    name = "own_id"
    while name in docs.columns:
        name += "_"
    shared = kept_table(docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select(
        F.col("doc_id").alias("_shared")), "shared")
    if shared.isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long")), name
    same = docs["doc_id"].eqNullSafe(shared["_shared"])
    largest = docs.agg(F.max("doc_id")).first()[0] or 0
    free = max(0, largest + 1) if largest < 1 << 62 else -(1 << 62)
    numbered = docs.join(shared, same, "left_semi").withColumn(name, F.lit(free) + F.monotonically_increasing_id())
    return docs.join(shared, same, "left_anti").withColumn(name, F.col("doc_id").cast("long")).unionByName(
        kept_table(numbered, "own-ids")), name


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
