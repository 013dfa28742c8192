"""Scans and written tables."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def kept(df: DataFrame, path: str) -> DataFrame:
    """Rows written once to a path that nothing else uses, and read back: whatever follows does not make them again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write one version of a table, then publish its number.

    Readers see a version only once it is complete; writing the same version again replaces it.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    published = df.sparkSession.range(1).select(F.lit(version).alias("version"))
    published.write.mode("append").parquet(f"{path}-versions")


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a table, the newest published unless named."""
    if version is None:
        version = spark.read.parquet(f"{path}-versions").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/version={version}")


def append_batch(df: DataFrame, path: str, batch: int, stream: str | None = None) -> None:
    """Append one batch of rows; a replayed batch replaces itself instead of doubling.

    Batches of different streams on one path have numbers of their own.
    """
    named = df if stream is None else df.withColumn("stream", F.lit(stream))
    (named.withColumn("batch", F.lit(batch)).write.partitionBy(*(["stream"] if stream else []), "batch")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def read_batches(spark: SparkSession, path: str, schema: str, streams: bool = False) -> DataFrame:
    """All appended batches, with their number in `batch` and, if they have one, their `stream`."""
    return spark.read.schema(f"{schema}{', stream string' * streams}, batch int").parquet(path)


def path_exists(spark: SparkSession, path: str, schema: str) -> bool:
    """Whether anything has been written to a path; other errors are errors."""
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stream_name(checkpoint: str) -> str:
    """A stream is known by its checkpoint, which is what numbers its batches."""
    return "s" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Keep a table bucketed and sorted by a key, so that joins on the key need not shuffle it.

    Tables that meet on a key want the same number of buckets, a few hundred megabytes each.
    """
    (df.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite")
     .format("parquet").saveAsTable(name))
