"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # All payment times are UTC without zone; a UTC session keeps casts neutral.
    "spark.sql.session.timeZone": "UTC",
    # Size-checked broadcasts, partition coalescing and skew splits at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Retried or replayed writes replace only the partitions they produce.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: The folder of each local session that names none.
_own_folders: dict[str, str] = {}


def build_session(app: str = "tollbook", cores: int | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the library's settings; `cores` asks for local mode, otherwise the launcher decides."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables, as the cluster names it.

    Only a local session may fall back to a folder of its own; on a cluster an executor's
    disk is not shared, so an unset folder is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="tollbook-")
    return _own_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
