"""Session profile and the shared working folder.

Executor memory, serializer and speculation are core settings: Spark rejects
them once the context runs, so they belong to the builder or to spark-submit.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PROFILE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Sessions of one key are merged inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str, master: str | None = None, **core_settings: str) -> SparkSession:
    """A session with the profile above; ``core_settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in PROFILE.items():
        builder = builder.config(key, value)
    for key, value in core_settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder that the cluster names.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each write to their own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: later plans start there, and lost executors cost nothing."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
