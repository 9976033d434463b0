"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Naive timestamps are read as UTC everywhere; bad input must be handled with
# try_* functions because ANSI mode raises.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "tidemill", master: str | None = None, **settings: str
) -> SparkSession:
    """Create (or get) a session with the library's settings.

    ``settings`` are passed through with ``__`` standing for a dot and win over
    the defaults, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {**CLUSTER_SETTINGS, **REQUIRED_SETTINGS}
    merged.update({k.replace("__", "."): v for k, v in settings.items()})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings results depend on in an existing session."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written intermediates, below ``spark.checkpoint.dir``.

    The setting names storage every executor can reach. Only a session whose
    executors are threads of this process (master ``local`` or ``local[n]``)
    may do without: it uses a temporary folder. Settings aren't changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "tidemill")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


class Scratch:
    """Written intermediates of one job below a folder of their own, deleted together."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.count = spark, shared_folder(spark, purpose), 0

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """The frame as a table of the folder."""
        self.count += 1
        path = f"{self.folder}/{self.count}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete the tables; what was read from them must have been written or used by now."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, for results that are read more than once."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Number of pieces to split ordered work into: the shuffle width."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
