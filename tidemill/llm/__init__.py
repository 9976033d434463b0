"""Operators of a training-data pipeline; nothing else in the library imports them."""

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Whole texts go to Python in batches of so many rows, unless the session sets fewer."""
    if int(spark.conf.get(BATCH)) > rows:
        spark.conf.set(BATCH, str(rows))
    return spark


def release_memory() -> None:
    """Give memory that a task has freed back to the system; its Python worker stays for others.

    The C library keeps what was freed for itself, where the executor's JVM and its other workers
    can't use it. Where the library isn't glibc, only Arrow's share is given back.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
