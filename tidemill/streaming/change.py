"""Change-only filter on a stream, with one remembered value per key."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.operators.dedupe import keep_changes


@dataclass
class ChangeSink:
    """foreachBatch sink that keeps the rows whose value differs from the key's last one.

    Rows that repeat the one before them in their batch are dropped before the batch is
    appended, in pieces if one key fills it; repeats across batches are dropped on reading, so
    that the result is the same however the rows fall into batches. A batch that is run
    again overwrites its folder.
    """

    spark: SparkSession
    path: str
    key: str
    value: str
    order: list[str]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._changes(batch).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def _changes(self, rows: DataFrame) -> DataFrame:
        return keep_changes(rows, [self.key], self.order, F.col(self.value))

    def rows(self, schema: T.StructType) -> DataFrame:
        return self._changes(self.spark.read.schema(schema).parquet(self.path).select(*schema.names))


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _LastValue(StatefulProcessor):
    """Keeps a key's last value and passes on the rows that change it."""

    def __init__(self, value: str, order: list[str], ttl_ms: int | None):
        self.value, self.order, self.ttl_ms = value, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("v", T.StringType())])
        self.last = handle.getValueState("last", schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # One key's rows of one batch in one task: limit the trigger, or use `ChangeSink`.
        batch = pd.concat(list(rows))
        batch = batch.iloc[np.lexsort([batch[c].to_numpy() for c in reversed(self.order)])]
        values = batch[self.value].to_numpy(dtype=object)
        values = np.where(pd.isna(values), None, values)
        changed = np.ones(len(values), dtype=bool)
        changed[1:] = values[1:] != values[:-1]
        if self.last.exists():
            changed[0] = values[0] != self.last.get()[0]
        self.last.update((values[-1],))
        yield batch[changed]

    def close(self) -> None:
        pass


def changes_only(
    stream: DataFrame, key: str, value: str, order: list[str], ttl_ms: int | None = None
) -> DataFrame:
    """Rows whose value differs from the last one of the key.

    State lives in RocksDB, one value per key, and is dropped after ``ttl_ms``
    without a row. Nothing is evicted to save space before that, so the result
    is exact; an expired key's next row counts as changed.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_LastValue(value, order, ttl_ms),
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )
