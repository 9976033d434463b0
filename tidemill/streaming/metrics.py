"""Figures of each batch of a stream, taken in the pass that writes it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class MeasuredSink:
    """foreachBatch sink around another one: a row of ``figures`` per batch, without a job for them.

    ``figures`` are aggregates by name. They are collected as the inner sink's first action reads the
    batch, so that it must run one, as any sink that writes does. Batch N is a folder named by N, which
    is overwritten when the batch is run again; one that fails leaves no row. The figures are for
    watching a stream: a task that was lost and run again may have been counted twice.
    """

    spark: SparkSession
    sink: Callable[[DataFrame, int], None]
    path: str
    figures: dict[str, Column]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        self.sink(batch.observe(seen, *[c.alias(n) for n, c in self.figures.items()]), batch_id)
        kinds = batch.limit(0).agg(*[c.alias(n) for n, c in self.figures.items()]).schema
        row = self.spark.createDataFrame([tuple(seen.get[n] for n in kinds.names)], kinds)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def rows(self) -> DataFrame:
        """The figures of all batches, with ``batch``."""
        return self.spark.read.parquet(self.path).withColumn("batch", F.col("batch").cast("long"))
