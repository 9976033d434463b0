"""Figures of batches come with the write, and follow what the sink ends with."""

import pytest
from pyspark.sql import functions as F

from tidemill.streaming.metrics import MeasuredSink

def figures():
    return {"n": F.count(F.lit(1)), "total": F.sum("id")}


def _rows(sink):
    return {r.batch: (r.n, r.total) for r in sink.rows().collect()}


def test_a_row_per_batch_and_no_job_of_its_own(spark, folder):
    seen = []

    def write(batch, batch_id):
        seen.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{folder}/out/{batch_id}")

    sink = MeasuredSink(spark, write, f"{folder}/figures", figures())
    sink(spark.range(10), 0)
    sink(spark.range(0), 1)
    sink(spark.range(5), 2)
    assert seen == [0, 1, 2]
    assert _rows(sink) == {0: (10, 45), 1: (0, None), 2: (5, 10)}


def test_a_batch_run_again_replaces_its_figures(spark, folder):
    tries = []

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/out/{batch_id}")
        tries.append(batch_id)
        if len(tries) == 2:
            raise RuntimeError("a batch that fails once")

    sink = MeasuredSink(spark, write, f"{folder}/figures", figures())
    sink(spark.range(3), 0)
    with pytest.raises(RuntimeError):
        sink(spark.range(4), 1)
    assert _rows(sink) == {0: (3, 3)}
    sink(spark.range(6), 1)
    sink(spark.range(6), 1)
    assert _rows(sink) == {0: (3, 3), 1: (6, 15)}
