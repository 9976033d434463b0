"""Topic records as a stream: source, triggers, message transforms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.json import typed_message
from tidemill.operators.dedupe import latest_per_key

RECORD_COLUMNS = ["topic", "partition", "offset", "key", "value"]

# Fixed values: (records, seconds) after which a batch is written.
PRODUCTION_BATCH = (1000, 5)
DEVELOPMENT_BATCH = (100, 3)


def read_topic(
    spark: SparkSession, topic: str, format: str = "kafka", start: str = "earliest",
    batch: tuple[int, int] = PRODUCTION_BATCH, **options: str,
) -> DataFrame:
    """Records of a topic, key and value as text, from the earliest or latest offset."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start!r}")
    raw = (
        spark.readStream.format(format)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("maxOffsetsPerTrigger", batch[0])
        .options(**options)
        .load()
    )
    return as_records(raw)


def as_records(raw: DataFrame) -> DataFrame:
    """The record columns, with binary keys and values as text."""
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
    )


def read_files(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet",
    files_per_trigger: int | None = None, bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; a limit per batch is by files or by size.

    Files are taken by age, so set a limit only where a batch may be processed
    before files that hold earlier rows.
    """
    reader = spark.readStream.format(format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    elif bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def trigger(batch: tuple[int, int] | None = None) -> dict:
    """Trigger arguments: every so many seconds, or everything there is and stop."""
    return {"availableNow": True} if batch is None else {"processingTime": f"{batch[1]} seconds"}


def with_message(
    records: DataFrame, message: Callable[[Column], Column] = typed_message
) -> DataFrame:
    """Row-in, row-out message transform: adds ``message``, NULL where it does not apply."""
    return records.withColumn("message", message(F.col("value")))


def start(
    frame: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
    batch: tuple[int, int] | None = None,
) -> StreamingQuery:
    """Start to process batches through ``sink``, and return the running query.

    ``batch`` is (records, seconds): a batch every so many seconds, of as many records as the
    source was read with. Without it, what there is, and then the query ends. Progress is committed
    after the sink returns; a sink that raises is called again with the same batch on
    the next start.
    """
    return (
        frame.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(batch))
        .start()
    )


def stop(query: StreamingQuery) -> None:
    """Finish what has arrived, then stop. An error of the query is raised."""
    query.processAllAvailable()
    query.stop()
    query.awaitTermination()


def run_to_end(
    frame: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process what there is in batches through ``sink``, and return when done."""
    query = start(frame, checkpoint, sink)
    query.awaitTermination()
    return query


def append_to_end(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what there is to a Parquet folder; the sink's log makes it exactly once."""
    query = (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def update_to_end(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's updated aggregates to a folder of the batch, and return when done.

    Unlike appending, this also holds the windows that are still open at the end. A batch that
    is run again overwrites its folder. `updated` reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        frame.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def updated(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last update of every key."""
    every = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(every).parquet(path)
    return latest_per_key(rows, keys, ["batch"], []).drop("batch")
