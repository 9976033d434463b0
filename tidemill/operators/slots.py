"""How keys spread over slots and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.keys import key_slot, slot_to_shard


def with_slots(df: DataFrame, key: str, shards: int) -> DataFrame:
    slot = key_slot(F.col(key))
    return df.withColumn("slot", slot).withColumn("shard", slot_to_shard(F.col("slot"), shards))


def keys_per_shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Rows per shard; shards without any row are listed with 0."""
    counts = with_slots(df, key, shards).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(0, shards, 1, 1).select(F.col("id").cast("int").alias("shard"))
    return every.join(counts, "shard", "left").select(
        "shard", F.coalesce("n", F.lit(0)).alias("n")
    )
