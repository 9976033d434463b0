"""Heavy keys: finding them, and aggregating despite them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import written


def key_shares(df: DataFrame, key: str, at_least: float = 0.0) -> DataFrame:
    """Rows per key and their share of all rows, for keys with at least that share."""
    counts = written(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).filter(F.col("share") >= at_least)


def salted_totals(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column],
    spread_by: list[str],
    salts: int = 32,
) -> DataFrame:
    """Row count and sums per key in two steps, each key cut into ``salts`` parts.

    The salt is a hash of ``spread_by``, so a retried task puts a row in the same
    part. Counts and sums are exact for exact types.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).alias("_salt")
    parts = df.groupBy(*keys, salt).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_{name}") for name, c in sums.items()]
    )
    return parts.groupBy(*keys).agg(
        F.sum("_n").alias("n"), *[F.sum(f"_{name}").alias(name) for name in sums]
    )


def salted_distinct(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact distinct values per key without gathering a heavy key in one task.

    Pairs (key, value) are made unique first, which spreads a key over its values.
    """
    pairs = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct_values"))
