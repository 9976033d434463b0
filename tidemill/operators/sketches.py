"""Mergeable sketches per window: quantiles and distinct keys, stored once and united over any range.

The raw rows are read once. A range of any length is then answered from its windows' sketches,
whose number and size depend on the windows and groups, not on the rows. Tasks merge sketches
before the shuffle, so a hot group costs a sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Items a quantile sketch keeps a level: ranks are off by 0.3 % at most with a probability of 99 %.
RANK_ITEMS = 1000
# Logarithm of the registers of a distinct sketch: a standard error of 0.8 %.
LOG_REGISTERS = 14


def window_sketches(
    df: DataFrame, time: str, by: list[str], value: str, key: str, window: str = "day",
    items: int = RANK_ITEMS, log_registers: int = LOG_REGISTERS,
) -> DataFrame:
    """One row per window and group: ``day``, ``window_start``, ``by``, ``value_sketch``, ``key_sketch``.

    ``window`` is a unit of `date_trunc` of a day at most. Null and NaN values and null keys take
    no part; a group of nulls only has empty sketches. Null groups and null times are groups too.
    """
    start = F.date_trunc(window, F.col(time))
    number = F.col(value).cast("double")
    return (
        df.groupBy(start.alias("window_start"), *by)
        .agg(
            F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(items)).alias("value_sketch"),
            F.hll_sketch_agg(F.col(key), log_registers).alias("key_sketch"),
        )
        .withColumn("day", F.to_date("window_start"))
    )


def store_days(sketches: DataFrame, path: str) -> None:
    """Write the sketches of whole days; days that are there already are replaced, so runs can be repeated.

    A day that has lost all its rows since must be deleted by the caller, as it isn't among these.
    """
    (
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(path)
    )


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches; a filter on ``day`` prunes folders."""
    return spark.read.parquet(path)


def merged(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """One row per group with the sketches of all its windows united."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
        F.hll_union_agg("key_sketch").alias("key_sketch"),
    )


def count(sketch: str = "value_sketch") -> Column:
    """How many values went in; exact."""
    return F.kll_sketch_get_n_double(sketch)


def quantile(rank: float, sketch: str = "value_sketch") -> Column:
    """A value of about the rank; null without values."""
    return F.when(count(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def share_up_to(limit: float, sketch: str = "value_sketch") -> Column:
    """About the share of values not above the limit; null without values."""
    return F.when(count(sketch) > 0, F.kll_sketch_get_rank_double(sketch, F.lit(limit)))


def distinct(sketch: str = "key_sketch") -> Column:
    """About the number of different keys."""
    return F.hll_sketch_estimate(sketch)
