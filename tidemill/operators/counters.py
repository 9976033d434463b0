"""Gauges and threshold counters of sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Readings strictly above HIGH or below LOW raise an alert.
HIGH = 28.0
LOW = 22.0


def alert_label(value: Column, high: float = HIGH, low: float = LOW) -> Column:
    """``high``, ``low`` or NULL; readings on a limit raise nothing."""
    return F.when(value > high, "high").when(value < low, "low")


def alert_counts(df: DataFrame, value: str, high: float = HIGH, low: float = LOW) -> DataFrame:
    """Alerts per label."""
    labelled = df.withColumn("label", alert_label(F.col(value), high, low))
    return (
        labelled.filter(F.col("label").isNotNull())
        .groupBy("label").agg(F.count(F.lit(1)).alias("alerts"))
    )


def gauges(df: DataFrame, value: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Readings in total and the latest value, overall or per sensor.

    The newest time per sensor is found by a hash aggregate, without sorting the rows; only rows
    of that time are compared by the whole order.
    """
    by = by or []
    first = order[0]
    newest = df.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(
        F.count(F.lit(1)).alias("readings"), F.max(first).alias("_newest")
    )
    on = F.col(first).eqNullSafe(F.col("_newest"))
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    latest = newest.join(df.select(*dict.fromkeys([*by, *order, value])), on)
    return latest.groupBy(*by).agg(
        F.max("readings").alias("readings"), F.max_by(value, F.struct(*order)).alias("last_value")
    )


def group_average(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias("average_value"))
