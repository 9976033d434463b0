"""Event-time windows on streams: threshold counters and the minute roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.counters import HIGH, LOW, alert_label
from tidemill.operators.rollup import Output, rollup


def with_event_time(df: DataFrame, ts: str, late: str = "10 minutes") -> DataFrame:
    """Watermarked event time; naive timestamps are cast, as watermarks need an instant."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def windowed_alerts(
    df: DataFrame, ts: str, value: str, window: str = "1 minute", late: str = "10 minutes",
    high: float = HIGH, low: float = LOW,
) -> DataFrame:
    """Readings and alerts per label in each window; label NULL holds the other readings."""
    timed = with_event_time(df, ts, late)
    counts = timed.groupBy(
        F.window(ts, window).alias("w"), alert_label(F.col(value), high, low).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "label", "n")


def streaming_rollup(
    df: DataFrame, outputs: list[Output], keys: list[str], ts: str = "ts",
    late: str = "10 minutes", emit_minute: str | None = None,
) -> DataFrame:
    """The minute roll-up as a stream; in append mode a minute is emitted once the watermark passed it.

    ``emit_minute`` names a column with the minute's start, which update mode needs as a key.
    """
    timed = with_event_time(df, ts, late)
    return rollup(timed, outputs, keys, ts, minute=F.window(ts, "1 minute"), emit_minute=emit_minute)
