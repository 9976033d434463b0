"""Latency statistics: exact ranks, summaries, histograms, shares and ratios."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import shuffle_width

# Floor of the denominator in ratios of two scenarios.
SMALLEST_DENOMINATOR = 0.001


def running_counts(
    df: DataFrame, value: str, by: list[str] | None = None, pieces: int | None = None
) -> DataFrame:
    """One row per distinct value: ``n`` equal values, ``before`` smaller ones, ``total``.

    Equal values are counted before anything is sorted. The distinct values are
    cut into pieces at quantiles of the whole column, each piece is summed on its
    own, and the pieces' totals (one row each) are added up afterwards, so no
    task sorts more than a piece even when a single group holds all rows.
    NULL values do not take part. Values are compared in the column's own type.
    """
    by = by or []
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pieces = pieces or shuffle_width(df.sparkSession)
    cuts = df.select(F.col(value).cast("double").alias(value)).approxQuantile(
        value, [i / pieces for i in range(1, pieces)], 1.0 / (4 * pieces)
    )
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    # The pieces only need to follow the order; values that are equal as doubles share one.
    placed = Bucketizer(
        splits=splits, inputCol="_as_double", outputCol="_piece", handleInvalid="keep"
    ).transform(counted.withColumn("_as_double", F.col(value).cast("double"))).drop("_as_double")
    all_pieces = Window.partitionBy(*by)
    totals = placed.groupBy(*by, "_piece").agg(F.sum("n").alias("_m"))
    # One extra first row per piece brings in what lies before it, and the total.
    first_rows = totals.select(
        *by,
        "_piece",
        F.lit(0).alias("_is_row"),
        (F.sum("_m").over(all_pieces.orderBy("_piece")) - F.col("_m")).alias("n"),
        F.sum("_m").over(all_pieces).alias("_total"),
    )
    rows = placed.withColumn("_is_row", F.lit(1)).unionByName(first_rows, allowMissingColumns=True)
    along = Window.partitionBy(*by, "_piece").orderBy("_is_row", value)
    summed = rows.withColumns(
        {
            "_until": F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.first("_total").over(along.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    return summed.filter(F.col("_is_row") == 1).select(
        *by, value, "n", (F.col("_until") - F.col("n")).alias("before"), "total"
    )


def empirical_cdf(
    df: DataFrame, value: str, by: list[str] | None = None, block: int = 100_000
) -> DataFrame:
    """One row per observation: its position ``i`` and the fraction ``i / total``.

    Equal values get distinct steps. Long runs of equal values are first cut into
    blocks and spread out, so that no task writes a whole run alone.
    """
    by = by or []
    counts = running_counts(df, value, by)
    starts = F.sequence(F.col("before"), F.col("before") + F.col("n") - 1, F.lit(block).cast("bigint"))
    blocks = counts.withColumn("_start", F.explode(starts)).repartition(*by, value, "_start")
    end = F.least(F.col("_start") + block, F.col("before") + F.col("n"))
    steps = blocks.withColumn("i", F.explode(F.sequence(F.col("_start") + 1, end)))
    return steps.select(*by, value, "i", (F.col("i") / F.col("total")).alias("fraction"))


def value_at_rank(
    df: DataFrame, value: str, share: float, by: list[str] | None = None
) -> DataFrame:
    """The value at 1-based rank floor(share * n) + 1, exactly, as ``at_rank``."""
    by = by or []
    wanted = F.floor(F.col("total") * F.lit(share))
    hit = running_counts(df, value, by).filter(
        (F.col("before") <= wanted) & (wanted < F.col("before") + F.col("n"))
    )
    return hit.select(*by, F.col(value).alias("at_rank"))


def latency_summary(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """fastest, avg, p99 (by rank floor(0.99 n) + 1) and slowest per group."""
    basic = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.min(value).alias("fastest"),
        F.avg(value).alias("average"),
        F.max(value).alias("slowest"),
    )
    p99 = value_at_rank(df, value, 0.99, by).withColumnRenamed("at_rank", "p99")
    on = F.lit(True)
    for c in by:
        on = on & basic[c].eqNullSafe(p99[c])
    return basic.join(p99, on, "left").select(
        *[basic[c] for c in by], "n", "fastest", "average", "p99", "slowest"
    )


def latency_summary_approx(
    df: DataFrame, value: str, by: list[str], accuracy: int = 10_000
) -> DataFrame:
    """As `latency_summary` in one pass, with a sketched p99 (relative rank error 1/accuracy)."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.min(value).alias("fastest"),
        F.avg(value).alias("average"),
        F.percentile_approx(value, 0.99, accuracy).alias("p99"),
        F.max(value).alias("slowest"),
    )


def share_under(value: Column, limit: float) -> Column:
    """Percentage of non-NULL values strictly under the limit."""
    return F.avg(F.when(value < F.lit(limit), 100.0).when(value.isNotNull(), 0.0))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins over [min, max], empty bins included.

    Bins are closed on the left, the last one also on the right. The bin list
    has ``bins`` rows, which is what is joined to the counts.
    """
    spark = df.sparkSession
    observed = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    edges = observed.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    low, high = edges.getField("lo"), edges.getField("hi")
    width = (high - low) / bins
    position = F.when(high > low, F.floor((F.col("v") - low) * bins / (high - low))).otherwise(0)
    counts = (
        observed.groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = spark.range(0, bins, 1, 1).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_from"),
        (low + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def recall_bins(distinct: int) -> int:
    """Number of bins for a recall histogram."""
    return max(5, distinct)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient with the denominator floored, so that it never divides by zero."""
    return numerator / F.greatest(denominator, F.lit(SMALLEST_DENOMINATOR))


def scenario_ratio(summary: DataFrame, scenario: str, base, other) -> DataFrame:
    """Ratios base/other of the average, p99 and slowest value of two summary rows."""
    measures = ["average", "p99", "slowest"]
    picked = {
        (name, m): F.max(F.when(F.col(scenario) == F.lit(name), F.col(m)))
        for name in (base, other)
        for m in measures
    }
    return summary.agg(
        *[ratio(picked[base, m], picked[other, m]).alias(f"{m}_ratio") for m in measures]
    )
