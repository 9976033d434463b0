"""Tag and range search, attribution totals, sampling and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_range_search(
    df: DataFrame,
    tag: str,
    wanted,
    measure: str,
    floor: float,
    order: list[str],
    offset: int = 0,
    size: int = 500,
) -> DataFrame:
    """One page of rows with that tag and ``measure >= floor``, plus ``matches`` in total."""
    hits = df.filter((F.col(tag) == F.lit(wanted)) & (F.col(measure) >= F.lit(floor)))
    total = hits.agg(F.count(F.lit(1))).scalar()
    return page(hits, order, offset, size).withColumn("matches", total)


def write_searchable(df: DataFrame, path: str, tag: str, measure: str) -> None:
    """Write rows ordered by tag and measure, so that a search skips most row groups.

    Ranges of (tag, measure) become files of even size; a frequent tag has many.
    """
    ordered = df.repartitionByRange(tag, measure).sortWithinPartitions(tag, measure)
    ordered.write.mode("overwrite").parquet(path)


def page(df: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    """Rows offset .. offset + size - 1 in the given order; the order should be total."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(size)


def matches_per_tag(df: DataFrame, tag: str, measure: str, floor: float) -> DataFrame:
    """Rows at or above the floor per tag; tags without a match are listed with 0."""
    return df.groupBy(tag).agg(F.count_if(F.col(measure) >= F.lit(floor)).alias("matches"))


def sample_keys(df: DataFrame, key: str, size: int = 200, seed: int = 0) -> DataFrame:
    """min(size, n) random keys; the same seed gives the same keys on any layout."""
    lot = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)))
    return df.select(key).orderBy(lot, key).limit(size)


def attribution_totals(
    df: DataFrame, by: list[str], revenue: Column, spend: Column | None = None,
    roas: Column | None = None,
) -> DataFrame:
    """Rows, revenue, mean ROAS and, where spend is known, revenue / spend per group.

    Zero spend gives a NULL ratio.
    """
    aggregates = [F.count(F.lit(1)).alias("n"), F.sum(revenue).alias("revenue")]
    if roas is not None:
        aggregates.append(F.avg(roas).alias("mean_roas"))
    if spend is not None:
        aggregates.append(F.sum(spend).alias("spend"))
    totals = df.groupBy(*by).agg(*aggregates)
    if spend is not None:
        share = F.try_divide(F.col("revenue").cast("double"), F.col("spend").cast("double"))
        totals = totals.withColumn("return_on_spend", share)
    return totals
