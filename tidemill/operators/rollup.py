"""Grouped roll-ups written from a declarative list of output columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.clean import minute_slice, sentinel_to_null


@dataclass(frozen=True)
class Output:
    """One output column: ``how`` is key, max, min, count, count_equal or value.

    ``sentinel`` becomes NULL after aggregating. ``value`` holds the number to
    match for count_equal, or the constant Column for value.
    """

    name: str
    how: str
    source: str | None = None
    sentinel: int | None = None
    value: object = None

    def column(self) -> Column:
        source = F.col(self.source or self.name)
        if self.how == "count":
            result = F.count(F.lit(1))
        elif self.how == "count_equal":
            result = F.count_if(source == F.lit(self.value))
        elif self.how == "value":
            result = self.value
        else:
            result = {"max": F.max, "min": F.min, "key": lambda c: c}[self.how](source)
        if self.sentinel is not None:
            result = sentinel_to_null(result, self.sentinel)
        return result.alias(self.name)


def rollup(
    df: DataFrame, outputs: list[Output], keys: list[str], ts: str = "ts",
    minute: Column | None = None, emit_minute: str | None = None,
) -> DataFrame:
    """One row per key combination and minute of ``ts``.

    The minute is a grouping key that is not emitted (``minute`` replaces it, e.g.
    by an event-time window on a stream). Keys appear in the output
    only where ``outputs`` lists them, once each. Every aggregate merges, so each
    task sends one row per group and a heavy group costs no more than a light one.
    """
    aggregates = [o for o in outputs if o.how not in ("key", "value")]
    grouped = df.groupBy(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        (minute_slice(F.col(ts)) if minute is None else minute).alias("_minute"),
    ).agg(*[o.column() for o in aggregates])
    columns = []
    for o in outputs:
        if o.how == "key":
            column = F.col(f"_key_{o.source or o.name}")
            if o.sentinel is not None:
                column = sentinel_to_null(column, o.sentinel)
            columns.append(column.alias(o.name))
        elif o.how == "value":
            columns.append(o.column())
        else:
            columns.append(F.col(o.name))
    if emit_minute is not None:
        start = F.col("_minute") if minute is None else F.col("_minute.start")
        columns.append(start.alias(emit_minute))
    return grouped.select(*columns)


def reduced_rollup(
    df: DataFrame, outputs: list[Output], keys: list[str], ts: str = "ts"
) -> DataFrame:
    """Roll-up over those keys and sources that exist; no key at all means one total row."""
    present = {name.lower() for name in df.columns}
    usable = [
        o
        for o in outputs
        if o.how in ("count", "value") or (o.source or o.name).lower() in present
    ]
    found = [k for k in keys if k.lower() in present]
    by = [F.col(k) for k in found]
    if ts.lower() in present and found:
        by.append(minute_slice(F.col(ts)).alias("time_slice_minute"))
    aggregates = [o.column() for o in usable if o.how not in ("key", "value")]
    grouped = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    return grouped.select("*", *[o.column() for o in usable if o.how == "value"])
