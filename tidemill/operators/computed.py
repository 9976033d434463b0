"""Columns that are costly to compute and used more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A predicate on a plain computed column is pushed below it and repeats the
    computation, once per use. It cannot be pushed through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def distinct_for_join(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-NULL values of a column, for the right side of a semi or anti join.

    Adaptive execution splits a heavy key of the left side only if both sides of
    the join come straight from a shuffle. Distinct values are already placed by
    key, so the join would take them as they are; as a new column they are
    shuffled once more, which is cheap next to the rows they filter.
    """
    values = df.filter(F.col(column).isNotNull()).select(column).distinct()
    return computed_once(values, name, F.col(column)).select(name)
