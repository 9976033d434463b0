"""Table-like sources: increments, connectors, JDBC, JSON rows, key prefixes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.predicates import half_open_window


def read_increment(
    source: DataFrame,
    created: str,
    lower: datetime,
    upper: datetime,
    columns: list[str] | None = None,
    extra_where: str | None = None,
) -> DataFrame:
    """Rows with ``lower <= created < upper``; filters and columns reach the scan."""
    rows = source.filter(half_open_window(source, created, lower, upper))
    if extra_where:
        rows = rows.filter(F.expr(f"({extra_where})"))
    return rows.select(*columns) if columns else rows


def read_connector(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """Any data source by name, e.g. a warehouse connector with table or query options."""
    return spark.read.format(name).options(**options).load()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_by: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; give ``split_by`` and ``bounds`` so that it is read in parallel."""
    if split_by:
        return spark.read.jdbc(
            url, table, column=split_by, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=properties or {},
        )
    return spark.read.jdbc(url, table, properties=properties or {})


def read_json_rows(rows: DataFrame, column: str, schema: T.DataType | str) -> DataFrame:
    """Nested records stored as JSON text in a column."""
    return rows.select(F.from_json(F.col(column), schema).alias("record")).select("record.*")


def prefix_scan(
    df: DataFrame, key: str, prefix: str, tag: Column, wanted, measure: Column, floor: float
) -> DataFrame:
    """Rows whose key starts with ``prefix``, with the tag, and measure at least ``floor``.

    A missing measure counts as 0.
    """
    at_least = F.coalesce(measure, F.lit(0.0)) >= F.lit(floor)
    return df.filter(F.col(key).startswith(prefix) & (tag == F.lit(wanted)) & at_least)
