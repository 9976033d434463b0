"""Profile of a table inventory (row count per table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INVENTORY_SCHEMA = "Count bigint, TableName string"


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Inventory of the given tables; each count is its own distributed aggregate."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("Count")).withColumn("TableName", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).select("Count", "TableName")


def profile(inventory: DataFrame) -> DataFrame:
    """Row share per table and whether it is empty.

    One window over the inventory: a row per table, not the tables' rows.
    """
    total = F.sum("Count").over(Window.partitionBy())
    return inventory.select(
        "TableName", "Count",
        F.try_divide(F.col("Count"), total).alias("share"),
        (F.col("Count") == 0).alias("is_empty"),
    )


def summary(inventory: DataFrame) -> DataFrame:
    """One row: tables, empty tables, rows in total, rows of the largest table."""
    return inventory.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("Count") == 0).alias("empty_tables"),
        F.sum("Count").alias("total_rows"),
        F.max("Count").alias("largest"),
    )


def largest(inventory: DataFrame, top: int = 10) -> DataFrame:
    return inventory.orderBy(F.desc("Count"), "TableName").limit(top)
