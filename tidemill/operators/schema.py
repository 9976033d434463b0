"""Column naming, validation and conforming to a declared schema."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import nan_to_null

_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_$#]*$")


class DataValidationError(ValueError):
    """The data or the settings do not match the target."""


def check_identifier(name: str) -> str:
    if not _IDENTIFIER.match(name):
        raise DataValidationError(f"not a plain identifier: {name!r}")
    return name


def check_table_name(name: str) -> str:
    """``table`` or ``schema.table`` of plain identifiers."""
    parts = name.split(".")
    if len(parts) > 2 or not all(_IDENTIFIER.match(part) for part in parts):
        raise DataValidationError(f"not a plain table name: {name!r}")
    return name


def map_column_names(
    df: DataFrame, renames: dict[str, str] | None = None, uppercase: bool = True
) -> DataFrame:
    """Strip ``table.`` prefixes, rename, optionally upper-case; duplicates raise.

    A rename is looked up under the name as it is, then lower, then upper case.
    """
    renames = renames or {}
    names = []
    for column in df.columns:
        plain = column.split(".")[-1].strip()
        name = (
            renames.get(plain) or renames.get(plain.lower()) or renames.get(plain.upper()) or plain
        )
        names.append(name.upper() if uppercase else name)
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise DataValidationError(f"duplicate columns after mapping: {repeated}")
    return df.toDF(*names)


def require_columns(have: Iterable[str], need: Iterable[str], what: str) -> None:
    present = {name.upper() for name in have}
    missing = sorted(name for name in need if name.upper() not in present)
    if missing:
        raise DataValidationError(f"{what} is missing columns: {missing}")


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in load order; raises if one is missing."""
    require_columns(df.columns, columns, "input")
    return df.select(*columns)


def normalise_created(df: DataFrame, column: str) -> DataFrame:
    """Created time as UTC without zone. Text is parsed and raises if it is no time."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return df
    return df.withColumn(column, F.col(column).cast("timestamp").cast("timestamp_ntz"))


def clear_nans(df: DataFrame) -> DataFrame:
    floats = (T.FloatType, T.DoubleType)
    return df.select(
        *[
            nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, floats)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, in its order and types; absent ones are typed NULLs."""
    present = {name.lower(): name for name in df.columns}
    columns = []
    for field in target.fields:
        source = present.get(field.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def fill_void(df: DataFrame, replacement: str = "string") -> DataFrame:
    """Give columns without a type (bare NULLs) one, so that every format can write them."""
    return df.select(
        *[
            F.lit(None).cast(replacement).alias(f.name)
            if isinstance(f.dataType, T.NullType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def add_run_columns(df: DataFrame, run_id: int) -> DataFrame:
    """Load time, run number and the per-event count columns."""
    return df.withColumns(
        {
            "loadTs": F.current_timestamp(),
            "biRunId": F.lit(run_id).cast("bigint"),
            "numBidRequests": (F.coalesce(F.col("eventTypeId") == 102, F.lit(False))).cast("int"),
            "numEvents": F.lit(1),
        }
    )


def preflight(spark: SparkSession, table: str, columns: Iterable[str]) -> None:
    """Raise if the table is absent, or if it lacks one of the columns."""
    check_table_name(table)
    if not spark.catalog.tableExists(table):
        raise DataValidationError(f"table not found: {table}")
    require_columns(spark.table(table).columns, columns, table)
