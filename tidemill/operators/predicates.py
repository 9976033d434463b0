"""Row filters. Time filters compare the raw column, so they are pushed to the scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.computed import distinct_for_join


def utc_naive(moment: datetime) -> datetime:
    """The moment in UTC without its zone; naive input already means UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def time_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """Literal of the column's own time type, so that no cast lands on the column."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.lit(utc_naive(moment).date())
    naive = F.lit(utc_naive(moment).isoformat(sep=" ")).cast("timestamp_ntz")
    return naive if isinstance(kind, T.TimestampNTZType) else naive.cast("timestamp")


def half_open_window(df: DataFrame, column: str, lower: datetime, upper: datetime) -> Column:
    """[lower, upper): the increment window."""
    c = F.col(column)
    return (c >= time_literal(df, column, lower)) & (c < time_literal(df, column, upper))


def load_window(df: DataFrame, column: str, after: datetime, until: datetime) -> Column:
    """(after, until]: the load window."""
    c = F.col(column)
    return (c > time_literal(df, column, after)) & (c <= time_literal(df, column, until))


def date_floor(df: DataFrame, column: str, load_from: datetime, max_days_back: int = 30) -> Column:
    """Event date no older than the load date minus ``max_days_back`` days."""
    day: date = utc_naive(load_from).date() - timedelta(days=max_days_back)
    start = datetime(day.year, day.month, day.day)
    return F.col(column) >= time_literal(df, column, start)


def is_valid(column: str) -> Column:
    """Flag equal to 1; NULL does not pass."""
    return F.col(column) == 1


def one_of(column: str, values: Iterable | None) -> Column:
    """Column in the list; an empty or missing list leaves the filter out."""
    values = list(values or [])
    return F.col(column).isin(values) if values else F.lit(True)


def filter_existing(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Apply each condition only if the column it is about exists."""
    present = {name.lower() for name in df.columns}
    for name, condition in conditions.items():
        if name.lower() in present:
            df = df.filter(condition)
    return df


def exclude_listed(
    df: DataFrame, key: str, listed: DataFrame, listed_key: str, null_means: int = 0
) -> DataFrame:
    """Rows whose key is not listed; a NULL key counts as ``null_means``.

    NULLs in the list are ignored. No broadcast hint: the list is broadcast only
    when its size is under the session's threshold. Beyond that it is a sort
    merge anti join whose heavy keys adaptive execution splits.
    """
    unwanted = distinct_for_join(listed, listed_key, "_listed")
    on = F.coalesce(F.col(key), F.lit(null_means)) == F.col("_listed")
    return df.join(unwanted, on, "left_anti")
