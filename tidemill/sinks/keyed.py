"""Keyed records: pattern deletes and read-back checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.sinks.snapshot import SnapshotTable


def glob_pattern(glob: str) -> str:
    """Regular expression of a key glob: ``*`` any text, ``?`` one character, rest literal."""
    parts = {"*": ".*", "?": "."}
    return "^" + "".join(parts.get(c) or re.escape(c) for c in glob) + "$"


def matches_glob(key: Column, glob: str) -> Column:
    return key.rlike(f"(?s){glob_pattern(glob)}")


def count_by_glob(df: DataFrame, key: str, globs: list[str]) -> DataFrame:
    """Rows each pattern would delete, in list order: a key belongs to its first match."""
    first = F.lit(None).cast("int")
    for i, glob in reversed(list(enumerate(globs))):
        first = F.when(matches_glob(F.col(key), glob), F.lit(i)).otherwise(first)
    hits = df.select(first.alias("i")).filter(F.col("i").isNotNull()).groupBy("i").count()
    listed = df.sparkSession.createDataFrame(list(enumerate(globs)), "i int, pattern string")
    return listed.join(hits, "i", "left").select(
        "pattern", F.coalesce("count", F.lit(0)).alias("deleted")
    )


def without_globs(df: DataFrame, key: str, globs: list[str]) -> DataFrame:
    """Rows whose key matches none of the patterns."""
    return df.filter(~_matches_any(F.col(key), globs))


def _matches_any(key: Column, globs: list[str]) -> Column:
    hit = F.lit(False)
    for glob in globs:
        hit = hit | F.coalesce(matches_glob(key, glob), F.lit(False))
    return hit


def delete_by_globs(table: SnapshotTable, key: str, globs: list[str]) -> dict[str, int]:
    """Delete all matching keys in one rewrite; returns the deletions of each pattern."""
    counts = count_by_glob(table.read(), key, globs).collect()  # one row per pattern
    table.delete(_matches_any(F.col(key), globs))
    return {r.pattern: r.deleted for r in counts}
