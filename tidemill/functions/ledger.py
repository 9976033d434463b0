"""Record hashing for the block ledger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(record: Column) -> Column:
    """SHA-256 (hex) of a struct in its canonical JSON form.

    Canonical here is Spark's JSON text with all fields, in schema order.
    """
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)


def meets_difficulty(digest: Column, difficulty: Column) -> Column:
    """True if the hex digest starts with that many zeros."""
    return F.startswith(digest, F.repeat(F.lit("0"), difficulty))
