"""The text functions as SQL functions of a session, which Catalyst inlines into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemill.functions.clean import IPV4_PATTERN, MAC_PATTERN, NOT_A_MAC

# name(parameters) -> type and body; each gives what the column function of its name gives.
SQL_FUNCTIONS = {
    "ipv4_to_long(text STRING)": (
        "BIGINT",
        f"CASE WHEN text RLIKE r'{IPV4_PATTERN}' THEN"
        r" aggregate(split(text, r'\.'), 0L, (number, octet) -> number * 256 + try_cast(octet AS BIGINT)) END",
    ),
    "mac_to_long(text STRING)": (
        "BIGINT",
        f"CASE WHEN text RLIKE r'{MAC_PATTERN}' THEN"
        f" try_cast(conv(regexp_replace(text, '[-:]', ''), 16, 10) AS BIGINT) ELSE {NOT_A_MAC}L END",
    ),
    "hash64(text STRING)": ("BIGINT", "CASE WHEN text IS NOT NULL THEN xxhash64(text) END"),
    "hashed_user_id(text STRING)": (
        "BIGINT", "CASE WHEN length(trim(text)) > 0 THEN abs(xxhash64(text) % 100000000L) END",
    ),
    "money_to_decimal(text STRING)": (
        "DECIMAL(28, 2)", r"try_cast(regexp_replace(text, r'[^\d.]', '') AS DECIMAL(28, 2))",
    ),
    "iso_to_utc(text STRING)": ("TIMESTAMP_NTZ", "CAST(to_timestamp(text) AS TIMESTAMP_NTZ)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session, replacing those of the same names; returns the names."""
    for signature, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return [signature.partition("(")[0] for signature in SQL_FUNCTIONS]
