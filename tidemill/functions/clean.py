"""Column expressions that turn raw text into typed values.

Bad input gives NULL (or the stated sentinel) unless a function says it raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d{1,2})"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
MAC_PATTERN = r"^[0-9A-Fa-f]{2}([-:])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}$"
NOT_A_MAC = -1


def ipv4_to_long(text: Column) -> Column:
    """Dotted IPv4 text as a number 0..4294967295; NULL if it is not one."""
    octets = F.split(text, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(octets, F.lit(i)).try_cast("bigint")
    return F.when(text.rlike(IPV4_PATTERN), number)


def mac_to_long(text: Column) -> Column:
    """MAC text (six hex pairs, one separator throughout) as a number, else -1."""
    digits = F.regexp_replace(text, "[-:]", "")
    return F.when(
        text.rlike(MAC_PATTERN), F.conv(digits, 16, 10).try_cast("bigint")
    ).otherwise(F.lit(NOT_A_MAC).cast("bigint"))


def hash64(text: Column) -> Column:
    """Stable 64-bit hash of a text; NULL stays NULL."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def hashed_user_id(text: Column, digits: int = 8) -> Column:
    """Deterministic user number of at most ``digits`` digits; NULL for blank text.

    The remainder is taken before the absolute value, which gives the same
    number and cannot overflow for the smallest 64-bit hash.
    """
    present = F.length(F.trim(text)) > 0
    return F.when(present, F.abs(F.xxhash64(text) % F.lit(10**digits).cast("bigint")))


def money_to_decimal(text: Column, scale: int = 2) -> Column:
    """Money text such as ``$1,234.50`` as a decimal."""
    return F.regexp_replace(text, r"[^\d.]", "").try_cast(f"decimal(28,{scale})")


def list_literal_to_array(text: Column) -> Column:
    """List text such as ``['a', 'b']`` (either quote) as array<string>, else NULL."""
    bare = F.trim(text)
    looks_like_list = F.startswith(bare, F.lit("[")) & F.endswith(bare, F.lit("]"))
    # A bare None between the items is a missing one.
    bare_none = F.regexp_replace(bare, r"(?<=[\[,])\s*None\s*(?=[,\]])", "null")
    items = F.from_json(bare_none, "array<string>", {"allowSingleQuotes": "true"})
    return F.when(looks_like_list, items)


def int_list(text: Column) -> Column:
    """Comma separated integers as array<int>; raises on anything else."""
    return F.transform(F.split(text, ","), lambda item: item.cast("int"))


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text as naive UTC time; no zone means UTC. Raises on bad text."""
    return F.to_timestamp(text).cast("timestamp_ntz")


def nan_to_null(value: Column) -> Column:
    """NULL instead of NaN, for float and double columns."""
    return F.when(~F.isnan(value), value)


def sentinel_to_null(value: Column, sentinel) -> Column:
    """NULL where the value equals the sentinel that stands for 'missing'."""
    return F.nullif(value, F.lit(sentinel))


def minute_slice(ts: Column) -> Column:
    return F.date_trunc("minute", ts)
