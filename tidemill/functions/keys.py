"""Key formatting and the cluster key-slot functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key-slot scheme.
SLOT_COUNT = 16384
KEY_FORMAT = "evt_%07d"


def event_key(number: Column, pattern: str = KEY_FORMAT) -> Column:
    return F.format_string(pattern, number)


def hash_tag(key: Column) -> Column:
    """Text inside the first ``{...}``; the whole key if that is empty or unclosed."""
    tag = F.regexp_extract(key, r"^[^{]*\{([^}]+)\}", 1)
    return F.when(tag != "", tag).otherwise(key)


def crc16(text: Column) -> Column:
    """CRC-16/XMODEM (polynomial 0x1021, start 0) of the UTF-8 bytes.

    The bytes are read back as Latin-1, which gives one character per byte. One
    fold over them; each step handles the eight bits at once.
    """
    characters = F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), "")

    def step(crc: Column, character: Column) -> Column:
        mixed = F.shiftright(crc, 8).bitwiseXOR(F.ascii(character))
        mixed = mixed.bitwiseXOR(F.shiftright(mixed, 4))
        return (
            F.shiftleft(crc, 8)
            .bitwiseXOR(F.shiftleft(mixed, 12))
            .bitwiseXOR(F.shiftleft(mixed, 5))
            .bitwiseXOR(mixed)
            .bitwiseAND(F.lit(0xFFFF))
        )

    return F.when(text == "", 0).otherwise(F.aggregate(characters, F.lit(0), step))


def key_slot(key: Column) -> Column:
    """Slot 0..16383 of a key; keys with the same tag share a slot."""
    return crc16(hash_tag(key)) % F.lit(SLOT_COUNT)


def slot_to_shard(slot: Column, shards: int) -> Column:
    """Shard that holds a slot when slots are spread evenly in order."""
    return F.shiftright(slot.cast("bigint") * shards, 14).cast("int")


def index_name(prefix: str, kind: Column, number: int | Column = 1) -> Column:
    """Physical name of the n-th version behind the alias ``prefix + kind``."""
    number = F.lit(number) if isinstance(number, int) else number
    return F.format_string("%s%s_%05d", F.lit(prefix), kind, number)
