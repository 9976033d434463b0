"""Ledger jobs: balances per owner and the audit of the hash chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ledger import meets_difficulty

AMOUNTS = "array<struct<uuid:string,amount:decimal(18,2)>>"
BLOCK_SCHEMA = (
    "struct<header:struct<prev_hash:string,body_hash:string,difficulty:int,nonce:bigint>,"
    f"body:struct<txns:array<struct<inputs:{AMOUNTS},outputs:{AMOUNTS},timestamp:double>>>>"
)


def transactions(blocks: DataFrame, txns: str = "body.txns") -> DataFrame:
    return blocks.select(F.explode(txns).alias("t")).select("t.*")


def balances(txns: DataFrame, inputs: str = "inputs", outputs: str = "outputs") -> DataFrame:
    """Outputs received minus inputs spent, per owner."""
    signed = F.concat(
        F.transform(inputs, lambda a: F.struct(a.uuid.alias("owner"), (-a.amount).alias("amount"))),
        F.transform(outputs, lambda a: F.struct(a.uuid.alias("owner"), a.amount.alias("amount"))),
    )
    return (
        txns.select(F.explode(signed).alias("m")).select("m.owner", "m.amount")
        .groupBy("owner").agg(F.sum("amount").alias("balance"))
    )


def link_audit(blocks: DataFrame, height: str, digest: str, prev: str) -> DataFrame:
    """Each block with the real hash of its predecessor and whether the stored one agrees.

    The first block must store the empty text. A missing predecessor breaks the
    link. It is a join on the unique height, not one window over the whole chain.
    """
    parents = blocks.select(
        (F.col(height) + 1).alias("_h"), F.col(digest).alias("expected_prev")
    )
    joined = blocks.join(parents, F.col(height) == F.col("_h"), "left").drop("_h")
    first = blocks.agg(F.min(height)).scalar()
    expected = F.when(F.col(height) == first, F.lit("")).otherwise(F.col("expected_prev"))
    return joined.withColumn("expected_prev", expected).withColumn(
        "link_ok", F.coalesce(F.col(prev) == F.col("expected_prev"), F.lit(False))
    )


def hash_audit(blocks: DataFrame, stored: Column, computed: Column, difficulty: Column) -> DataFrame:
    """Add ``hash_ok``: the stored hash is the computed one and has the leading zeros."""
    ok = (stored == computed) & meets_difficulty(stored, difficulty)
    return blocks.withColumn("hash_ok", F.coalesce(ok, F.lit(False)))
