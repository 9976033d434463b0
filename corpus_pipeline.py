"""The corpus pipeline: documents to packed sequences, in stages that are written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import cotraining, mixing, near_dup, quality_rules, small_batches
from tidemill.llm.packing import pack_documents
from tidemill.session import written

# Rows of an Arrow batch: all stages run in the same Python workers, which keep what they once took.
BATCH = 300


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject.

    Null, empty and very long texts are scored whole like any other; equal texts get equal scores,
    so that repeated rows stay or go together. Without usable labels nothing is rejected. An empty
    table stays empty; further columns, whatever their names, come through as they are.
    """
    labels = small_batches(spark, BATCH).read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.classify(docs, labels, docs.columns).where("kept").select("row.*")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source.

    Null and empty texts have no words and go; very long ones are measured whole. A null language
    or source is a group of its own. Repeated rows get the same verdict; a rate at its limit stays.
    An empty table stays empty; further columns come through as they are.
    """
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Null and empty texts are near nothing and stay, as do rows with a null id. Of several rows with
    the id that stays, the one with the smallest md5 of its columns does. Very long texts are compared
    by their full sets. An empty table stays empty; further columns come through as they are.
    """
    small_batches(spark, BATCH)
    return near_dup.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or, to bring its source up, again; no source over 1.25 times as often.

    Null and empty texts cost no tokens and are taken like the rest of their source; a null source is
    a source. Equal rows are taken alike. An empty table stays empty; further columns come through.
    """
    return mixing.mix(docs, repetition=1.25)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens.

    A null or empty text is its end id alone; a very long one fills sequences of its own. Rows with
    null or repeated ids are documents of their own. An empty table gives no pieces; further
    columns are left out.
    """
    small_batches(spark, BATCH)
    pieces = pack_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), "white", end_id=2, capacity=4096,
        cached_chars=1_500_000,
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_filter),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

# The classifier is trained, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
