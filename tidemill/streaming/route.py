"""Records to documents by type: good ones to tables, bad ones to the dead letters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.json import (
    TYPE_FIELD,
    dead_letter_body,
    document_type,
    elements,
    is_valid_type,
)
from tidemill.operators.computed import computed_once
from tidemill.operators.dedupe import keep_changes, latest_per_key
from tidemill.sinks.files import Folder

NOT_JSON = "value is not valid JSON"
BAD_TYPE = "invalid document type"
_LOGGED = ["alias", "doc_id", "document", "topic", "partition", "offset", "pos"]
DOCUMENT_SCHEMA = (
    "alias string, doc_id string, document string, topic string, partition int, offset bigint"
)


def parsed(records: DataFrame, field_name: str = TYPE_FIELD) -> DataFrame:
    """Add ``docs`` (structs {kind, document}) and ``error`` (NULL if all is well)."""
    read = computed_once(records, "_json", F.try_parse_json("value"))
    split = F.transform(
        elements(F.col("_json")),
        lambda d: F.struct(
            document_type(d, field_name).alias("kind"), F.to_json(d).alias("document")
        ),
    )
    bad = F.filter("docs", lambda d: ~is_valid_type(d.kind))
    error = F.when(F.col("docs").isNull(), F.lit(NOT_JSON)).when(
        F.size(bad) > 0, F.concat(F.lit(f"{BAD_TYPE}: "), F.get(bad, 0).kind)
    )
    return computed_once(read, "docs", split).withColumn("error", error).drop("_json")


def good_documents(split: DataFrame, prefix: str) -> DataFrame:
    """One row per valid document with its alias ``prefix + type`` and a stable id.

    Valid documents of a record with a bad one are kept, as a bulk write would.
    """
    place = F.concat_ws(":", "topic", "partition", "offset", "pos")
    return (
        split.select("topic", "partition", "offset", "key", F.posexplode("docs"))
        .filter(is_valid_type(F.col("col.kind")))
        .select(
            F.concat(F.lit(prefix), F.col("col.kind")).alias("alias"),
            F.sha2(place, 256).alias("doc_id"),
            F.col("col.document").alias("document"),
            "topic", "partition", "offset", "pos", "key",
        )
    )


def dead_letters(split: DataFrame) -> DataFrame:
    """One letter per record with an error: its position, key and JSON body."""
    body = dead_letter_body(
        F.col("value"), F.col("error"),
        topic=F.col("topic"), partition=F.col("partition"), offset=F.col("offset"),
    )
    return split.filter(F.col("error").isNotNull()).select(
        "topic", "partition", "offset", "key", body.alias("value")
    )


def failed_records(records: DataFrame, error: str) -> DataFrame:
    """Dead letters for all records of a batch that could not be written."""
    return dead_letters(records.withColumn("error", F.lit(error)))


def item_letters(records: DataFrame, failed: DataFrame) -> DataFrame:
    """Dead letters for records of which a document was not written, with the first error.

    Records that have a letter for an error of their own get no second one.
    """
    place = ["topic", "partition", "offset"]
    errors = failed.groupBy(*place).agg(F.min("error").alias("item_error"))
    whole = records.where(F.col("error").isNull()).join(errors, place)
    return dead_letters(whole.withColumn("error", F.col("item_error")))


@dataclass
class RouteSink:
    """foreachBatch sink that writes documents and dead letters of a batch.

    Everything of batch N goes to folders named by N that are overwritten, so a
    batch that is run again after a failure leaves no duplicates, and what it ends
    with is the whole truth: a record is in the documents or the letters. ``on_error``
    says what happens to bad records: ``dlq``, ``skip`` or ``fail``. With
    ``letters_for_failed_batches`` a failing document write turns all records
    of the batch into dead letters; otherwise it raises and the batch is retried.
    ``last_counts`` is (batch, good records, bad records) of the last batch written.
    """

    spark: SparkSession
    path: str
    prefix: str
    on_error: str = "dlq"
    type_field: str = TYPE_FIELD
    letters_for_failed_batches: bool = False
    last_counts: tuple[int, int, int] | None = None

    def __post_init__(self):
        if self.on_error not in ("dlq", "skip", "fail"):
            raise ValueError(f"unknown policy {self.on_error!r}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        split = parsed(batch, self.type_field).persist()
        try:
            totals = split.agg(
                F.count_if(F.col("error").isNull()).alias("good"),
                F.count_if(F.col("error").isNotNull()).alias("bad"),
            ).first()
            if totals.good + totals.bad == 0:
                return
            if totals.bad and self.on_error == "fail":
                raise ValueError(f"{totals.bad} bad records in batch {batch_id}")
            letters = dead_letters(split)
            if self.on_error != "dlq":
                letters = letters.limit(0)
            try:
                failed = self.write_documents(good_documents(split, self.prefix), batch_id)
                if failed is not None:
                    letters = letters.unionByName(item_letters(split, failed))
            except Exception as cause:
                if not self.letters_for_failed_batches:
                    raise
                self.drop_documents(batch_id)
                letters = failed_records(split, f"batch processing failed: {cause}")
            # Written even if empty: an earlier attempt may have left other letters.
            letters.write.mode("overwrite").parquet(f"{self.path}/dlq/batch={batch_id}")
            self.last_counts = (batch_id, totals.good, totals.bad)
        finally:
            split.unpersist()

    def write_documents(self, documents: DataFrame, batch_id: int) -> DataFrame | None:
        """Append by alias; the id depends only on the record's position.

        A sink that can refuse single documents returns those it has not written: topic,
        partition, offset and error. Their records become dead letters, the others stay.
        """
        target = f"{self.path}/docs/batch={batch_id}"
        rows = documents.select("alias", "doc_id", "document", "topic", "partition", "offset")
        # Rebalancing keeps small types in one file and cuts a large one into several.
        rows.hint("rebalance", "alias").write.mode("overwrite").partitionBy("alias").parquet(target)
        return None

    def drop_documents(self, batch_id: int) -> None:
        Folder(self.spark, self.path).delete(f"docs/batch={batch_id}")

    def documents(self) -> DataFrame:
        return self._read("docs", f"{DOCUMENT_SCHEMA}, batch bigint")

    def letters(self) -> DataFrame:
        return self._read(
            "dlq", "topic string, partition int, offset bigint, key string, value string, batch bigint"
        )

    def _read(self, part: str, schema: str) -> DataFrame:
        if not Folder(self.spark, self.path).exists(part):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")


@dataclass
class MappedSink(RouteSink):
    """As `RouteSink`, with the declared types of fields by name, such as ``{"n": "bigint"}``.

    A document with a value that its field's type can't hold is refused alone: its record becomes
    a dead letter that names the first such field, the record's other documents stay. Fields that
    are absent or null fit every type, and so do fields without a declared one.
    """

    mapping: dict[str, str] = field(default_factory=dict)

    def write_documents(self, documents: DataFrame, batch_id: int) -> DataFrame:
        checked = computed_once(documents, "refused", self._misfit())
        super().write_documents(checked.where("refused is null"), batch_id)
        return checked.where("refused is not null").select(
            "topic", "partition", "offset", F.col("refused").alias("error")
        )

    def _misfit(self) -> Column:
        """The first declared field, in order, whose value doesn't fit; NULL if all do."""
        document = F.try_parse_json("document")

        def reason(name: str, kind: str) -> Column:
            path = f"$['{name}']"
            there = F.try_variant_get(document, path, "string").isNotNull()
            wrong = there & F.try_variant_get(document, path, kind).isNull()
            return F.when(wrong, F.lit(f"field {name} is no {kind}"))

        return F.coalesce(F.lit(None).cast("string"), *[reason(*one) for one in self.mapping.items()])


@dataclass
class UpsertSink(RouteSink):
    """As `RouteSink`, but the record key is the document id and the last write wins.

    A batch appends its accepted documents to a folder of its own, so it costs what the batch
    costs, however large the table is; `documents` finds the newest of each key.
    With ``changes_only`` a record that repeats its key's last value is not accepted: repeats
    within a batch are dropped before the write, those across batches on reading, so that
    the result doesn't depend on how the records fall into batches. After ``compact_every``
    batches the newest documents are written once as the base of the later ones.
    """

    changes_only: bool = False
    compact_every: int = 64
    offsets_per_piece: int = 1_000_000

    def write_documents(self, documents: DataFrame, batch_id: int) -> None:
        base = self._base()
        if batch_id <= base:
            return
        keyed = documents.withColumn(
            "doc_id", F.when(F.col("pos") == 0, F.coalesce("key", "doc_id")).otherwise(
                F.coalesce(F.concat_ws("#", "key", "pos"), F.col("doc_id"))
            )
        )
        accepted = self._changes(keyed) if self.changes_only else self._newest(keyed)
        accepted.select(*_LOGGED).write.mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")
        if batch_id - base >= self.compact_every:
            self.compact(batch_id)

    def drop_documents(self, batch_id: int) -> None:
        Folder(self.spark, self.path).delete(f"log/batch={batch_id}")

    def compact(self, batch_id: int) -> None:
        """Write the newest documents up to a batch as the new base; readers see it when whole."""
        self._resolved().select(*_LOGGED).write.mode("overwrite").parquet(f"{self.path}/base/upto={batch_id}")
        folder = Folder(self.spark, self.path)
        for name in folder.names("log"):
            if name.startswith("batch=") and int(name.split("=")[1]) <= batch_id:
                folder.delete(f"log/{name}")

    def _base(self) -> int:
        """The last batch in the base, -1 without one."""
        folder = Folder(self.spark, self.path)
        whole = [n for n in folder.names("base") if folder.exists(f"base/{n}/_SUCCESS")]
        return max((int(n.split("=")[1]) for n in whole), default=-1)

    def _logged(self) -> DataFrame:
        """Accepted documents: the base and all batches after it."""
        base, schema = self._base(), f"{DOCUMENT_SCHEMA}, pos int"
        rows = self.spark.createDataFrame([], schema)
        if Folder(self.spark, self.path).exists("log"):
            log = self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.path}/log")
            rows = log.where(F.col("batch") > base).select(*_LOGGED)
        if base >= 0:
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(f"{self.path}/base/upto={base}"))
        return rows

    def _newest(self, keyed: DataFrame) -> DataFrame:
        return latest_per_key(keyed, ["alias", "doc_id"], ["partition", "offset"], ["pos"])

    def _changes(self, keyed: DataFrame) -> DataFrame:
        """Documents that differ from the one before them."""
        piece: Column = F.struct("partition", F.floor(F.col("offset") / self.offsets_per_piece))
        return keep_changes(
            keyed, ["alias", "doc_id"], ["partition", "offset", "pos"], F.col("document"), piece
        )

    def _resolved(self) -> DataFrame:
        rows = self._logged()
        return self._newest(self._changes(rows) if self.changes_only else rows)

    def documents(self) -> DataFrame:
        return self._resolved().drop("pos")
