"""File, connector and topic writers."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.schema import fill_void


def write_csv(df: DataFrame, path: str, null_value: str | None = None) -> None:
    """CSV with header, one file per task: gathering rows into one file is up to the caller."""
    writer = df.write.mode("overwrite").option("header", True)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string; columns without a type become string NULLs."""
    typed = fill_void(df)
    return typed.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in typed.columns])


def can_be_text(kind: T.DataType) -> bool:
    """Whether the type has a text form worth exporting."""
    return isinstance(kind, T.AtomicType | T.NullType) and not isinstance(kind, T.BinaryType)


def safe_export(df: DataFrame, path: str, core: list[str] | None = None) -> str:
    """Write in the richest form the types allow, and return where.

    All-text CSV at ``path`` if every column has a text form; otherwise Parquet
    at ``path_parquet``; if ``core`` is given and Parquet cannot hold a column,
    the core columns as CSV at ``path_core``. The form is chosen from the schema
    before any job runs.
    """
    kinds = [f.dataType for f in df.schema.fields]
    if all(can_be_text(k) for k in kinds):
        write_csv(as_text(df), path, null_value="")
        return path
    unsupported = (T.CalendarIntervalType,)
    if core is None or not any(isinstance(k, unsupported) for k in kinds):
        write_parquet(fill_void(df), f"{path}_parquet")
        return f"{path}_parquet"
    present = [c for c in core if c in df.columns]
    write_csv(as_text(df.select(*present)), f"{path}_core", null_value="")
    return f"{path}_core"


def write_connector(
    df: DataFrame, name: str, renames: dict[str, str] | None = None, most: int | None = None,
    mode: str = "overwrite", **options: str,
) -> None:
    """Write to any data source by name, after optional renames and a row limit."""
    _prepared(df, renames, most).write.format(name).options(**options).mode(mode).save()


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    renames: dict[str, str] | None = None, most: int | None = None, mode: str = "overwrite",
) -> None:
    _prepared(df, renames, most).write.jdbc(url, table, mode=mode, properties=properties or {})


def _prepared(df: DataFrame, renames: dict[str, str] | None, most: int | None) -> DataFrame:
    df = df.withColumnsRenamed(renames or {})
    return df if most is None else df.limit(most)


def with_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and the number of its rows (``["n"]``) once an action has run on it.

    Saves a counting job of its own. For display: a retried task may count again.
    """
    counted = Observation()
    return df.observe(counted, F.count(F.lit(1)).alias("n")), counted


def topic_rows(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """(key, value) text columns, as topic sinks expect them."""
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def write_topic(df: DataFrame, name: str = "kafka", **options: str) -> None:
    df.select("key", "value").write.format(name).options(**options).mode("append").save()


def json_rows(df: DataFrame, column: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


@dataclass
class Folder:
    """The few file-system calls commits need, through Spark's own Hadoop client.

    Works on any storage the cluster is set up for.
    """

    spark: SparkSession
    path: str

    def __post_init__(self):
        hadoop = self.spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write_new(self, name: str, record: dict) -> bool:
        """Write JSON under the name by a rename; False if the name is taken.

        Two writers cannot both succeed where the storage's rename is atomic.
        """
        hidden = f"{name}.{uuid.uuid4().hex}.writing"
        stream = self._fs.create(self._at(hidden), True)
        try:
            stream.write(bytearray(json.dumps(record).encode("utf-8")))
        finally:
            stream.close()
        if self.exists(name) or not self._fs.rename(self._at(hidden), self._at(name)):
            self.delete(hidden)
            return False
        return True

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
