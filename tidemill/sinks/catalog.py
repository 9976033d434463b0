"""Versioned tables behind an alias: ``<prefix><type>_00001`` and the view ``<prefix><type>``."""

from __future__ import annotations

import re
import time
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemill.functions.json import VALID_TYPE_PATTERN


def check_type(kind: str | None) -> str:
    if not kind or not re.match(VALID_TYPE_PATTERN, kind):
        raise ValueError(f"invalid document type: {kind!r}")
    return kind


def table_name(kind: str | None) -> str:
    """The type as part of a table name: catalogs allow no dash, so it is spelled out."""
    return check_type(kind).replace("-", "_x2d_")


@lru_cache(maxsize=None)
def _ddl(schema: str) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields
    )


def ensure_single(spark: SparkSession, alias: str, prefix: str, schema: str) -> str:
    """One table behind one alias: create both if the alias is absent; return the alias.

    The table's name is unique: prefix, milliseconds and a random id. (Catalogs
    allow no dashes in names, so underscores join them.)
    """
    alias, prefix = table_name(alias), table_name(prefix)
    if not spark.catalog.tableExists(alias):
        table = f"{prefix}_{time.time_ns() // 1_000_000}_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE `{table}` ({_ddl(schema)}) USING parquet")
        spark.sql(f"CREATE VIEW `{alias}` AS SELECT * FROM `{table}`")
    return alias


class Aliases:
    """Creates and swaps versions; which version an alias uses is looked up once."""

    def __init__(self, spark: SparkSession, prefix: str, schema: str, root: str | None = None):
        self.spark, self.prefix, self.schema, self.root = spark, prefix, schema, root
        self._current: dict[str, str] = {}

    def alias(self, kind: str) -> str:
        return f"{self.prefix}{table_name(kind)}"

    def versions(self, kind: str) -> list[str]:
        pattern = re.compile(re.escape(self.alias(kind)) + r"_\d{5}$")
        names = (t.name for t in self.spark.catalog.listTables(pattern=f"{self.alias(kind)}_*"))
        return sorted(n for n in names if pattern.match(n))

    def ensure(self, kind: str) -> str:
        """Create version 1 and the alias if there is none; return the table to write to."""
        if kind not in self._current:
            versions = self.versions(kind)
            table = versions[-1] if versions else self._create(kind, 1)
            if not self.spark.catalog.tableExists(self.alias(kind)):
                self._point(kind, table)
            self._current[kind] = table
        return self._current[kind]

    def roll_over(self, kind: str) -> str:
        """Create the next version and move the alias to it."""
        number = int(self.ensure(kind)[-5:]) + 1
        table = self._create(kind, number)
        self._point(kind, table)
        self._current[kind] = table
        return table

    def _create(self, kind: str, number: int) -> str:
        table = f"{self.alias(kind)}_{number:05d}"
        where = f" LOCATION '{self.root}/{table}'" if self.root else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{table}` ({_ddl(self.schema)}) USING parquet{where}"
        )
        return table

    def _point(self, kind: str, table: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.alias(kind)}` AS SELECT * FROM `{table}`")
