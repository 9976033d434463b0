"""Delimited text: typed scans, positional naming, and the checked bulk load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.computed import computed_once


# One convention for writing and reading back: every text is quoted, quotes and backslashes
# are escaped, and an empty text differs from a missing one.
_QUOTED = {
    "quote": '"', "escape": "\\", "quoteAll": True, "emptyValue": "", "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t"
) -> DataFrame:
    """Header-less text with a declared schema and no quoting: a quote is a character like any."""
    return (
        spark.read.schema(schema).option("sep", sep).option("quote", "").option("escape", "").csv(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    """Header-less text that `read_written` reads back as it was, whatever the texts hold."""
    df.write.options(**_QUOTED).option("sep", sep).mode(mode).csv(path)


def read_written(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t"
) -> DataFrame:
    """Files of `write_delimited`. Texts may hold line feeds, so that a file is one task."""
    return spark.read.schema(schema).options(**_QUOTED).option("multiLine", True).option("sep", sep).csv(path)


def read_delimited_inferred(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Header-less text with inferred types; costs one extra pass over the files."""
    return spark.read.option("sep", sep).option("inferSchema", True).csv(path)


def read_with_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def name_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Give columns their names by position; surplus ones become ``extra_<position>``."""
    named = [names[i] if i < len(names) else f"extra_{i}" for i in range(len(df.columns))]
    return df.toDF(*named)


@dataclass(frozen=True)
class RawField:
    """One field of a text line, and the column computed from it.

    ``type`` is what the text must parse as. With ``compute`` the field is only
    raw input: the expression gives the column, and any text is acceptable.
    """

    name: str
    type: str = "string"
    compute: object = None  # Column -> Column

    def value(self, raw: Column) -> Column:
        if self.compute is not None:
            return self.compute(raw)
        return raw if self.type == "string" else raw.try_cast(self.type)

    def is_bad(self, raw: Column) -> Column:
        if self.compute is not None or self.type == "string":
            return F.lit(False)
        return raw.isNotNull() & raw.try_cast(self.type).isNull()


def parse_lines(
    lines: DataFrame, fields: list[RawField], sep: str = "\t", line: str = "value"
) -> DataFrame:
    """Add the parsed columns and ``reject_reason`` (NULL for good lines).

    Missing trailing fields and empty fields are NULL. A line is rejected for a
    field that does not parse or for surplus fields. Split the result with
    `accepted` and `rejected`: both read it in one pass each, no shuffle.
    """
    parts = F.split(F.col(line), f"\\Q{sep}\\E")
    raws = [F.nullif(F.get(F.col("_parts"), F.lit(i)), F.lit("")) for i in range(len(fields))]
    staged = computed_once(lines, "_parts", parts)
    reason = F.when(F.size("_parts") > len(fields), F.lit("surplus fields"))
    for field, raw in zip(fields, raws):
        if field.compute is None and field.type != "string":
            reason = reason.when(field.is_bad(raw), F.lit(f"bad {field.name}"))
    columns = [field.value(raw).alias(field.name) for field, raw in zip(fields, raws)]
    judged = computed_once(staged, "reject_reason", reason)
    return judged.select(F.col(line).alias("_line"), *columns, "reject_reason")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("_line", "reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        F.col("_line").alias("line"), "reject_reason"
    )


def bulk_load(
    spark: SparkSession, path: str, fields: list[RawField], sep: str = "\t"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of plain or compressed text files; rows get ``loadTs`` to the second."""
    parsed = parse_lines(spark.read.text(path), fields, sep)
    load_ts = F.date_trunc("second", F.current_timestamp())
    return accepted(parsed).withColumn("loadTs", load_ts), rejected(parsed)
