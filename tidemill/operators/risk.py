"""Session-risk report: flagged sessions, their amounts, places and risk factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import list_literal_to_array, money_to_decimal
from tidemill.operators.computed import distinct_for_join

# A session is flagged above HIGH, of medium risk above MEDIUM.
HIGH = 80
MEDIUM = 50
LIST_COLUMNS = ["RISK_FACTORS", "COUNTRY", "GEO_IP_STATE"]


def clean_sessions(raw: DataFrame) -> DataFrame:
    """Typed sessions from their text form; unreadable lists and amounts become NULL."""
    columns = {c: list_literal_to_array(F.col(c)) for c in LIST_COLUMNS}
    columns["THREAT_INDICATORS"] = F.try_parse_json("THREAT_INDICATORS")
    columns["STARTTIME"] = F.col("STARTTIME").cast("timestamp")
    columns["TOTAL_AMOUNT"] = money_to_decimal(F.col("TOTAL_AMOUNT"))
    return raw.withColumns(columns)


def flagged_sessions(df: DataFrame) -> DataFrame:
    """Distinct ids with a score above the limit, and the amount over all their rows.

    Rows are reduced to one per id before the score is tested, so an id with very
    many rows needs neither a join nor a heavy task. Rows of a flagged id below
    the limit count towards its amount.
    """
    per_id = df.groupBy("CSID").agg(
        F.max("ATO_SCORE").alias("score"),
        F.coalesce(F.sum("TOTAL_AMOUNT"), F.lit(0)).alias("amount"),
        F.count(F.lit(1)).alias("n"),
    )
    return per_id.filter((F.col("score") > HIGH) & F.col("CSID").isNotNull())


def rows_of_flagged(df: DataFrame) -> DataFrame:
    """All rows of flagged ids (semi join on the distinct ids)."""
    ids = distinct_for_join(df.filter(F.col("ATO_SCORE") > HIGH), "CSID", "_id")
    return df.join(ids, F.col("CSID") == F.col("_id"), "left_semi")


def critical_ids(df: DataFrame, top: int = 5) -> DataFrame:
    """Ids among the ``top`` rows by score, each once: there may be fewer than ``top``."""
    best = df.filter(F.col("ATO_SCORE").isNotNull()).select("CSID", "ATO_SCORE")
    return (
        best.orderBy(F.desc("ATO_SCORE"), "CSID").limit(top)
        .groupBy("CSID").agg(F.max("ATO_SCORE").alias("ATO_SCORE"))
    )


def flagged_elements(df: DataFrame) -> DataFrame:
    """Distinct (kind, element) over flagged ids: countries and states lower-cased, factors."""
    kinds = F.array(
        _kind("country", F.transform("COUNTRY", F.lower)),
        _kind("state", F.transform("GEO_IP_STATE", F.lower)),
        _kind("factor", F.col("RISK_FACTORS")),
    )
    return (
        rows_of_flagged(df).select(F.explode(kinds).alias("k"))
        .select("k.kind", F.explode("k.elements").alias("element"))
        .distinct()
    )


def _kind(name: str, elements: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.struct(F.lit(name).alias("kind"), F.coalesce(elements, empty).alias("elements"))


def factor_frequency(df: DataFrame, factors: str = "RISK_FACTORS") -> DataFrame:
    """How often each risk factor occurs over all rows."""
    return (
        df.select(F.explode(factors).alias("factor"))
        .groupBy("factor").agg(F.count(F.lit(1)).alias("n"))
    )


def score_bands(df: DataFrame, score: str = "ATO_SCORE") -> DataFrame:
    """One row: rows above 80, in (50, 80], and at most 50; a NULL score is in none."""
    s = F.col(score)
    return df.agg(
        F.count_if(s > HIGH).alias("high_risk"),
        F.count_if((s > MEDIUM) & (s <= HIGH)).alias("medium_risk"),
        F.count_if(s <= MEDIUM).alias("low_risk"),
    )


def locations(country: Column, state: Column) -> Column:
    """Struct {countries, states}; a missing list is an empty one."""
    empty = F.array().cast("array<string>")
    return F.struct(
        F.coalesce(country, empty).alias("countries"), F.coalesce(state, empty).alias("states")
    )


def report_lines(df: DataFrame) -> DataFrame:
    """The report as rows (section, item, amount): any number of items, nothing gathered.

    Sections: flagged (item = number of ids, amount = their total), critical ids
    with their score, and the distinct country, state and factor elements.
    """
    totals = flagged_sessions(df).agg(
        F.count(F.lit(1)).cast("string").alias("item"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("amount"),
    )
    top = critical_ids(df).select(
        F.lit("critical").alias("section"),
        F.col("CSID").cast("string").alias("item"),
        F.col("ATO_SCORE").cast("double").alias("amount"),
    )
    elements = flagged_elements(df).select(
        F.col("kind").alias("section"), F.col("element").alias("item"),
        F.lit(None).cast("double").alias("amount"),
    )
    return totals.select(F.lit("flagged").alias("section"), "item", "amount").unionByName(
        top
    ).unionByName(elements)


def report_sections(lines: DataFrame, block: int = 100) -> DataFrame:
    """The report's items as text: a row per section and block of so many items, by name.

    Every item of every section is in one of its blocks; ``amount`` is set for sections that have
    one. Items are distinct elements, which are numbered per section.
    """
    number = F.expr(f"(row_number() over (partition by section order by item) - 1) div {block}")
    return (
        lines.select("section", "item", "amount", number.alias("block")).groupBy("section", "block").agg(
            F.count("item").alias("n_items"),
            F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("items"),
            F.sum("amount").alias("amount"),
        )
    )
