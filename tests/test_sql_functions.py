"""The SQL functions give what the column functions of their names give."""

import pytest
from pyspark.sql import functions as F

from tidemill.functions import clean
from tidemill.functions.sql import SQL_FUNCTIONS, register_functions

TEXTS = [
    None, "", "  ", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4.5", "1.2.3.4 ",
    "00:1a:2b:3c:4d:5e", "00-1A-2B-3C-4D-5E", "00:1a-2b:3c:4d:5e", "ff:ff:ff:ff:ff:ff", "gg:1a:2b:3c:4d:5e",
    "$1,234.50", "-12.345", "1.2.3,4", "n/a", "O'Hara", "a\\b", "é", "9" * 40,
]


@pytest.mark.parametrize("name", [s.partition("(")[0] for s in SQL_FUNCTIONS if not s.startswith("iso")])
def test_same_as_the_column_function(spark, name):
    register_functions(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = df.select("text", F.expr(f"{name}(text)").alias("got"), getattr(clean, name)(F.col("text")).alias("want"))
    assert got.schema["got"].dataType == got.schema["want"].dataType
    assert [r.text for r in got.collect() if r.got != r.want] == []


def test_times(spark):
    register_functions(spark)
    df = spark.createDataFrame([("2024-01-02T03:04:05+02:00",), ("2024-01-02 03:04:05",), (None,)], "text string")
    rows = df.select(F.expr("iso_to_utc(text)").alias("got"), clean.iso_to_utc(F.col("text")).alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]


def test_usable_in_filters_groups_and_twice(spark):
    assert register_functions(spark) == register_functions(spark)
    df = spark.createDataFrame([("10.0.0.1",), ("10.0.0.1",), ("x",)], "text string")
    rows = spark.sql(
        "select ipv4_to_long(text) as ip, count(*) as n from {t} where ipv4_to_long(text) > 0 group by ipv4_to_long(text)",
        t=df,
    ).collect()
    assert [tuple(r) for r in rows] == [(167772161, 2)]


def test_nothing_runs_in_python(spark):
    register_functions(spark)
    plan = spark.range(3).selectExpr("mac_to_long(cast(id as string))")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
