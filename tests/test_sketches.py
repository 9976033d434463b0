"""Sketches by day, united over ranges, against exact results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import sketches

START = datetime(2024, 1, 1)


def _rows(spark, n=6000, days=6):
    """Two thirds of the rows are of one group."""
    return spark.createDataFrame(
        [
            (START + timedelta(days=i % days, seconds=i), "hot" if i // days % 3 else "cold", float(i * 7919 % n), i % 500)
            for i in range(n)
        ],
        "at timestamp, kind string, value double, user long",
    )


def _sketched(df, **settings):
    return sketches.window_sketches(df, "at", ["kind"], "value", "user", **settings)


def test_days_united_equal_all_rows(spark, folder):
    df = _rows(spark)
    sketches.store_days(_sketched(df), folder)
    kept = sketches.stored(spark, folder)
    assert kept.count() == 12
    for first, last in ((1, 6), (2, 4), (3, 3)):
        days = F.dayofmonth("day").between(first, last)
        rows = df.where(F.dayofmonth("at").between(first, last))
        got = {
            r.kind: r
            for r in sketches.merged(kept.where(days), ["kind"]).select(
                "kind", sketches.count().alias("n"), sketches.quantile(0.9).alias("p90"),
                sketches.share_up_to(1500.0).alias("share"), sketches.distinct().alias("users"),
            ).collect()
        }
        for r in rows.groupBy("kind").agg(
            F.count("value").alias("n"), F.collect_list("value").alias("values"), F.countDistinct("user").alias("users")
        ).collect():
            about = got[r.kind]
            assert about.n == r.n
            assert sum(v <= about.p90 for v in r["values"]) / r.n == pytest.approx(0.9, abs=0.01)
            assert about.share == pytest.approx(sum(v <= 1500 for v in r["values"]) / r.n, abs=0.01)
            assert about.users == pytest.approx(r.users, rel=0.033)


def test_a_run_again_replaces_its_days_only(spark, folder):
    df = _rows(spark)
    sketches.store_days(_sketched(df), folder)
    sketches.store_days(_sketched(df.where(F.dayofmonth("at") >= 5)), folder)
    n = sketches.merged(sketches.stored(spark, folder), []).select(sketches.count().alias("n")).first().n
    assert n == 6000


def test_nulls_and_nan_take_no_part(spark):
    df = spark.createDataFrame(
        [
            (START, "a", None, None), (START, "a", float("nan"), 1), (START, None, 3.0, None),
            (None, "b", 4.0, 2), (START, "c", 5.0, 7), (START, "c", 5.0, 7),
        ],
        "at timestamp, kind string, value double, user long",
    )
    rows = _sketched(df, window="hour").select(
        "window_start", "kind", sketches.count().alias("n"), sketches.quantile(0.5).alias("median"),
        sketches.share_up_to(9.0).alias("share"), sketches.distinct().alias("users"),
    ).collect()
    got = {(r.window_start, r.kind): (r.n, r.median, r.share, r.users) for r in rows}
    assert got == {
        (START, "a"): (0, None, None, 1), (START, None): (1, 3.0, 1.0, 0),
        (None, "b"): (1, 4.0, 1.0, 1), (START, "c"): (2, 5.0, 1.0, 1),
    }


def test_no_rows_give_no_sketches(spark):
    assert _sketched(_rows(spark).limit(0)).count() == 0


def test_a_range_reads_its_days_only(spark, folder):
    sketches.store_days(_sketched(_rows(spark)), folder)
    days = sketches.stored(spark, folder).where("day = date '2024-01-03'")
    assert all("day=2024-01-03" in f for f in days.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert "PartitionFilters: [isnotnull(day" in days._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
