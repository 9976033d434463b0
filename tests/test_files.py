import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import clean
from tidemill.session import shared_folder
from tidemill.sinks import files, keyed
from tidemill.sinks.catalog import Aliases, ensure_single
from tidemill.sinks.snapshot import SnapshotTable
from tidemill.sources import delimited, tables

FIELDS = [
    delimited.RawField("id", "bigint"), delimited.RawField("ip", compute=clean.ipv4_to_long),
    delimited.RawField("name"), delimited.RawField("day", "date")]


def test_bulk_load(spark, folder):
    lines = ["1\t1.2.3.4\tann\t2026-01-02", "2\tx", "3\t\t\t", "x\t1.2.3.4\tbob\t2026-01-02",
             "4\t\tc\tnot a day", "5\t\td\t2026-01-02\tsurplus"]
    with gzip.open(f"{folder}/in.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    rows, rejects = delimited.bulk_load(spark, folder, FIELDS)
    got = {r.id: (r.ip, r.name, str(r.day)) for r in rows.collect()}
    assert got == {1: (16909060, "ann", "2026-01-02"), 2: (None, None, "None"), 3: (None, None, "None")}
    assert {r.reject_reason for r in rejects.collect()} == {"bad id", "bad day", "surplus fields"}
    assert {r.line for r in rejects.collect()} == set(lines[3:])
    assert all(r.loadTs.microsecond == 0 for r in rows.collect())


def test_positional_names(spark, folder):
    with open(f"{folder}/a.tsv", "w") as f:
        f.write("1\ta\t2.5\n2\t\"b\t3.5\n")
    inferred = delimited.name_by_position(delimited.read_delimited_inferred(spark, f"{folder}/a.tsv"), ["x", "y"])
    assert inferred.columns == ["x", "y", "extra_2"]
    declared = delimited.read_delimited(spark, f"{folder}/a.tsv", T.StructType.fromDDL("x int, y string, z double"))
    assert [tuple(r) for r in declared.orderBy("x").collect()] == [(1, "a", 2.5), (2, '"b', 3.5)]
    files.write_csv(declared, f"{folder}/out")
    back = delimited.read_with_header(spark, f"{folder}/out", declared.schema)
    assert back.count() == 2


def test_delimited_round_trip_of_odd_texts(spark, folder):
    texts = ["", None, 'say "hi"', "a\tb", "c\nd", "e\\", '\\"', " f ", "\\N x", '"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    delimited.write_delimited(df, f"{folder}/out")
    back = delimited.read_written(spark, f"{folder}/out", df.schema).collect()
    assert {r.i: r.t for r in back} == dict(enumerate(texts))


@pytest.mark.parametrize("sep", [".", "|", "\t", "||"])
def test_a_separator_is_plain_text(spark, sep):
    lines = spark.createDataFrame([(sep.join(["a", "b"]),)], "value string")
    fields = [delimited.RawField("x"), delimited.RawField("y")]
    assert tuple(delimited.accepted(delimited.parse_lines(lines, fields, sep)).first()) == ("a", "b")


def test_safe_export_chooses_by_type(spark, folder):
    plain = spark.sql("select 1 as a, null as v, date'2026-01-01' as d")
    assert files.safe_export(plain, f"{folder}/x") == f"{folder}/x"
    assert [tuple(r) for r in spark.read.option("header", True).csv(f"{folder}/x").collect()] == [
        ("1", None, "2026-01-01")]
    nested = spark.sql("select array(1) as a, 'k' as k, null as v")
    assert files.safe_export(nested, f"{folder}/y") == f"{folder}/y_parquet"
    assert spark.read.parquet(f"{folder}/y_parquet").first().k == "k"


def test_writers(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, value string")
    files.write_json(df, f"{folder}/j")
    files.write_parquet(df, f"{folder}/p", ["id"])
    assert spark.read.json(f"{folder}/j").count() == spark.read.parquet(f"{folder}/p").count() == 3
    files.write_connector(df, "parquet", {"value": "v"}, 2, path=f"{folder}/c")
    read = tables.read_connector(spark, "parquet", path=f"{folder}/c")
    assert read.columns == ["id", "v"] and read.count() == 2
    rows = files.topic_rows(df, F.col("id"), F.col("value"))
    assert rows.dtypes == [("key", "string"), ("value", "string")]
    files.write_topic(rows, "parquet", path=f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3
    back = tables.read_json_rows(files.json_rows(df), "value", df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_globs(spark, folder):
    df = spark.createDataFrame([("a:1",), ("a:22",), ("{b}:x",), ("c",)], "key string")
    globs = ["a:?", "a:*", "{b}:*", "none*"]
    counts = {r.pattern: r.deleted for r in keyed.count_by_glob(df, "key", globs).collect()}
    assert counts == {"a:?": 1, "a:*": 1, "{b}:*": 1, "none*": 0}
    assert [r.key for r in keyed.without_globs(df, "key", globs).collect()] == ["c"]
    table = SnapshotTable(spark, folder, "key string", ["key"], buckets=3)
    table.merge(df)
    assert keyed.delete_by_globs(table, "key", globs) == counts
    assert [r.key for r in table.read().collect()] == ["c"]


def test_aliases(spark, folder):
    aliases = Aliases(spark, "tst_", "id int, body string", f"{folder}/idx")
    assert aliases.ensure("widget") == "tst_widget_00001" == aliases.ensure("widget")
    spark.sql("insert into tst_widget_00001 values (1, 'a')")
    assert spark.table("tst_widget").count() == 1
    assert Aliases(spark, "tst_", "id int, body string").ensure("widget") == "tst_widget_00001"
    assert aliases.roll_over("widget") == "tst_widget_00002"
    assert spark.table("tst_widget").count() == 0 and aliases.versions("widget") == [
        "tst_widget_00001", "tst_widget_00002"]
    assert aliases.ensure("a-b") == "tst_a_x2d_b_00001"
    assert aliases.ensure("gadget") == "tst_gadget_00001"
    for bad in (None, "", "invalid/product", "Widget"):
        with pytest.raises(ValueError):
            aliases.ensure(bad)


def test_with_count(spark, folder):
    df, counted = files.with_count(spark.range(7))
    files.write_parquet(df, f"{folder}/n")
    assert counted.get["n"] == 7


def test_single_alias(spark):
    assert ensure_single(spark, "logs_alias", "logs", "id int") == "logs_alias"
    tables_ = [t.name for t in spark.catalog.listTables() if t.name.startswith("logs_1")]
    ensure_single(spark, "logs_alias", "logs", "id int")
    assert tables_ == [t.name for t in spark.catalog.listTables() if t.name.startswith("logs_1")]
    assert len(tables_) == 1 and spark.table("logs_alias").count() == 0


def test_shared_folder_is_the_named_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a.startswith(f"{root}/x-") and a != b
