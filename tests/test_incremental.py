from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.dedupe import latest_per_key
from tidemill.operators.schema import DataValidationError
from tidemill.plans.incremental import IncrementalLoad, LoadSettings, compute_window, transform
from tidemill.sinks.snapshot import CommitConflict, SnapshotTable
from tidemill.sinks.stage import Stage


def make(job="job", **kw):
    schema = T.StructType([
        T.StructField("ID", T.LongType()), T.StructField("CREATED", T.TimestampNTZType()),
        T.StructField("NAME", T.StringType())])
    return LoadSettings(**{**dict(
        job=job, target=schema, keys=["ID"], created="created", target_created="CREATED",
        columns=["id", "created", "name"]), **kw})


def source(spark, rows):
    return spark.createDataFrame(rows, "id long, created timestamp_ntz, name string")


def state(load):
    return {(r.ID, r.NAME) for r in load.target.read().collect()}


T0 = datetime(2026, 5, 1, 12)


def test_transform_orders_columns_and_normalises_created(spark):
    df = spark.createDataFrame([(1, "2026-05-03T10:15:30Z", "alice")], "id int, created string, name string")
    out = transform(df.toDF("t.id", "t.created", "t.name"), make())
    assert out.columns == ["ID", "CREATED", "NAME"]
    assert out.first() == (1, datetime(2026, 5, 3, 10, 15, 30), "alice")


def test_transform_rejects(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, name string, ID2 int")
    with pytest.raises(DataValidationError, match="missing columns"):
        transform(df, make())
    both = spark.createDataFrame([(1, 2)], "id int, `t.id` int")
    with pytest.raises(DataValidationError, match="duplicate"):
        transform(both, make())
    bad = spark.createDataFrame([(1, "yesterday", "a")], "id int, created string, name string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        transform(bad, make()).collect()
    nan = spark.createDataFrame([(1, "2026-01-01", float("nan"))], "id int, created string, name double")
    assert transform(nan, make()).first().NAME is None


def test_settings_are_checked():
    for bad in (dict(keys=["NOPE"]), dict(created="a b"), dict(lookback_minutes=-1),
                dict(target_created="OTHER"), dict(keys=[])):
        with pytest.raises(DataValidationError):
            make(**bad)


def test_window():
    now = datetime(2026, 5, 2, 0, 10, tzinfo=timezone.utc)
    assert compute_window(make(), datetime(2026, 5, 1, 3), now) == (
        datetime(2026, 5, 1), datetime(2026, 5, 2))


def test_run_bounds_replay_and_watermark(spark, folder):
    load = IncrementalLoad(spark, make(lookback_minutes=60, buckets=4, initial_watermark=T0), folder)
    now = T0 + timedelta(hours=2, minutes=10)
    lower, upper = T0 - timedelta(hours=1), T0 + timedelta(hours=2)
    rows = [
        (1, lower, "on lower"), (2, upper, "on upper"), (3, lower - timedelta(seconds=1), "too old"),
        (4, T0, "old"), (4, T0 + timedelta(minutes=5), "new"),
        (5, T0, "tie a"), (5, T0, "tie b"),
    ]
    with pytest.raises(Exception, match="is NULL"):
        load.run(source(spark, [*rows, (None, T0, "null key")]), now)
    assert load.target.read().count() == 0
    result = load.run(source(spark, rows), now)
    assert (result.rows_read, result.rows_merged, result.skipped) == (5, 3, False)
    expected = {(1, "on lower"), (4, "new"), (5, "tie b")}
    assert state(load) == expected
    control = load.target.control().first()
    assert control.LAST_CREATED_TS == upper and control.LAST_ROWS_MERGED == 3
    # The same instant again: within the lookback, so rows are read again without effect.
    load.run(source(spark, rows), now)
    assert state(load) == expected
    # A run whose clock went back does not move the watermark back.
    load.run(source(spark, rows), now - timedelta(minutes=30))
    assert load.watermark() == upper
    skipped = load.run(source(spark, rows), now - timedelta(hours=5))
    assert skipped.skipped and state(load) == expected
    later = load.run(source(spark, [(2, upper, "on upper"), (1, upper, "changed")]), now + timedelta(hours=1))
    assert later.rows_merged == 2
    assert state(load) == expected - {(1, "on lower")} | {(2, "on upper"), (1, "changed")}


def test_preflight(spark, folder):
    load = IncrementalLoad(spark, make(buckets=2), folder)
    load.run(source(spark, [(1, T0, "a")]), T0 + timedelta(hours=1))
    empty = load.run(source(spark, [(2, T0 - timedelta(days=9), "z")]), T0 + timedelta(days=9))
    assert (empty.rows_read, empty.rows_merged, empty.skipped) == (0, 0, False)
    wider = make(buckets=2, target=T.StructType([*make().target.fields, T.StructField("MORE", T.LongType())]))
    with pytest.raises(DataValidationError, match="target table is missing columns"):
        IncrementalLoad(spark, wider, folder).preflight(source(spark, []))
    with pytest.raises(DataValidationError, match="source is missing columns"):
        load.preflight(source(spark, []).drop("created"))
    assert state(load) == {(1, "a")}


def test_failure_before_commit_changes_nothing(spark, folder, monkeypatch):
    load = IncrementalLoad(spark, make(buckets=2), folder)
    load.run(source(spark, [(1, T0, "a")]), T0 + timedelta(hours=1))
    before, mark = state(load), load.watermark()
    def fail(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_publish", fail)
        with pytest.raises(RuntimeError):
            load.run(source(spark, [(1, T0 + timedelta(hours=2), "b")]), T0 + timedelta(hours=3))
    assert (state(load), load.watermark()) == (before, mark)
    load.run(source(spark, [(1, T0 + timedelta(hours=2), "b")]), T0 + timedelta(hours=3))
    assert state(load) == {(1, "b")}


def test_dry_run_pushes_the_window_to_the_scan(spark, folder):
    path = f"{folder}/src"
    source(spark, [(1, T0, "a")]).write.parquet(path)
    load = IncrementalLoad(spark, make(extra_where="id > 0"), f"{folder}/load")
    lower, upper, plan = load.dry_run(spark.read.parquet(path), T0)
    assert upper == T0 - timedelta(minutes=10) and "created" in plan
    from tidemill.sources.tables import read_increment
    physical = read_increment(spark.read.parquet(path), "created", T0, T0 + timedelta(days=1), ["id"])
    text = physical._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created" in text and "LessThan(created" in text


def test_stage_purge_and_retention(spark, folder):
    stage = Stage(spark, folder, make().target)
    rows = source(spark, [(1, T0, "a")]).toDF("ID", "CREATED", "NAME")
    assert stage.append(rows.filter("false"), "a", "r0", T0) == 0
    assert stage.append(rows.limit(0), "a", "r0", T0) == 0
    assert stage.append(rows, "a", "r1", T0) == 1
    stage.append(rows, "a", "r2", T0 + timedelta(days=6))
    stage.append(rows, "b", "r1", T0)
    assert stage.retain("a", T0 + timedelta(days=8)) == ["r0", "r1"]
    assert (stage.runs("a"), stage.runs("b")) == (["r2"], ["r1"])
    assert stage.purge("a") == 1 and stage.runs("a") == [] and stage.runs("b") == ["r1"]
    assert set(stage.rows("b", "r1").columns) >= {"ETL_RUN_ID", "ETL_JOB_NAME", "ETL_LOADED_AT"}


def test_merge_rewrites_only_touched_buckets(spark, folder):
    table = SnapshotTable(spark, folder, "k long, v string", ["k"], buckets=16)
    table.merge(spark.range(1000).selectExpr("id as k", "'a' as v"))
    commit = table.merge(spark.createDataFrame([(5, "b")], "k long, v string"))
    assert [v.split("-")[0] for v in commit["buckets"].values()].count("2") == 1
    assert table.read().filter("v = 'b'").collect() == [(5, "b")]
    assert table.read().count() == 1000
    assert [r.v for r in table.lookup(spark.createDataFrame([(5,)], "k long")).collect()] == ["b"]
    assert [r.v for r in table.lookup(spark.createDataFrame([(5,)], "k int")).collect()] == ["b"]
    assert table.delete(F.col("k") < 10) == 10 and table.read().count() == 990
    assert table.delete(F.col("k") < 10) == 0


def test_bucket_by_key_range_localises_changes(spark, folder):
    def open_table(by):
        return SnapshotTable(spark, folder, "k long, v string", ["k"], bucket_by=by)

    table = open_table("k div 100")
    table.merge(spark.range(1000).selectExpr("id as k", "'a' as v"))
    new = spark.range(950, 1100).selectExpr("id as k", "'b' as v")
    with pytest.raises(Exception, match="is NULL"):
        table.merge(new.union(spark.createDataFrame([(None, "n")], "k long, v string")))
    commit = table.merge(new)
    assert {b for b, v in commit["buckets"].items() if v.startswith("2-")} == {"9", "10"}
    counts = {r.v: r["count"] for r in table.read().groupBy("v").count().collect()}
    assert counts == {"a": 950, "b": 150}
    with pytest.raises(ValueError, match="buckets by"):
        open_table("k div 7").read()


def test_concurrent_commit_is_refused(spark, folder):
    a, b = (SnapshotTable(spark, folder, "k long", ["k"], buckets=2) for _ in range(2))
    previous = a.last_commit()
    a.save_job("j", {})
    with pytest.raises(CommitConflict):
        b._publish(previous, {}, {})


def test_loser_of_a_race_leaves_the_winner_intact(spark, folder, monkeypatch):
    a, b = (SnapshotTable(spark, folder, "k long, v string", ["k"], buckets=2) for _ in range(2))
    one = lambda v: spark.createDataFrame([(1, v)], "k long, v string")
    a.merge(one("start"))
    stale = b.last_commit()
    a.merge(one("winner"))
    with monkeypatch.context() as m:
        m.setattr(b, "last_commit", lambda: stale)
        with pytest.raises(CommitConflict):
            b.merge(one("loser"))
    assert [r.v for r in a.read().collect()] == ["winner"]
    a.tidy()
    assert [r.v for r in a.read().collect()] == ["winner"]


def test_tidy_keeps_what_is_used(spark, folder):
    table = SnapshotTable(spark, folder, "k long, v int", ["k"], buckets=4, keep_commits=2)
    for i in range(6):
        table.merge(spark.createDataFrame([(1, i)], "k long, v int"))
    table.merge(spark.range(100).selectExpr("id as k", "7 as v"))
    table.tidy()
    assert table.read().count() == 100
    assert len(table._commit_names()) == 2 and len(table._data.names()) <= 2


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 99)), max_size=8), min_size=1, max_size=3))
def test_merge_equals_dictionary_update(spark, tmp_path_factory, batches):
    table = SnapshotTable(spark, str(tmp_path_factory.mktemp("t")), "k long, v long", ["k"], buckets=3)
    expected = {}
    for batch in batches:
        batch = list(dict(batch).items())
        expected.update(batch)
        table.merge(spark.createDataFrame(batch, "k long, v long"))
    assert dict(map(tuple, table.read().collect())) == expected


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 6), st.integers(0, 300), st.integers(0, 9)), min_size=1, max_size=25),
    st.lists(st.integers(0, 320), min_size=1, max_size=3),
)
def test_any_sequence_of_runs_equals_the_model(spark, tmp_path_factory, rows, nows):
    """Rows (id, minute, name); each run sees all rows and loads its window."""
    load = IncrementalLoad(
        spark, make(lookback_minutes=30, safety_lag_minutes=0, buckets=2, initial_watermark=T0),
        str(tmp_path_factory.mktemp("runs")))
    data = source(spark, [(i, T0 + timedelta(minutes=m), str(n)) for i, m, n in rows])
    expected, mark = {}, 0
    for now in nows:
        for _ in range(2):  # each run once more: a replay changes nothing
            load.run(data, T0 + timedelta(minutes=now))
            low, high = mark - 30, now
            if high > low:
                window = sorted((m, str(n), i) for i, m, n in rows if low <= m < high)
                expected.update({i: n for m, n, i in window})
                mark = max(mark, high)
    assert {r.ID: r.NAME for r in load.target.read().collect()} == expected


def test_latest_per_key_null_is_newest_and_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [(1, None, "n"), (1, 5, "x"), (2, 3, "a"), (2, 3, "b")], "k int, created int, v string")
    got = latest_per_key(df, ["k"], ["created"])
    assert {(r.k, r.v) for r in got.collect()} == {(1, "n"), (2, "b")}
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
