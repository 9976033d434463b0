import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemill.operators.predicates import exclude_listed
from tidemill.operators.rollup import Output
from tidemill.streaming import topic
from tidemill.streaming.change import changes_only
from tidemill.streaming.route import MappedSink, RouteSink, UpsertSink, dead_letters, good_documents, parsed
from tidemill.streaming.windows import streaming_rollup, windowed_alerts

RECORD = "topic string, partition int, offset bigint, key string, value string"


def records(spark, values, start=0, keys=None):
    rows = [
        ("t", 0, start + i, keys[i] if keys else None, v if v is None or isinstance(v, str) else json.dumps(v))
        for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD).coalesce(1)


VALUES = [
    {"product_type": "Widget", "name": "a"},
    [{"product_type": "gadget"}, {"x": 1}, {"product_type": "GADGET"}],
    "this is not json",
    {"product_type": "widget#123@", "name": "test"},
    {"product_type": ""},
    42,
    {"product_type": None},
    [{"product_type": "ok"}, {"product_type": "invalid/product"}],
    None,
    [],
]


def test_split(spark):
    split = parsed(records(spark, VALUES))
    good = good_documents(split, "prd_").collect()
    assert sorted(r.alias for r in good) == sorted(
        ["prd_widget", "prd_gadget", "prd_unknown", "prd_gadget", "prd_unknown", "prd_unknown", "prd_ok"])
    assert len({r.doc_id for r in good}) == len(good)
    bad = {r.offset: json.loads(r.value) for r in dead_letters(split).collect()}
    assert sorted(bad) == [2, 3, 4, 7, 8]
    assert bad[2]["original_message"] == "this is not json" and "not valid JSON" in bad[2]["error"]
    assert "widget#123@" in bad[3]["error"] and bad[8]["original_message"] is None


def stream(spark, folder, frames):
    for i, frame in enumerate(frames):
        frame.write.mode("append").parquet(f"{folder}/in")
    return topic.read_files(spark, f"{folder}/in", RECORD, files_per_trigger=1)


def test_route_replay_leaves_no_duplicates(spark, folder):
    sink = RouteSink(spark, f"{folder}/out", "test_")
    calls = []

    def failing(batch, batch_id):
        sink(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write, before the commit")

    source = stream(spark, folder, [records(spark, VALUES), records(spark, VALUES[:2], 100)])
    with pytest.raises(Exception, match="lost after the write"):
        topic.run_to_end(source, f"{folder}/cp", failing)
    topic.run_to_end(source, f"{folder}/cp", sink)
    assert calls == [0, 1] and sink.last_counts == (1, 2, 0)
    assert sink.documents().count() == 7 + 4
    assert sink.letters().count() == 5
    topic.run_to_end(source, f"{folder}/cp", sink)  # nothing new: nothing written
    assert sink.documents().count() == 11


def test_policies(spark, folder):
    batch = records(spark, VALUES)
    RouteSink(spark, f"{folder}/empty", "x_")(batch.limit(0), 0)
    assert RouteSink(spark, f"{folder}/empty", "x_").documents().isEmpty()
    skip = RouteSink(spark, f"{folder}/skip", "x_", on_error="skip")
    skip(batch, 0)
    assert (skip.documents().count(), skip.letters().count()) == (7, 0)
    with pytest.raises(ValueError, match="bad records"):
        RouteSink(spark, f"{folder}/fail", "x_", on_error="fail")(batch, 0)

    class Broken(RouteSink):
        def write_documents(self, documents, batch_id):
            raise OSError("index is down")

    with pytest.raises(OSError):
        Broken(spark, f"{folder}/b1", "x_")(batch, 0)
    broken = Broken(spark, f"{folder}/b2", "x_", letters_for_failed_batches=True)
    broken(batch, 0)
    letters = broken.letters().collect()
    assert len(letters) == len(VALUES) and all("index is down" in r.value for r in letters)


def held(sink):
    return {(r.doc_id, json.loads(r.document)["n"], r.offset) for r in sink.documents().collect()}


def test_upsert(spark, folder):
    sink = UpsertSink(spark, folder, "x_", changes_only=True)
    doc = lambda n: {"product_type": "w", "n": n}
    first = records(spark, [doc(1), doc(2), doc(9)], 0, ["a", "a", "b"])
    sink(first, 0)
    assert held(sink) == {("a", 2, 1), ("b", 9, 2)}
    sink(first, 0)  # replay
    assert held(sink) == {("a", 2, 1), ("b", 9, 2)}
    sink(records(spark, [doc(3), doc(2), doc(8)], 10, ["a", "a", "b"]), 1)
    assert held(sink) == {("a", 2, 11), ("b", 8, 12)}
    sink.compact(1)
    sink(first, 0)  # replay of a compacted batch
    sink(records(spark, [doc(2), doc(8), doc(1)], 20, ["a", "b", "b"]), 2)
    assert held(sink) == {("a", 2, 11), ("b", 1, 22)}
    plain = UpsertSink(spark, f"{folder}/plain", "x_")
    plain(records(spark, [doc(1), [doc(2), doc(3)]], 0, ["a", None]), 0)
    assert plain.documents().count() == 3


def test_upsert_does_not_depend_on_the_batches(spark, folder):
    values = [{"product_type": "w", "n": (i * 7 // 5) % 3} for i in range(60)]
    keys = [f"k{i * i % 4}" for i in range(60)]
    last = {}
    for i, (key, value) in enumerate(zip(keys, values)):
        if key not in last or last[key][0] != value["n"]:
            last[key] = (value["n"], i)
    want = {(k, n, i) for k, (n, i) in last.items()}
    for batches in (1, 3, 10):
        sink = UpsertSink(spark, f"{folder}/{batches}", "x_", changes_only=True, compact_every=4)
        size = 60 // batches
        for b in range(batches):
            part = slice(b * size, (b + 1) * size)
            sink(records(spark, values[part], b * size, keys[part]), b)
        assert held(sink) == want


def test_upsert_inside_a_stream(spark, folder):
    sink = UpsertSink(spark, f"{folder}/out", "x_", changes_only=True)
    frames = [records(spark, [{"n": 1}, {"n": 2}], 0, ["a", "b"]), records(spark, [{"n": 1}, {"n": 5}], 2, ["a", "b"])]
    topic.run_to_end(stream(spark, folder, frames), f"{folder}/cp", sink)
    assert held(sink) == {("a", 1, 0), ("b", 5, 3)}


def test_a_retried_batch_leaves_no_record_in_both_places(spark, folder):
    class Flaky(RouteSink):
        broken = True

        def write_documents(self, documents, batch_id):
            super().write_documents(documents, batch_id)
            if self.broken:
                raise OSError("index is down")

    sink = Flaky(spark, folder, "x_", letters_for_failed_batches=True)
    batch = records(spark, [{"n": 1}, {"n": 2}])
    sink(batch, 0)
    assert sink.letters().count() == 2 and sink.documents().count() == 0
    sink.broken = False
    sink(batch, 0)
    assert sink.letters().count() == 0 and sink.documents().count() == 2
    sink.broken = True
    sink(batch, 0)
    assert sink.letters().count() == 2 and sink.documents().count() == 0


def test_change_only_across_batches(spark, folder):
    first = records(spark, ["A", "A", "B", "A", None, None], 0, ["k"] * 6)
    second = records(spark, [None, "A", "A", "X"], 6, ["k", "k", "k", "other"])
    source = stream(spark, folder, [first, second])
    out = changes_only(source, "key", "value", ["partition", "offset"])
    topic.append_to_end(out, f"{folder}/out", f"{folder}/cp")
    got = sorted((r.offset, r.value) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [(0, "A"), (2, "B"), (3, "A"), (4, None), (7, "A"), (9, "X")]


def sensor(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, user bigint, value double")


def test_windowed_alerts_and_rollup(spark, folder):
    at = lambda m, s: datetime(2026, 1, 1, 0, m, s)
    rows = [(at(0, 1), 1, 28.0), (at(0, 2), 1, 28.1), (at(0, 3), 2, 21.9), (at(1, 0), None, 22.0),
            (at(30, 0), 1, 25.0)]
    sensor(spark, rows).coalesce(1).write.parquet(f"{folder}/in")
    source = topic.read_files(spark, f"{folder}/in", sensor(spark, []).schema)
    topic.append_to_end(windowed_alerts(source, "ts", "value"), f"{folder}/a", f"{folder}/acp")
    got = {(r.window_start.minute, r.label, r.n) for r in spark.read.parquet(f"{folder}/a").collect()}
    assert got == {(0, None, 1), (0, "high", 1), (0, "low", 1), (1, None, 1)}
    excluded = spark.createDataFrame([(2,), (None,)], "id bigint")
    kept = exclude_listed(source, "user", excluded, "id")
    outputs = [Output("user", "key"), Output("ts", "max"), Output("value", "min"), Output("n", "count")]
    topic.update_to_end(windowed_alerts(source, "ts", "value"), f"{folder}/u", f"{folder}/ucp")
    schema = spark.read.parquet(f"{folder}/a").schema
    every = topic.updated(spark, f"{folder}/u", schema, ["window_start", "label"]).collect()
    assert {(r.window_start.minute, r.label, r.n) for r in every} == {*got, (30, None, 1)}
    rolled = streaming_rollup(kept, outputs, ["user"])
    topic.append_to_end(rolled, f"{folder}/r", f"{folder}/rcp")
    got = {(r.user, r.ts.second, r.value, r.n) for r in spark.read.parquet(f"{folder}/r").collect()}
    assert got == {(1, 2, 28.0, 2), (None, 0, 22.0, 1)}


def test_topic_helpers(spark):
    with pytest.raises(ValueError):
        topic.read_topic(spark, "t", start="middle")
    assert topic.trigger() == {"availableNow": True}
    assert topic.trigger(topic.PRODUCTION_BATCH) == {"processingTime": "5 seconds"}
    raw = spark.createDataFrame(
        [("t", 0, 1, bytearray(b"k"), bytearray(b'{"ProductType":"E"}'))],
        "topic string, partition int, offset bigint, key binary, value binary")
    row = topic.with_message(topic.as_records(raw)).first()
    assert (row.key, row.message.productType) == ("k", "E")
    assert spark.range(1).select(F.lit(1)).first()[0] == 1


def test_batches_limited_by_size(spark, folder):
    sink = RouteSink(spark, f"{folder}/out", "x_")
    for i in range(3):
        records(spark, [{"n": i}], i).write.mode("append").parquet(f"{folder}/in")
    limited = topic.read_files(spark, f"{folder}/in", RECORD, bytes_per_trigger=1)
    topic.run_to_end(limited, f"{folder}/cp", sink)
    assert sink.last_counts == (2, 1, 0) and sink.documents().count() == 3


def test_change_sink_with_one_heavy_key_does_not_depend_on_the_batches(spark, folder):
    from tidemill.operators import prefix
    from tidemill.streaming import change

    values = ["ABBACA"[i * i % 6] if i % 5 else None for i in range(120)]
    keys = ["hot" if i % 3 else f"k{i % 4}" for i in range(120)]
    rows = [(i, k, v) for i, (k, v) in enumerate(zip(keys, values))]
    last, want = {}, set()
    for i, k, v in rows:
        if k not in last or last[k] != v:
            want.add(i)
        last[k] = v
    schema = "i long, k string, v string"
    least, prefix_keep = prefix.LEAST_HEAVY_ROWS, change.keep_changes
    try:
        change.keep_changes = lambda *a: prefix_keep(*a, least_rows=5)
        for batches in (1, 4):
            sink = change.ChangeSink(spark, f"{folder}/{batches}", "k", "v", ["i"])
            size = 120 // batches
            for b in range(batches):
                part = spark.createDataFrame(rows[b * size:(b + 1) * size], schema)
                sink(part, b)
                sink(part, b)  # replay
            assert {r.i for r in sink.rows(part.schema).collect()} == want
    finally:
        change.keep_changes = prefix_keep
    assert least == prefix.LEAST_HEAVY_ROWS


def test_failed_items_become_letters_and_the_others_stay(spark, folder):
    class Picky(RouteSink):
        def write_documents(self, documents, batch_id):
            refused = F.get_json_object("document", "$.n") == "2"
            super().write_documents(documents.filter(~refused), batch_id)
            return documents.filter(refused).select("topic", "partition", "offset", F.lit("mapping").alias("error"))

    sink = Picky(spark, folder, "x_")
    sink(records(spark, [{"n": 1}, {"n": 2}, "not json", {"n": 3}]), 0)
    assert sorted(r.offset for r in sink.documents().collect()) == [0, 3]
    letters = {r.offset: json.loads(r.value)["error"] for r in sink.letters().collect()}
    assert sorted(letters) == [1, 2] and letters[1] == "mapping"


def test_documents_that_do_not_fit_their_fields_are_refused_alone(spark, folder):
    sink = MappedSink(spark, folder, "x_", mapping={"n": "bigint", "at": "timestamp"})
    ok, text = {"product_type": "w", "n": 1, "at": None}, {"product_type": "w", "n": "many"}
    late = {"product_type": "w", "n": "7", "at": "not a time"}
    bad = {"product_type": "in/valid", "n": 2}
    values = [[ok, text], [late, text], ok, [bad, text], "not json", {"product_type": "w", "m": "any"}, []]
    for _ in range(2):  # the batch is run again
        sink(records(spark, values), 0)
    assert sorted(r.offset for r in sink.documents().collect()) == [0, 2, 5]
    letters = [(r.offset, json.loads(r.value)["error"]) for r in sink.letters().collect()]
    assert sorted(letters) == [
        (0, "field n is no bigint"), (1, "field at is no timestamp"),
        (3, "invalid document type: in/valid"), (4, "value is not valid JSON"),
    ]


def test_a_continuous_run_is_stopped_when_it_has_caught_up(spark, folder):
    sink = RouteSink(spark, f"{folder}/out", "x_")
    records(spark, [{"n": 1}]).write.parquet(f"{folder}/in")
    query = topic.start(topic.read_files(spark, f"{folder}/in", RECORD), f"{folder}/cp", sink, (1000, 1))
    assert query.isActive
    records(spark, [{"n": 2}], 1).write.mode("append").parquet(f"{folder}/in")
    topic.stop(query)
    assert not query.isActive and sink.documents().count() == 2
