import pytest

from tidemill.sources import topic_folder
from tidemill.sources.topic_folder import TopicReader, publish, read_topic_folder, run_batches


def records(spark, n, first=0):
    return spark.createDataFrame([(i % 3, f"k{i}", f"v{i}", i) for i in range(first, first + n)], "partition int, key string, value string, at long")


def collected(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            out += [(r["partition"], r["offset"], r["key"], r["topic"]) for r in batch.to_pylist()]
    return sorted(out)


def test_any_range_of_offsets_is_read(spark, folder):
    path = f"{folder}/topic"
    publish(records(spark, 300), path, ["at"])
    reader = TopicReader({"path": path, "topic": "t"})
    assert reader.initialOffset() == {} and reader.latestOffset() == {"0": 100, "1": 100, "2": 100}
    whole = [(p, i, f"k{3 * i + p}", "t") for p in range(3) for i in range(100)]
    assert collected(reader, {}, {"0": 100, "1": 100, "2": 100}) == whole
    some = collected(reader, {"0": 7, "2": 99}, {"0": 31, "1": 1, "2": 100})
    assert some == [r for r in whole if (r[0], r[1]) in {(0, i) for i in range(7, 31)} | {(1, 0), (2, 99)}]
    assert collected(reader, {"0": 5}, {"0": 5}) == []


def test_batches_share_the_limit_until_the_end(spark, folder):
    path = f"{folder}/topic"
    publish(records(spark, 30).where("partition < 2 or at < 6"), path, ["at"])
    reader = TopicReader({"path": path, "maxrecords": "7"})
    at, sizes = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        sizes.append(sum(end.values()) - sum(at.values()))
        reader.partitions(at, end)
        at = end
    assert sizes == [7, 7, 7, 1] and at == {"0": 10, "1": 10, "2": 2}
    assert reader.latestOffset() == at


def test_stream_from_the_latest_record_and_after_a_restart(spark, folder):
    path, seen = f"{folder}/topic", []
    publish(records(spark, 30), path, ["at"])

    def sink(batch, batch_id):
        seen.append((batch_id, sorted(r.key for r in batch.select("key").collect())))

    def run(start, checkpoint, limit=1000):
        run_batches(read_topic_folder(spark, path, f"{folder}/{checkpoint}", start, limit), f"{folder}/{checkpoint}", sink)

    run("latest", "late")
    assert sum(len(keys) for _, keys in seen) == 0
    # New files of a partition come behind the old ones: their names are later.
    publish(records(spark, 12, 30), f"{folder}/more", ["at"])
    import glob
    import os
    import shutil

    for i, name in enumerate(sorted(glob.glob(f"{folder}/more/partition=*/*.parquet"))):
        part = os.path.basename(os.path.dirname(name))
        shutil.copy(name, f"{path}/{part}/part-9{i:04d}.parquet")
    run("latest", "late", 5)
    assert sorted(k for _, keys in seen for k in keys) == sorted(f"k{i}" for i in range(30, 42))
    assert max(len(keys) for _, keys in seen) <= 5
    seen.clear()
    run("earliest", "early", 20)
    run("earliest", "early", 20)
    assert sorted(k for _, keys in seen for k in keys) == sorted(f"k{i}" for i in range(42))
    with pytest.raises(ValueError):
        topic_folder.read_topic_folder(spark, path, folder, start="middle")
