"""A topic kept as files: partitions of records in order, read as a stream by offsets.

``publish`` writes a folder per partition; a record's offset is its place among the rows of its
partition's files in the order of their names. ``TopicFolder`` is a streaming source over it: an
offset of the stream is the next position of every partition, batches have a limit of records that
partitions share, and a task reads a range of rows of one file. Nothing but row counts (of
footers) is read on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import shuffle_width

RECORD = "topic string, partition int, offset long, key string, value string"


def publish(records: DataFrame, path: str, order: list[str]) -> None:
    """Write records (partition, key, value and the order's columns) as a topic, in that order."""
    spark = records.sparkSession
    (
        records.repartitionByRange(shuffle_width(spark), "partition", *order)
        .sortWithinPartitions("partition", *order)
        .select("partition", "key", "value").write.partitionBy("partition").parquet(path)
    )


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Rows(InputPartition):
    """Rows ``start`` to ``end`` of one file, the first of which has the offset ``offset``."""

    partition: int
    file: str
    start: int
    end: int
    offset: int


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.topic = options["path"], options.get("topic", "")
        self.policy, self.limit = options.get("startingoffsets", "earliest"), int(options.get("maxrecords", 0))
        self.progress = options.get("progress")
        self.rows: dict[str, int] = {}
        self.at: dict[str, int] | None = None

    def _files(self) -> dict[int, list[tuple[str, int]]]:
        """Files and their rows by partition, in the order of names. Footers are read once."""
        from pyarrow import fs
        from pyarrow import parquet

        system, root = _open(self.path)
        found: dict[int, list[tuple[str, int]]] = {}
        for info in sorted(system.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            if info.is_file and info.path.endswith(".parquet"):
                if info.path not in self.rows:
                    self.rows[info.path] = parquet.read_metadata(info.path, filesystem=system).num_rows
                partition = int(info.path.rsplit("partition=", 1)[1].split("/")[0])
                found.setdefault(partition, []).append((info.path, self.rows[info.path]))
        return found

    def _ends(self) -> dict[str, int]:
        return {str(p): sum(n for _, n in files) for p, files in self._files().items()}

    def _resumed(self) -> dict[str, int] | None:
        """The last offset that the query's own log has, after a restart."""
        from pyarrow import fs

        if not self.progress:
            return None
        system, root = _open(f"{self.progress}/offsets")
        listed = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        batches = [int(i.base_name) for i in listed if i.base_name.isdigit()]
        if not batches:
            return None
        with system.open_input_stream(f"{root}/{max(batches)}") as file:
            return json.loads(file.read().decode().splitlines()[-1])

    def initialOffset(self) -> dict[str, int]:
        self.at = self._ends() if self.policy == "latest" else {}
        return self.at

    def latestOffset(self) -> dict[str, int]:
        """The end of the next batch: from where the last one ended, partitions share the limit."""
        if self.at is None:
            self.at = self._resumed() or {}
        ends = self._ends()
        left = {p: n - self.at.get(p, 0) for p, n in ends.items() if n > self.at.get(p, 0)}
        room = self.limit or sum(left.values())
        end = dict(self.at)
        while left and room > 0:
            share = max(1, room // len(left))
            for p in sorted(left, key=int):
                taken = min(share, left[p], room)
                end[p] = end.get(p, 0) + taken
                room -= taken
                left[p] -= taken
            left = {p: n for p, n in left.items() if n}
        return end

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Rows]:
        self.at = dict(end)
        ranges = []
        for partition, files in self._files().items():
            low, high, before = start.get(str(partition), 0), end.get(str(partition), 0), 0
            for file, n in files:
                a, b = max(low, before), min(high, before + n)
                if a < b:
                    ranges.append(Rows(partition, file, a - before, b - before, a))
                before += n
        return ranges

    def read(self, partition: Rows) -> Iterator:
        import pyarrow as pa
        from pyarrow import parquet

        system, _ = _open(self.path)
        before, offset = 0, partition.offset
        with parquet.ParquetFile(partition.file, filesystem=system) as file:
            groups = []
            for i in range(file.num_row_groups):
                n = file.metadata.row_group(i).num_rows
                if before < partition.end and before + n > partition.start:
                    groups.append((i, before))
                before += n
            if not groups:
                return
            at = groups[0][1]
            for batch in file.iter_batches(row_groups=[i for i, _ in groups], columns=["key", "value"]):
                a, b = max(partition.start - at, 0), min(partition.end - at, batch.num_rows)
                at += batch.num_rows
                if a < b:
                    some, n = batch.slice(a, b - a), b - a
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([self.topic] * n), pa.array([partition.partition] * n, pa.int32()),
                            pa.array(range(offset, offset + n), pa.int64()),
                            some.column("key").cast(pa.string()), some.column("value").cast(pa.string()),
                        ],
                        ["topic", "partition", "offset", "key", "value"],
                    )
                    offset += n

    def commit(self, end: dict[str, int]) -> None:
        """Files stay as long as the topic's owner keeps them."""


class TopicFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_folder"

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(dict(self.options))


def read_topic_folder(
    spark: SparkSession, path: str, checkpoint: str, start: str = "earliest", records: int = 1000, topic: str = ""
) -> DataFrame:
    """A topic's records as a stream, at most so many a batch (0: no limit).

    ``start`` says where a query begins that has no checkpoint yet; one that has goes on behind the
    last batch it planned, and runs that batch again, with the same records, if it wasn't committed.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, not {start!r}")
    spark.dataSource.register(TopicFolder)
    return (
        spark.readStream.format(TopicFolder.name()).option("path", path).option("progress", checkpoint)
        .option("startingOffsets", start).option("maxRecords", records).option("topic", topic).load()
    )


def run_batches(frame: DataFrame, checkpoint: str, sink) -> StreamingQuery:
    """Batch after batch through ``sink`` until the topic's end, then stop. An error is raised."""
    query = (
        frame.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
