"""Connected components of links, by contraction: nothing but counts reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import written

HELD = 500_000  # links that a task joins at a time


def _forest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task, replaced by links from each node to the smallest one it reaches there."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        path = []
        while (up := root.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            root[p] = x
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(find(x), x) for x in list(root)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())],
            ["a", "b"],
        )

    count = 0
    for frame in frames:
        for a, b in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        count += frame.num_rows
        if count >= HELD:
            yield stars()
            root.clear()
            count = 0
    yield stars()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the links (a, b).

    Each round joins what meets within a task, points every node at its smallest neighbour and
    contracts the graph, until no link is left between different labels.
    """
    links = links.select("a", "b").where("a <> b")
    label = None
    while True:
        forest = written(links.mapInArrow(_forest, "a long, b long"), "component-links")
        both = forest.unionByName(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("parent")),
            "component-parents",
        )
        if label is None:
            label = parent.select("node", F.col("parent").alias("component"))
        else:
            up = parent.select(F.col("node").alias("component"), "parent")
            label = label.join(up, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component")
            )
        label = written(label, "component-labels")
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = written(
            forest.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
            .where("a <> b").distinct(),
            "component-rest",
        )
        if links.isEmpty():
            return label
