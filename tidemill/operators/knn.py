"""Nearest neighbours by cosine: exact, by cells, and the recall between the two.

The corpus is never gathered and pairs are never emitted: each task scores the
batches it reads and keeps k rows per query. Matrix products run in numpy on
Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.vector import EPSILON
from tidemill.session import shared_folder, written

# Queries go to the tasks in chunks whose vectors take at most this much memory. Each
# task returns k rows per query, so this also bounds what tasks return.
BROADCAST_BYTES = 8 << 20
SCORES_AT_ONCE = 4_000_000


def sized(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Rows whose vector has the dimension."""
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) == dim))


def usable(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Rows whose vector has the dimension and no NULL element."""
    return sized(df, vector, dim).filter(~F.exists(vector, lambda x: x.isNull()))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows. A NULL element becomes NaN, and NaN scores are never returned."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dim)


class _TopK:
    """The k best (score, id) per query seen so far; ties go to the smaller id.

    Scores are rounded to 12 digits, so that equal vectors tie however a matrix
    product was split.
    """

    def __init__(self, ids: list, vectors: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.vectors = vectors
        self.norms = np.linalg.norm(vectors, axis=1)
        self.best: list[list[tuple]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, rows: np.ndarray, matrix: np.ndarray, ids: np.ndarray) -> None:
        """Score the corpus rows against the queries numbered in ``rows``."""
        if not len(ids):
            return
        lengths = np.linalg.norm(matrix, axis=1)
        step = max(1, SCORES_AT_ONCE // len(ids))
        for start in range(0, len(rows), step):
            self._add(rows[start : start + step], matrix, lengths, ids)

    def _add(self, rows, matrix, lengths, ids) -> None:
        scores = self.vectors[rows] @ matrix.T
        scores /= np.outer(self.norms[rows], lengths) + EPSILON
        scores = np.where(np.isnan(scores), -np.inf, np.round(scores, 12))
        width = min(self.k, scores.shape[1])
        cut = np.partition(scores, scores.shape[1] - width, axis=1)[:, -width]
        enough = (scores >= np.maximum(cut, self.floor[rows])[:, None]) & (scores > -np.inf)
        for r in np.flatnonzero(enough.any(axis=1)):
            near = np.flatnonzero(enough[r])
            near = near[np.lexsort((ids[near], -scores[r][near]))[: self.k]]
            found = zip((-scores[r][near]).tolist(), ids[near].tolist())
            best = sorted([*self.best[rows[r]], *found])[: self.k]
            self.best[rows[r]] = best
            if len(best) == self.k:
                self.floor[rows[r]] = -best[-1][0]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        rows = [(q, i, -s) for q, best in zip(self.ids, self.best) for s, i in best]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
        )


@dataclass(frozen=True)
class _Sides:
    """Column names and types of a search."""

    query_id: str
    query: str
    id: str
    vector: str
    dim: int
    k: int
    query_type: T.DataType
    id_type: T.DataType

    @property
    def spark_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("query_id", self.query_type),
                T.StructField("neighbour_id", self.id_type),
                T.StructField("score", T.DoubleType()),
            ]
        )

    @property
    def arrow_schema(self) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(self.spark_schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Final k per query from the tasks' k each; cut once more before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _chunks(queries: DataFrame, sides: _Sides) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and vectors of the queries in chunks within the broadcast bound, one at a time."""
    most = max(1, BROADCAST_BYTES // (sides.dim * 8))
    ids, vectors = [], []
    for row in queries.select(sides.query_id, sides.query).toLocalIterator():
        ids.append(row[0])
        vectors.append([np.nan if x is None else x for x in row[1]])
        if len(ids) == most:
            yield ids, np.array(vectors, dtype=np.float64)
            ids, vectors = [], []
    if ids:
        yield ids, np.array(vectors, dtype=np.float64)


def _by_chunks(queries: DataFrame, sides: _Sides, search) -> DataFrame:
    """The ranked results of ``search(ids, vectors)`` for every chunk; each pass is written."""
    spark = queries.sparkSession
    parts = [
        written(_ranked(search(ids, vectors), sides.k), "neighbours")
        for ids, vectors in _chunks(queries, sides)
    ]
    if not parts:
        return _ranked(spark.createDataFrame([], sides.spark_schema), sides.k)
    return reduce(DataFrame.unionByName, parts)


def _sides(queries, corpus, k, dim, query_id, query, id, vector) -> _Sides:
    return _Sides(
        query_id, query, id, vector, dim, k,
        queries.schema[query_id].dataType, corpus.schema[id].dataType,
    )


def knn_exact(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    dim: int = 128,
    query_id: str = "query_id",
    query: str = "query",
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k corpus rows with the highest cosine per query: query_id, neighbour_id, score, rank.

    Vectors that are NULL or of another dimension are skipped; ties go to the
    smaller id. Queries meet the corpus where it is read, in chunks within the
    broadcast bound: one scan per chunk, and the corpus is never shuffled. Ids are unique.
    """
    sides = _sides(queries, corpus, k, dim, query_id, query, id, vector)
    queries, corpus = sized(queries, query, dim), sized(corpus, vector, dim)

    def search(ids: list, vectors: np.ndarray) -> DataFrame:
        sent = queries.sparkSession.sparkContext.broadcast((ids, vectors))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = _TopK(*sent.value, sides.k)
            every = np.arange(len(top.ids))
            for batch in batches:
                names = batch.column(0).to_numpy(zero_copy_only=False)
                top.add(every, _matrix(batch.column(1), sides.dim), names)
            yield top.batch(sides.arrow_schema)

        return corpus.select(id, vector).mapInArrow(scan, sides.spark_schema)

    return _by_chunks(queries, sides, search)


@dataclass(frozen=True)
class CellIndex:
    """A corpus written by cell: folder, cell centres, and rows per cell."""

    path: str
    centres: np.ndarray
    sizes: dict[int, int]
    id: str
    vector: str
    dim: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def probes(self, vectors: np.ndarray, nprobe: int, k: int) -> list[list[int]]:
        """Cells to read per query: the nearest ``nprobe``, and more until k rows are there."""
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True) + EPSILON
        unit = vectors / lengths
        distance = (self.centres**2).sum(axis=1) - 2 * unit @ self.centres.T
        chosen = []
        for order in np.argsort(distance, axis=1, kind="stable"):
            cells, rows = [], 0
            for cell in order.tolist():
                if len(cells) >= nprobe and rows >= k:
                    break
                cells.append(cell)
                rows += self.sizes.get(cell, 0)
            chosen.append(cells)
        return chosen


def build_cells(
    corpus: DataFrame,
    cells: int | None,
    dim: int,
    id: str = "vec_id",
    vector: str = "embedding",
    path: str | None = None,
    seed: int = 1,
    iterations: int = 10,
    training_share: float = 1.0,
) -> CellIndex:
    """Cluster the unit vectors and write the corpus partitioned by cell.

    Euclidean and cosine order agree on unit vectors. Without a number of ``cells`` it
    is the square root of the rows, so that cells grow no faster than their number. Centres are
    fitted to all rows, or to the share of them that the caller chooses; every row is
    placed in a cell. Build an index once and pass it to the searches. The rebalance before the write lets adaptive execution cut
    a cell with very many rows into files.
    """
    spark = corpus.sparkSession
    path = path or shared_folder(spark, "cells")
    vectors = usable(corpus, vector, dim).select(id, vector, array_to_vector(vector).alias("_v"))
    unit = Normalizer(p=2.0, inputCol="_v", outputCol="_unit").transform(vectors)
    if cells is None:
        cells = max(2, math.isqrt(unit.count()))
    training = unit if training_share >= 1 else unit.sample(training_share, seed)
    means = KMeans(
        k=cells, featuresCol="_unit", predictionCol="cell", seed=seed, maxIter=iterations
    ).fit(training)
    placed = means.transform(unit).select(id, vector, "cell")
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    counts = spark.read.parquet(path).groupBy("cell").count().collect()  # at most `cells` rows
    centres = np.array(means.clusterCenters())
    return CellIndex(path, centres, {r["cell"]: r["count"] for r in counts}, id, vector, dim)


def knn_approx(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    nprobe: int,
    query_id: str = "query_id",
    query: str = "query",
) -> DataFrame:
    """As `knn_exact`, but each query is scored only against its nearest cells.

    A chunk of queries reads the files of the cells that one of them probes. Every query sees at least k rows if the
    corpus has them. Take ``nprobe`` from `probes_for_recall`: the share of the corpus that a
    fixed number reads falls as the corpus grows. Measure the quality with `recall`.
    """
    spark = queries.sparkSession
    corpus = index.rows(spark)
    sides = _sides(queries, corpus, k, index.dim, query_id, query, index.id, index.vector)
    queries = sized(queries, query, index.dim)

    def search(ids: list, vectors: np.ndarray) -> DataFrame:
        readers: dict[int, list[int]] = {}
        for row, probed in enumerate(index.probes(vectors, nprobe, k)):
            for cell in probed:
                readers.setdefault(cell, []).append(row)
        sent = spark.sparkContext.broadcast((ids, vectors, readers))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, vectors, readers = sent.value
            top = _TopK(ids, vectors, sides.k)
            for batch in batches:
                cells = batch.column(2).to_numpy(zero_copy_only=False)
                names = batch.column(0).to_numpy(zero_copy_only=False)
                matrix = _matrix(batch.column(1), sides.dim)
                for cell in np.unique(cells):
                    at = np.flatnonzero(cells == cell)
                    top.add(np.array(readers[int(cell)]), matrix[at], names[at])
            yield top.batch(sides.arrow_schema)

        read = corpus.filter(F.col("cell").isin(sorted(readers)))
        return read.select(index.id, index.vector, "cell").mapInArrow(scan, sides.spark_schema)

    return _by_chunks(queries, sides, search)


def recall(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """Per query: the fraction (0..1) of exact neighbours the approximate search found."""
    found = approx.select("query_id", "neighbour_id", F.lit(1).alias("_hit")).distinct()
    return (
        exact.select("query_id", "neighbour_id")
        .join(found, ["query_id", "neighbour_id"], "left")
        .groupBy("query_id")
        .agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
    )


def mean_recall(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """One row: the mean over queries; 0 if there is no exact result."""
    return recall(exact, approx).agg(F.coalesce(F.avg("recall"), F.lit(0.0)).alias("mean_recall"))


def probes_for_recall(
    queries: DataFrame, index: CellIndex, exact: DataFrame, k: int = 5, target: float = 0.95,
    query_id: str = "query_id", query: str = "query",
) -> int:
    """Smallest tried number of probes whose measured mean recall reaches the target.

    Tries 1, 2, 4, ... and all cells, which is exact. Use trial queries for it.
    """
    cells = len(index.centres)
    nprobe = 1
    while nprobe < cells:
        found = knn_approx(queries, index, k, nprobe, query_id, query)
        if mean_recall(exact, found).first().mean_recall >= target:
            return nprobe
        nprobe *= 2
    return cells


def group_centres(
    df: DataFrame, group: str, vector: str, dim: int, name: str = "centre"
) -> DataFrame:
    """Mean vector per group, merged from per-task partial means."""
    rows = usable(df, vector, dim).select(group, array_to_vector(vector).alias("_v"))
    means = rows.groupBy(group).agg(Summarizer.mean(F.col("_v")).alias("_mean"))
    return means.select(group, vector_to_array("_mean").alias(name))


def with_attributes(neighbours: DataFrame, table: DataFrame, id: str = "vec_id") -> DataFrame:
    """Neighbours with their rows of an attribute table, such as audience name and size."""
    return neighbours.join(table, neighbours.neighbour_id == table[id], "left").drop(table[id])
