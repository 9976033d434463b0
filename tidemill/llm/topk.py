"""Exact top-k search over integer vectors by MaxScore.

A vector's components are its terms. Within a shard (the vectors a task holds at a time), the
impact of a term on a query is its contribution above the shard's least; the largest impact
bounds it. Terms are split for each query: those whose bounds together can't lift a vector
to the query's k-th best score are non-essential. The essential terms' postings (the components,
stored by dimension) are traversed, and the others are probed, largest bound first, only for
vectors that can still compete. The best k of each query pass from shard to shard in a task and
are merged over the tasks.

Queries go to the tasks in blocks of bounded size, one pass over the vectors per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import written

HITS = "query long, query_id long, vec_id long, score long"
LONG = 2**63 - 1
PROBED = 8  # non-essential terms probed between two checks


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles if all sums of products are exact, else as Python integers."""
    scaled = np.floor(values * scale)
    most = float(np.abs(scaled).max(initial=0))
    if most < 2**26 and most * most * max(values.shape[-1], 1) < 2**53:
        return scaled
    exact = [int(np.floor(x * scale)) if abs(x) < 2**52 else int(x) * scale for x in values.ravel()]
    return np.array(exact, dtype=object).reshape(values.shape)


def competitive(query: np.ndarray, terms: np.ndarray, least: np.ndarray, most: np.ndarray, bar) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the shard's vectors with a score of ``bar`` or more, by MaxScore.

    ``terms``: a row per dimension; ``least`` and ``most``: its range. ``bar`` None: all vectors.
    """
    if bar is None:
        return np.arange(terms.shape[1]), query @ terms
    low = np.where(query > 0, query * least, query * most)
    impact = np.where(query > 0, query * most, query * least) - low
    order = np.argsort(impact, kind="stable")
    # Non-essential: the first terms whose impacts on top of all least contributions stay below.
    upto = np.cumsum(impact[order])
    few = int(np.searchsorted(upto + low.sum(), bar, side="left"))
    essential, others = order[few:], order[:few][::-1]
    score = query[essential] @ terms[essential] if len(essential) else np.zeros(terms.shape[1], dtype=terms.dtype)
    alive = np.arange(terms.shape[1])
    rest = low[others].sum() + impact[others].sum()
    for i in range(0, len(others) + 1, PROBED):
        keep = score + rest >= bar
        alive, score = alive[keep], score[keep]
        if i >= len(others) or not len(alive):
            break
        probe = others[i:i + PROBED]
        score = score + query[probe] @ terms[np.ix_(probe, alive)]
        rest = rest - low[probe].sum() - impact[probe].sum()
    keep = score >= bar
    return alive[keep], score[keep]


class _Best:
    """The k best of one query so far: higher scores first, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def bar(self):
        return self.rows[-1][0] if len(self.rows) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:  # ids ascend, so that a stable sort breaks ties
            best = np.argsort(-scores, kind="stable")[: self.k]
            scores, ids = scores[best], ids[best]
        rows = self.rows + [(int(s), int(i)) for s, i in zip(scores, ids)]
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1]))[: self.k]


def _search(block: list[tuple[int, int, np.ndarray]], k: int, scale: int, shard: int):
    """A task's function: vectors (vec_id, components) in, its best k per query out."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in block]
        queries: dict[int, list[int]] = {}
        for at, (_, _, vector) in enumerate(block):
            queries.setdefault(len(vector), []).append(at)

        def scored(ids: np.ndarray, values: np.ndarray) -> None:
            order = np.argsort(ids, kind="stable")
            ids, whole = ids[order], _whole(values[order], scale)
            terms = np.ascontiguousarray(whole.T)
            least, most = terms.min(axis=1), terms.max(axis=1)
            for at in queries.get(values.shape[1], ()):
                query_id, vector = block[at][1], _whole(block[at][2], scale)
                t, low, high = terms, least, most
                if vector.dtype == object or t.dtype == object or (
                    float(np.abs(vector).max(initial=0)) * float(np.abs(t).max(initial=0)) * max(len(vector), 1)
                    >= 2**53
                ):
                    vector, t, low, high = (
                        np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)
                        for x in (vector, t, low, high)
                    )
                found, scores = competitive(vector, t, low, high, best[at].bar)
                other = ids[found] != query_id
                found, scores = found[other], scores[other]
                best[at].add(np.array([max(-LONG - 1, min(LONG, s)) for s in scores], dtype=object)
                             if scores.dtype == object else scores, ids[found])

        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for frame in frames:
            ids = frame.column(0).to_numpy()
            vectors = frame.column(1)
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
            for length in np.unique(lengths):
                if length not in queries:
                    continue
                at = np.flatnonzero(lengths == length)
                values = flat[starts[at][:, None] + np.arange(length)]
                held.setdefault(int(length), []).append((ids[at], values))
                if sum(len(i) for i, _ in held[int(length)]) >= shard:
                    parts = held.pop(int(length))
                    scored(np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]))
        for parts in held.values():
            scored(np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]))
        rows = [
            (number, query_id, vec_id, score)
            for (number, query_id, _), b in zip(block, best) for score, vec_id in b.rows
        ]
        for i in range(0, len(rows), 50_000):
            columns = zip(*rows[i:i + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query", "query_id", "vec_id", "score"]
            )

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10,
    vec_id: str = "vec_id", vector: str = "embedding",
    *, scale: int = 1024, block_bytes: int = 4 << 20, shard: int = 8192,
) -> DataFrame:
    """Each query's k best vectors: query, query_id, rank, vec_id, score.

    Components become floor(scale * x); the score is their inner product, ties go to the smaller
    id. A query's own row (a vector of its id) is no candidate. Null vectors, vectors with null or
    non-finite components, and rows without an id take no part; only vectors of the query's length
    compete. Repeated rows are candidates each, and a query each (numbered by ``query``). Other
    columns are ignored; empty tables give no rows. Scores outside 64 bits are set to the bound.
    """

    def ready(frame: DataFrame) -> DataFrame:
        number = F.col(vector).cast("array<double>")
        return frame.where(F.col(vec_id).isNotNull()).select(
            F.col(vec_id).cast("long").alias("vec_id"), number.alias("vector")
        ).where(usable(F.col("vector")))

    corpus = ready(vectors)
    found, block, size, number = [], [], 0, 0

    def searched() -> None:
        hits = corpus.mapInArrow(_search(block, k, scale, shard), HITS)
        by_rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        best = hits.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
        found.append(written(best.select("query", "query_id", "rank", "vec_id", "score"), "top-k"))

    # A block of queries at a time is on the driver.
    for row in ready(queries).sort("vec_id").toLocalIterator():
        block.append((number, row.vec_id, np.array(row.vector, dtype=float)))
        size, number = size + 8 * len(row.vector) + 64, number + 1
        if size >= block_bytes:
            searched()
            block, size = [], 0
    if block or not found:
        searched()
    return reduce(DataFrame.unionByName, found)
