"""Runs of repeated words in whole texts, by the dictionary of basic factors.

For every power of two, the factors (stretches of so many words) of a text are named: equal
factors of one text have one name. A name at twice the length is the pair of the names of both
halves, so that each level is one sort of the positions that are still in question; a factor that
is alone in its text has no successor, and neither has any longer one, so its position leaves.

Per level the gap from each occurrence to the next one, within twice the factor's length, proposes
a period. Inside a run of period q the factors of the length that covers q (the power of two from
q on) recur at exactly q, as their own period can't be shorter, and outside they don't: the starts
with that gap follow each other without a hole, the occurrences q apart being an arithmetic
progression. So each period is read at the one level that covers it, where consecutive starts
extend to the whole run and no run is found twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tokens import batches

LEAST, POWER = 6, 4  # a run's least length, and how many periods it has at least
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def runs_of(
    codes: np.ndarray, text: np.ndarray, least: int = LEAST, power: int = POWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs of several texts, one after the other.

    ``codes`` number the words and ``text`` the texts (ascending). Ordered by start, then period.
    """
    n, found = len(codes), []
    if not n:
        return (np.empty(0, np.int64),) * 3
    longest = int(np.bincount(text).max())
    key, at = text * (int(codes.max()) + 1) + codes, np.arange(n)
    size, name = 1, np.empty(n, dtype=np.int64)
    while len(at) and power * (size // 2 + 1) <= longest:
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        same = key[1:] == key[:-1]
        gap = np.where(same, at[1:] - at[:-1], 0)
        covered = np.flatnonzero((gap > size // 2) & (gap <= size))
        start, period = at[covered], gap[covered]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        if len(start):
            new = np.flatnonzero(np.r_[True, (start[1:] != start[:-1] + 1) | (period[1:] != period[:-1])])
            last = np.r_[new[1:], len(start)] - 1
            length = start[last] - start[new] + size + period[new]
            keep = length >= np.maximum(least, power * period[new])
            found.append(np.stack([start[new], length, period[new]])[:, keep])
        # Factors that occur again are named; both halves of a factor of twice the size must be.
        again = np.r_[same, False] | np.r_[False, same]
        name[:] = -1
        names = np.cumsum(np.r_[True, ~same])
        name[at[again]] = names[again]
        at = np.sort(at[again])
        at = at[at + 2 * size <= n]
        at = at[(text[at + 2 * size - 1] == text[at]) & (name[at + size] >= 0)]
        key = name[at] * (n + 1) + name[at + size]
        size *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay if every run is cut to its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges)[:n] == 0


def _found(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text in; columns of RUNS out."""
    for frame in frames:
        for a, b in batches(frame.column(1), 2 << 20):
            split = [t.split() for t in frame.column(1).slice(a, b - a).cast(pa.binary()).to_pylist()]
            sizes = np.array([len(w) for w in split])
            ends = np.cumsum(sizes)
            words = [w for s in split for w in s]
            codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            start, length, period = runs_of(codes, np.repeat(np.arange(len(split)), sizes))
            keep = kept_words(len(words), start, length, period)
            upto = np.searchsorted(start, np.r_[0, ends])
            collapsed = []
            for i, w in enumerate(split):
                if upto[i + 1] > upto[i]:
                    at = ends[i] - sizes[i]
                    w = [w[j] for j in np.flatnonzero(keep[at:ends[i]]).tolist()]
                collapsed.append(b" ".join(w))
            begin = np.repeat(ends - sizes, np.diff(upto))
            runs = pa.ListArray.from_arrays(
                pa.array(upto, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(start - begin), pa.array(length), pa.array(period)], ["start", "length", "period"]
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [frame.column(0).slice(a, b - a), pa.array(sizes), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_words, runs (start, length, period) and the collapsed text.

    Words are parted by the six ASCII white-space characters and numbered from 0. A run is a
    stretch of words with smallest period q, of at least six words and four periods, that can't be
    extended on either side; runs are ordered by start, then period. ``collapsed`` joins the words
    by one space, without those that lie in a run after its first period.

    Null and empty texts have no words, no runs and an empty collapsed text. Rows with null or
    repeated ids are texts of their own. Other columns are ignored, whatever their names; an empty
    table stays empty. A text is worked on whole, in one task: a task holds one text, or several of
    2 MB together, and some forty bytes a word beside them.
    """
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).mapInArrow(_found, RUNS)
