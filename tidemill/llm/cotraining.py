"""Quality classifier by co-training: a view of the text's words and one of the page's metadata.

Both views start from the same labelled documents. In each round, each view's classifier labels
those documents of the rest of the table it is most confident of, for the other view to learn
from. At the end each view is calibrated on labelled documents that it hasn't trained on, and the
calibrated views are added up.

The labelled documents are a bounded sample (``labelled``, by the hash of their id). All others are
the pool: a round is a pass over both views of the whole table, in which tasks add up the confident
documents by class, confidence and a hash. A view learns from the means of these cells, weighted by
their documents, so that what reaches the driver has one size for any table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import release_memory
from tidemill.session import written

TEXT, PAGE = 2048, 128  # features of the views
BINS, WIDTH, PARTS = 16, 0.5, 4  # cells of a class: steps of the margin, by parts of a hash
UNIT = 2.0**24  # sums are whole numbers of its inverse, so that their order doesn't matter
SHAPES = bytes.maketrans(
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)),
    b"a" * 26 + b"A" * 26 + b"0" * 10 + b"a" * 128,
)


def _slot(kind: bytes, value: bytes, slots: int) -> int:
    return xxhash.xxh3_64_intdigest(kind + value) % slots


class _Words(dict):
    """A number per word; ``slots`` has the features of each: the word, its end, its shape."""

    def __init__(self):
        self.slots = np.zeros((1024, 3), dtype=np.int32)
        self.new: list[tuple[int, int, int]] = []
        self.parts: dict[bytes, int] = {}  # slots of ends and shapes, of which there are few

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        shape = _RUNS.sub(rb"\1", word[:64].translate(SHAPES))
        self.new.append((xxhash.xxh3_64_intdigest(word) % TEXT, self._part(b"e" + word[-3:]), self._part(b"s" + shape)))
        return number

    def _part(self, value: bytes) -> int:
        slot = self.parts.get(value)
        if slot is None:
            slot = xxhash.xxh3_64_intdigest(value) % TEXT
            if len(self.parts) < 100_000:
                self.parts[value] = slot
        return slot

    def features(self, words: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.new:
            end = len(self)
            if end > len(self.slots):
                self.slots = np.concatenate([self.slots, np.zeros((end, 3), dtype=np.int32)])
            self.slots[end - len(self.new):end] = self.new
            self.new = []
        return np.bincount(self.slots[numbers].ravel(), minlength=TEXT)


@lru_cache(maxsize=1)
def _words() -> list[_Words]:
    return [_Words()]


def text_features(words: list[bytes]) -> np.ndarray:
    """Unit vector of the square roots of the words' hashed features."""
    if not words:
        return np.zeros(TEXT)
    held = _words()
    if len(held[0]) > 200_000:
        held[0] = _Words()
    x = np.sqrt(held[0].features(words))
    return x / np.linalg.norm(x)


def page_features(page: bytes, words: list[bytes], lang: str | None, source: str | None) -> np.ndarray:
    """Language, source and the page's size and layout, without its words."""
    x = np.zeros(PAGE)
    x[_slot(b"l", (lang or "").encode(), 32)] = 0.5
    x[32 + _slot(b"o", (source or "").encode(), 32)] = 0.5
    size, n, lines = max(len(page), 1), max(len(words), 1), page.split(b"\n")
    upper, marks, digits = (len(page) - len(page.translate(None, kind)) for kind in (_UPPER, _MARKS, _DIGITS))
    measures = [
        upper / size, marks / size, digits / size, len(set(words)) / n, len(set(lines)) / len(lines),
        sum(map(len, words)) / n / 10, n / len(lines) / 100, np.log1p(size) / 15,
    ]
    for i, value in enumerate(measures):
        # A measure fills the bins around it, so that the classifier can bend.
        at = 64 + 8 * i
        x[at] = min(value, 1.0)
        x[at + 1: at + 8] = np.maximum(0, 1 - np.abs(min(value, 1.0) - _KNOTS) / 0.2)
    return x


_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_UPPER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_MARKS = b"!\"#$%&'()*+/:;<=>?@[\\]^_`{|}~"
_KNOTS = np.array([0.0, 0.05, 0.1, 0.2, 0.4, 0.6, 0.9])


def views(text: str | None, lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
    page = (text or "").encode("utf-8", "surrogatepass")
    words = page.split()
    return text_features(words), page_features(page, words, lang, source)


@dataclass
class Sparse:
    """Rows of a matrix of `TEXT` columns by their values other than zero."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int

    @property
    def shape(self) -> tuple[int, int]:
        return self.rows, TEXT

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.column] * self.value, minlength=self.rows)


def packed(text: np.ndarray, page: np.ndarray) -> bytes:
    """Both views of a document as bytes: where the text's features are, these, and the page's."""
    there = np.flatnonzero(text)
    return there.astype("<u2").tobytes() + text[there].astype("<f2").tobytes() + page.astype("<f2").tobytes()


def unpacked(blobs: list[bytes]) -> tuple[Sparse, np.ndarray]:
    sizes = np.array([(len(b) - 2 * PAGE) // 4 for b in blobs], dtype=np.int64)
    joined = lambda parts, kind: np.frombuffer(b"".join(parts), dtype=kind)
    text = Sparse(
        np.repeat(np.arange(len(blobs)), sizes),
        joined((b[: 2 * n] for b, n in zip(blobs, sizes)), "<u2").astype(np.int64),
        joined((b[2 * n: 4 * n] for b, n in zip(blobs, sizes)), "<f2").astype(float), len(blobs),
    )
    return text, joined((b[4 * n:] for b, n in zip(blobs, sizes)), "<f2").astype(float).reshape(-1, PAGE)


def _packed_views():
    @F.arrow_udf("binary")
    def features(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            rows = []
            for start in range(0, len(columns[0]), 500):
                rows += [packed(*views(*r)) for r in zip(*(c.slice(start, 500).to_pylist() for c in columns))]
            yield pa.array(rows, pa.binary())
        _words.cache_clear()
        release_memory()

    return features


def features(text: Column, lang: Column, source: Column) -> Column:
    """Both views of a whole document, packed."""
    return _packed_views()(text, lang.cast("string"), source.cast("string"))


@dataclass
class Linear:
    """Logistic regression, with a calibrated slope and offset."""

    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.offset

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.margin(x) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 120, weight: np.ndarray | None = None
) -> Linear:
    """Accelerated gradient descent on the (weighted) mean logistic loss."""
    x = x.astype("f4", copy=False)
    weight = np.ones(len(y)) if weight is None else weight
    n = max(weight.sum(), 1e-9)
    w, v, b, c = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0.0, 0.0
    step = 4 / (np.einsum("ij,ij->i", x, x).max(initial=1.0) + 1 + 4 * ridge)
    for i in range(steps):
        miss = weight * (_sigmoid(x @ v.astype("f4") + c) - y)
        new_w = v - step * (miss.astype("f4") @ x / n + ridge * v)
        new_b = c - step * (miss.sum() / n + ridge * c)
        v, c = new_w + i / (i + 3) * (new_w - w), new_b + i / (i + 3) * (new_b - b)
        w, b = new_w, new_b
    return Linear(w, float(b))


def calibrate(model: Linear, x: np.ndarray, y: np.ndarray) -> Linear:
    """Platt scaling on documents the model hasn't seen."""
    if len(set(y.tolist())) < 2:
        return model
    margin = model.margin(x)
    spread = margin.std() or 1.0
    scaled = fit(((margin - margin.mean()) / spread)[:, None], y, ridge=1e-3, steps=300)
    slope = max(float(scaled.weights[0]), 0.0) / spread
    return Linear(model.weights, model.offset, slope, scaled.offset - slope * margin.mean())


@dataclass
class CoTrained:
    text: Linear
    page: Linear

    def score(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        """Probability of good quality from both calibrated views."""
        return _sigmoid(self.text.calibrated(text) + self.page.calibrated(page))


@dataclass
class Taught:
    """What the views teach each other in a round: sums and numbers of documents by cell.

    ``sums`` and ``count`` are kept by the learning view, for the class and confidence the other
    view gives; ``pool`` counts all documents seen.
    """

    widths: tuple[int, int]
    pool: int = 0
    count: list[np.ndarray] = field(init=False)
    sums: list[np.ndarray] = field(init=False)

    def __post_init__(self):
        self.count = [np.zeros(2 * BINS * PARTS, dtype=np.int64) for _ in self.widths]
        self.sums = [np.zeros((2 * BINS * PARTS, width), dtype=np.int64) for width in self.widths]

    def add(self, models: list[Linear], xs: tuple, part: np.ndarray, confidence: float) -> None:
        """Documents by both views, with a part of their own each."""
        least = np.log(confidence / (1 - confidence))
        self.pool += len(part)
        for view, x in enumerate(xs):
            margin = models[1 - view].margin(xs[1 - view])
            step = np.minimum((np.abs(margin) - least) / WIDTH, BINS - 1)
            sure = step >= 0
            cell = ((margin > 0) * BINS + np.maximum(step, 0).astype(np.int64)) * PARTS + part
            cells, width = len(self.count[view]), self.widths[view]
            self.count[view] += np.bincount(cell[sure], minlength=cells)
            if isinstance(x, Sparse):
                at = sure[x.row]
                flat = cell[x.row[at]] * width + x.column[at]
                total = np.bincount(flat, weights=x.value[at] * UNIT, minlength=cells * width).reshape(cells, width)
            else:
                total = np.zeros((cells, width))
                np.add.at(total, cell[sure], np.rint(x[sure] * UNIT))
            self.sums[view] += total.astype(np.int64)

    def examples(self, view: int, share: float, weight: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Means of cells, their class and weight: the most confident ``share`` of the pool per class.

        The whole pool would weigh ``weight``. Of the last step of confidence, all documents count in part.
        """
        count = self.count[view].reshape(2, BINS, PARTS)
        used = np.zeros(count.shape)
        for label in (0, 1):
            room = max(1.0, share * self.pool)
            for step in reversed(range(BINS)):
                here = count[label, step].sum()
                used[label, step] = count[label, step] * min(1.0, room / max(here, 1))
                room = max(room - here, 0.0)
        at = np.flatnonzero(used.ravel())
        means = self.sums[view][at] / (UNIT * self.count[view][at, None])
        return means, (at >= BINS * PARTS).astype(float), used.ravel()[at] * weight / max(self.pool, 1)


def _co_trained(
    xs: tuple[np.ndarray, np.ndarray], y: np.ndarray, teach: Callable[[list[Linear]], Taught],
    *, rounds: int, share: float, trust: float,
) -> CoTrained | None:
    if len(set(y.tolist())) < 2:
        return None
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), dtype=bool)
    own, one = y[~held], np.ones((~held).sum())
    models = [fit(x[~held], own) for x in xs]
    for i in range(rounds):
        taught = teach(models)
        if not taught.pool:
            break
        models = []
        for view, x in enumerate(xs):
            means, label, weight = taught.examples(view, share * (i + 1), trust * len(own))
            models.append(
                fit(np.concatenate([x[~held], means]), np.concatenate([own, label]), weight=np.concatenate([one, weight]))
            )
    return CoTrained(*(calibrate(m, x[held], y[held]) if held.any() else m for m, x in zip(models, xs)))


def co_train(
    text: np.ndarray, page: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_page: np.ndarray,
    *, rounds: int = 3, share: float = 0.1, confidence: float = 0.95, trust: float = 1.0,
) -> CoTrained | None:
    """Two views that teach each other. None, if the labels are all the same.

    One labelled document in four is held out for calibration. In round i a view hands over at
    most ``i * share`` of the pool per class, of those it holds with ``confidence`` or more. All of
    the pool would weigh ``trust`` times as much as the labelled documents, however large it is.
    """

    def teach(models: list[Linear]) -> Taught:
        taught = Taught((text.shape[1], page.shape[1]))
        taught.add(models, (pool_text, pool_page), np.arange(len(pool_text)) % PARTS, confidence)
        return taught

    return _co_trained((text, page), y, teach, rounds=rounds, share=share, trust=trust)


def _merged(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """view, cell, n and sums of tasks in; a row per view and cell out."""
    held: dict[tuple[int, int], list] = {}
    for frame in frames:
        for view, cell, n, sums in zip(*(c.to_pylist() for c in frame.columns)):
            values = np.frombuffer(sums, dtype="<i8")
            known = held.get((view, cell))
            held[view, cell] = [n, values.copy()] if known is None else [known[0] + n, known[1] + values]
    yield _cells([(*at, n, sums) for at, (n, sums) in held.items()])


def _cells(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3].astype("<i8").tobytes() for r in rows], pa.binary()),
        ],
        ["view", "cell", "n", "sums"],
    )


CELLS = "view int, cell int, n long, sums binary"


def _taught(docs: DataFrame, models: list[Linear], known: list[int], confidence: float) -> Taught:
    """What both views teach over all documents but the known ones. ``docs``: doc_id, features."""
    widths, known_ids = (TEXT, PAGE), pa.array(known, pa.int64())

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taught = Taught(widths)
        for frame in frames:
            blobs = frame.filter(pc.invert(pc.is_in(frame.column(0), known_ids))).column(1).to_pylist()
            for start in range(0, len(blobs), 500):
                some = blobs[start: start + 500]
                taught.add(models, unpacked(some), np.array([zlib.crc32(b) % PARTS for b in some]), confidence)
        rows = [
            (view, int(cell), int(taught.count[view][cell]), taught.sums[view][cell])
            for view in (0, 1) for cell in np.flatnonzero(taught.count[view])
        ]
        yield _cells([*rows, (2, 0, taught.pool, np.zeros(0))])
        del taught, rows
        release_memory()

    merged = docs.select("doc_id", "features").mapInArrow(sums, CELLS).repartition("view", "cell").mapInArrow(_merged, CELLS)
    whole = Taught(widths)
    for row in merged.collect():  # a row per view and cell, whatever the table's size
        if row.view == 2:
            whole.pool = row.n
        else:
            whole.count[row.view][row.cell] = row.n
            whole.sums[row.view][row.cell] = np.frombuffer(row.sums, dtype="<i8")
    return whole


def _trained(
    docs: DataFrame, labels: DataFrame, *, labelled: int = 3000, rounds: int = 3, share: float = 0.1,
    confidence: float = 0.95, trust: float = 1.0,
) -> CoTrained | None:
    """As `train`, of a written table of doc_id and features."""
    known = (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    )
    quality = {r.doc_id: r.quality for r in known.orderBy(F.xxhash64("doc_id")).limit(labelled).collect()}
    # ``ids`` holds as many rows as the sample, a parameter.
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(quality)], "doc_id long")
    rows = (
        docs.select("doc_id", "features").join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id").agg(F.min("features").alias("features")).collect()
    )
    rows.sort(key=lambda r: xxhash.xxh3_64_intdigest(str(r.doc_id)))
    if not rows:
        return None
    text, page = unpacked([r.features for r in rows])
    dense = np.zeros(text.shape, dtype="f4")
    dense[text.row, text.column] = text.value
    y = np.array([quality[r.doc_id] for r in rows], dtype=float)
    return _co_trained(
        (dense, page.astype("f4")), y, lambda models: _taught(docs, models, sorted(quality), confidence),
        rounds=rounds, share=share, trust=trust,
    )


def train(docs: DataFrame, labels: DataFrame, **settings) -> CoTrained | None:
    """Co-train on at most ``labelled`` labelled documents, those with the smallest hash, and all others.

    ``docs``: doc_id, text, lang, source; ``labels``: doc_id, quality (0 or 1; others are left out, as
    are documents labelled both ways). The other settings are those of `co_train`.
    """
    both = features(F.col("text"), F.col("lang"), F.col("source"))
    return _trained(written(docs.select("doc_id", both.alias("features")), "views"), labels, **settings)


def scored(
    docs: DataFrame, model: CoTrained | None, carried: list[str],
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """A struct ``row`` of the carried columns and ``score``, the probability of good quality.

    Every row is scored, repeated ones alike. Null and empty texts are scored by what is known of
    them; a null language or source is a level of its own. Without a model the score is null.
    """

    # Only features and scores come back from Python; the carried columns stay where they are.
    row = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")
    return docs.select(row, _score(model, features(F.col(text), F.col(lang), F.col(source))).alias("score"))


def _score(model: CoTrained | None, both: Column) -> Column:
    if model is None:
        return F.lit(None).cast("double")

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            values = []
            for start in range(0, len(column), 500):
                values += model.score(*unpacked(column.slice(start, 500).to_pylist())).tolist()
            yield pa.array(values, pa.float64())

    return score(both)


def kept(least: float = 0.35):
    """Whether a score is kept; documents without one are."""
    return F.coalesce(F.col("score") >= least, F.lit(True))


def classify(
    docs: DataFrame, labels: DataFrame, carried: list[str], *, beside: bool = False, **names: str
) -> DataFrame:
    """Train on the labels and score all documents: ``row``, ``score``, ``kept``.

    The views are written for the rounds and made again for the scores; with ``beside`` the carried
    columns are written beside them, so that they are made once. That suits narrow columns: whole
    texts would cost executors more memory than the second pass costs time.
    """
    own = {"doc_id": "doc_id", "text": "text", "lang": "lang", "source": "source"} | names
    both = features(*[F.col(own[c]) for c in ("text", "lang", "source")])
    row = [F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row")] if beside else []
    viewed = written(docs.select(*row, F.col(own["doc_id"]).cast("long").alias("doc_id"), both.alias("features")), "views")
    model = _trained(viewed, labels.select("doc_id", "quality"))
    if beside:
        got = viewed.select("row", _score(model, F.col("features")).alias("score"))
    else:
        names.pop("doc_id", None)
        got = scored(docs, model, carried, **names)
    return got.withColumn("kept", kept())
