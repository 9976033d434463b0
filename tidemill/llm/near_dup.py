"""Near-duplicate documents: MinHash bands, Bayesian pruning of signatures, exact verification.

1. Each distinct shingle set gets a signature; a band is a hash of consecutive values of it.
   Documents of one set are one node, named by their smallest id.
2. Sets that share a band are candidates. First every member of a band's bucket is compared
   with the bucket's smallest member only; links give components.
3. Then members of a bucket in different components are compared with each other, in blocks
   of bounded size inside a task, so that no pairs are emitted within a group: by their signatures
   first, and with their sets where a block has members that these don't part.
4. Every comparison reads the signatures in batches and stops as soon as the posterior
   probability of the wanted similarity falls below the chosen miss probability. What survives
   is decided on the full sets.

Links inside a component that is already known aren't looked for: they change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import release_memory
from tidemill.llm.components import components
from tidemill.session import written

WORDS = 5
PERCENT = 75
BANDS, ROWS = 48, 6  # a pair at 0.75 shares no band with probability 8e-5, at 0.8 with 5e-7
HASHES = BANDS * ROWS
BATCH = 32
BLOCK, BLOCK_BYTES = 512, 16 << 20  # members of a bucket, and their sets, in one piece
SMALL = 1_000_000  # ids (8 bytes each) that may be sent to every task

_RANDOM = np.random.Generator(np.random.PCG64(75))
_STEP = _RANDOM.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)
_A = _RANDOM.integers(0, 2**32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)
_B = _RANDOM.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_ROW = _RANDOM.integers(0, 2**64, (1, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _RANDOM.integers(0, 2**64, BANDS, dtype=np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """64-bit hashes of words; emptied when it has grown."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            self[word] = value
        return value


_words = _Words()


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a whole text: five words, or all if there are fewer.

    A-Z is lower-cased; words are parted by the six ASCII white-space characters.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(_words) > 250_000:
        _words.clear()
    hashes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(words))], dtype=np.uint64)
    n = len(words) - WORDS + 1
    return np.unique(_mixed(sum(hashes[i:i + n] * _STEP[i] for i in range(WORDS))))


def sketch(values: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Band hashes and a signature of one byte per hash function, of a set that isn't empty."""
    least = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    narrow = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(narrow), 512):
        least = np.minimum(least, (_A * narrow[i:i + 512] + _B).min(axis=1))
    bands = _mixed((least.reshape(BANDS, ROWS).astype(np.uint64) * _ROW).sum(axis=1) + _BAND)
    low = ((least ^ (least >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(24)
    return bands.view(np.int64), low.astype(np.uint8).tobytes()


def least_matches(percent: int = PERCENT, miss: float = 1e-5) -> list[int]:
    """For 32, 64, ... compared values: the fewest matches that aren't pruned.

    With a uniform prior, the posterior probability of a match rate of t or more after m of n
    matches is that of at most m successes in n + 1 trials of probability t. Bytes of different
    minima are equal once in 256.
    """
    t = percent / 100 + (1 - percent / 100) / 256
    table = []
    for n in range(BATCH, HASHES + 1, BATCH):
        cdf, m = 0.0, -1
        while cdf < miss:
            m += 1
            cdf += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        table.append(m)
    return table


def surviving(left: np.ndarray, right: np.ndarray, table: list[int]) -> np.ndarray:
    """Positions of the signature pairs that no batch prunes."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int32)
    for k, least in enumerate(table):
        batch = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, batch] == right[alive, batch]).sum(axis=1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), HASHES)


def _batch(columns: dict[str, tuple[list | np.ndarray, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in columns.values()], list(columns)
    )


FEATURES = "doc_id long, n_shingles long, same_a long, same_b long, bands array<long>, signature binary"


def _features(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        ids, texts = frame.column(0).to_pylist(), frame.column(1)
        for start in range(0, len(ids), 2000):
            rows = []
            for key, text in zip(ids[start:start + 2000], texts.slice(start, 2000)):
                values = shingles(text.as_py())
                if not len(values):
                    rows.append((key, 0, None, None, None, None))
                    continue
                same = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), dtype=np.int64)
                bands, signature = sketch(values)
                rows.append((key, len(values), int(same[0]), int(same[1]), bands, signature))
            long = pa.int64()
            kinds = [long, long, long, long, pa.list_(long), pa.binary()]
            names = [c.split(" ")[0] for c in FEATURES.split(", ")]
            yield _batch({n: (list(c), k) for n, c, k in zip(names, zip(*rows), kinds)})
    _words.clear()
    release_memory()


def _pruned(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both signatures in, pairs that survive out."""
    table = least_matches()
    for frame in frames:
        if frame.num_rows:
            keep = surviving(_signatures(frame.column(2)), _signatures(frame.column(3)), table)
            yield frame.select([0, 1]).take(pa.array(keep))


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return bool(100 * both >= PERCENT * (len(left) + len(right) - both))


def _verified(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts in, sorted by the left id; links out."""
    held, left = None, None
    for frame in frames:
        keep = []
        for i in range(frame.num_rows):
            key = (frame.column(0)[i].as_py(), text := frame.column(2)[i].as_py())
            if key != held:
                held, left = key, shingles(text)
            if similar(left, shingles(frame.column(3)[i].as_py())):
                keep.append(i)
        yield frame.select([0, 1]).take(pa.array(keep, pa.int64()))
    _words.clear()
    release_memory()


ALIVE = "key long, one int, two int, node long, component long, piece int"


def _across(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of buckets in, sorted by bucket and block; links between other components out.

    Columns: key, one, two (the block's pieces), node, component, piece, signature, bands, set. A
    pair is compared in the bucket of the first band it shares, and nowhere else. Without the sets,
    what comes out are the members, as `ALIVE`, of pairs that the signatures don't prune.
    """
    table = least_matches()

    def pairs_of(rows: list) -> tuple[np.ndarray, np.ndarray]:
        component = np.array([r[4] for r in rows])
        if rows[0][1] == rows[0][2]:
            a, b = np.triu_indices(len(rows), 1)
        else:
            piece = np.array([r[5] for r in rows])
            a, b = (x.ravel() for x in np.meshgrid(
                np.flatnonzero(piece == rows[0][1]), np.flatnonzero(piece == rows[0][2]), indexing="ij"
            ))
        other = component[a] != component[b]
        return a[other], b[other]

    def links(held: list, pairs: list) -> Iterator[pa.RecordBatch]:
        key, node = np.array([r[0] for r in held]), np.array([r[3] for r in held])
        marks = np.frombuffer(b"".join(r[6] for r in held), dtype=np.uint8).reshape(-1, HASHES)
        bands = np.array([r[7] for r in held])
        left = np.concatenate([a for a, _ in pairs])
        right = np.concatenate([b for _, b in pairs])
        found = []
        for i in range(0, len(left), 50_000):
            a, b = left[i:i + 50_000], right[i:i + 50_000]
            first = (bands[a] == bands[b]).argmax(axis=1)
            here = bands[a, first] == key[a]
            a, b = a[here], b[here]
            keep = surviving(marks[a], marks[b], table)
            if len(held[0]) == 8:
                found += np.concatenate([a[keep], b[keep]]).tolist()
                continue
            found += [
                (min(node[x], node[y]), max(node[x], node[y])) for x, y in zip(a[keep], b[keep])
                if node[x] != node[y]
                and similar(np.frombuffer(held[x][8], np.uint64), np.frombuffer(held[y][8], np.uint64))
            ]
        if len(held[0]) == 8:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            names = [c.split(" ")[0] for c in ALIVE.split(", ")]
            alive = sorted({held[x][:6] for x in found})
            yield _batch({n: ([r[i] for r in alive], k) for i, (n, k) in enumerate(zip(names, kinds))})
            return
        yield _batch({"a": ([a for a, _ in found], pa.int64()), "b": ([b for _, b in found], pa.int64())})

    rows, held, pairs, count, size = [], [], [], 0, 0

    def close() -> None:
        nonlocal count, size
        a, b = pairs_of(rows)
        pairs.append((a + len(held), b + len(held)))
        held.extend(rows)
        count += len(a)
        size += sum(len(r[-1]) for r in rows)

    for frame in frames:
        for row in zip(*(c.to_pylist() for c in frame.columns)):
            if rows and row[:3] != rows[0][:3]:
                close()
                rows = []
                if count > 200_000 or len(held) > 20_000 or size > BLOCK_BYTES:
                    yield from links(held, pairs)
                    held, pairs, count, size = [], [], 0, 0
            rows.append(row)
    if rows:
        close()
    if held:
        yield from links(held, pairs)


def _sets(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, text in; node and its set as 64-bit integers out."""
    for frame in frames:
        for i in range(0, frame.num_rows, 1000):
            some = frame.slice(i, 1000)
            sets = [shingles(t.as_py()).tobytes() for t in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.binary())], ["node", "set"])
    _words.clear()
    release_memory()


def _few(ids: DataFrame) -> DataFrame:
    """The written ids, sent to every task if there are few of them."""
    return F.broadcast(ids) if ids.count() <= SMALL else ids


def _links(pairs: DataFrame, texts: DataFrame, purpose: str) -> DataFrame:
    """Pairs (a, b) of nodes whose full sets are similar. ``texts``: node, text."""
    pairs = written(pairs.distinct(), f"{purpose}-pairs")
    wanted = written(
        pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{purpose}-nodes"
    )
    # Only texts that are compared go through the joins.
    some = written(texts.join(_few(wanted), "node", "left_semi"), f"{purpose}-texts")
    both = (
        pairs.join(some.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        .join(some.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
        .sortWithinPartitions("a")
        .select("a", "b", "left", "right")
    )
    return written(both.mapInArrow(_verified, "a long, b long"), f"{purpose}-links")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if the Jaccard similarity of their sets is 0.75 or more;
    ``component_id`` is the smallest id reachable over links and ``kept`` marks that document.
    Null and empty texts, and texts without words, are linked with nothing. Rows with a null id
    have a null component, are linked with nothing and are kept. Rows that share an id count as one
    document with several texts. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    features = written(texts.mapInArrow(_features, FEATURES), "near-features")
    same = ["same_a", "same_b"]
    known = features.where("doc_id is not null and n_shingles > 0")
    # Right sides of joins on keys that may be hot are written: adaptive execution splits a join
    # only if both of its sides come straight from a shuffle.
    nodes = written(known.groupBy(*same).agg(F.min("doc_id").alias("node")), "near-nodes")
    own = F.col("doc_id") == F.col("node")
    placed = written(
        known.join(nodes, same).select(
            "doc_id", "n_shingles", "node",
            F.when(own, F.col("bands")).alias("bands"), F.when(own, F.col("signature")).alias("signature"),
        ),
        "near-placed",
    )
    signed = placed.where("signature is not null").select("node", "signature", "bands")

    rows = placed.select("node", "n_shingles", F.explode("bands").alias("key"))
    shared = written(
        rows.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1"),
        "near-shared",
    )
    buckets = written(rows.join(shared, "key"), "near-buckets")

    by_node = texts.withColumnRenamed("doc_id", "node")
    stars = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    first = _links(
        stars.join(signed.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b")
        .join(signed.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a")
        .select("a", "b", "left", "right").mapInArrow(_pruned, "a long, b long"),
        by_node, "near-stars",
    )
    label = components(first)

    # What the smallest member didn't settle: members of one bucket in different components.
    labelled = written(
        buckets.where("node <> pivot and size > 2").join(label, "node", "left")
        .withColumn("component", F.coalesce("component", "node")), "near-labelled",
    )
    pieces = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES))
    open_ = written(
        labelled.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            pieces.cast("int").alias("pieces"),
        ).where("low < high").select("key", "pieces"),
        "near-open",
    )
    unsettled = written(labelled.join(open_, "key"), "near-unsettled")
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    members = (
        unsettled.join(signed, "node").withColumn("piece", piece)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select(
            "key", F.least("piece", "other").alias("one"), F.greatest("piece", "other").alias("two"),
            "node", "component", "piece", "signature", "bands",
        )
    )
    block = ["key", "one", "two"]

    def compared(rows: DataFrame, schema: str, purpose: str) -> DataFrame:
        dealt = rows.repartition(*block).sortWithinPartitions(*block)
        return written(dealt.mapInArrow(_across, schema), purpose)

    # A bucket goes through all pairs of its pieces with signatures; sets, which are large, are only
    # joined to the members of those blocks in which a pair survives.
    alive = compared(members, ALIVE, "near-alive")
    wanted = written(alive.select("node").distinct(), "near-alive-nodes")
    sets = by_node.join(_few(wanted), "node", "left_semi").mapInArrow(_sets, "node long, set binary")
    whole = written(sets.join(signed, "node"), "near-sets")
    second = compared(
        alive.join(whole, "node").select(*block, "node", "component", "piece", "signature", "bands", "set"),
        "a long, b long", "near-rest",
    )
    label = components(first.unionByName(second))
    alone = features.where("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("node")
    )
    component = F.coalesce("component", "node")
    return (
        placed.select("doc_id", "n_shingles", "node").unionByName(alone).join(label, "node", "left")
        .select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents kept of each group, with their columns as they came.

    Of rows that share a kept id, one stays: that with the smallest md5 of all its columns as JSON,
    whatever the order or layout of the rows. Rows with a null id all stay, and so do documents
    without words, of which each is a group of its own.
    """
    verdict = written(grouped(docs, doc_id, text), "near-verdict")

    def among(ids: DataFrame, how: str, frame: DataFrame) -> DataFrame:
        ids = _few(written(ids.select(F.col("doc_id").alias("_near_id")).distinct(), "near-ids"))
        return frame.join(ids, _quoted(doc_id).cast("long") == F.col("_near_id"), how)

    left = among(verdict.where("not kept"), "left_anti", docs)
    counts = verdict.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    repeated = written(counts.select("doc_id"), "near-repeated")
    if repeated.isEmpty():
        return left
    row = F.struct(*[_quoted(c) for c in docs.columns])
    twice = (
        among(repeated, "left_semi", left).select(_quoted(doc_id).alias("_near_id"), row.alias("_near_row"))
        .groupBy("_near_id").agg(F.min_by("_near_row", F.md5(F.to_json("_near_row"))).alias("_near_row"))
        .select("_near_row.*")
    )
    return among(repeated, "left_anti", left).unionByName(twice)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
