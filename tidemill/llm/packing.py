"""Packing of documents into sequences of a fixed capacity by multiway differencing.

Each task packs runs of consecutive documents (about ``group_tokens`` tokens), so nothing is
shuffled and no task holds more than a run. Within a run:

1. Every full ``capacity`` of a document is a sequence of its own.
2. The rests go through Karmarkar-Karp differencing into as few windows as their tokens need:
   the two partial partitions with the widest spread are merged, the heaviest window of one on
   the lightest of the other, until one is left. While a window exceeds the capacity, the
   window count rises and differencing starts again.
3. The lightest windows beyond those that the tokens can fill are dissolved, and their pieces
   are cut to fill the others up. What is left over is split into powers of two, which need
   no padding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import release_memory
from tidemill.llm.tokens import batches, encoder, gathered

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (from 0) of each size, with near-equal sums, by multiway differencing."""
    n = len(sizes)
    # A partial partition: its sums in descending order and a node per sum; zeros aren't kept.
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    joined, nodes = [], n
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, order, b, right = heapq.heappop(heap)
        # Slot i of a meets slot windows - 1 - i of b.
        alone_a, alone_b = min(len(a), windows - len(b)), min(len(b), windows - len(a))
        both = np.arange(nodes, nodes + len(a) - alone_a)
        nodes += len(both)
        joined.append((both, left[alone_a:], right[alone_b:][::-1]))
        sums = np.concatenate([a[:alone_a], a[alone_a:] + b[alone_b:][::-1], b[:alone_b]])
        slots = np.concatenate([left[:alone_a], both, right[:alone_b]])
        down = np.argsort(-sums, kind="stable")
        sums, slots = sums[down], slots[down]
        spread = int(sums[0] - (sums[-1] if len(sums) == windows else 0))
        heapq.heappush(heap, (-spread, order, sums, slots))
    window = np.empty(nodes, dtype=np.int64)
    if heap:
        window[heap[0][3]] = np.arange(len(heap[0][3]))
    for both, left, right in reversed(joined):
        window[left] = window[right] = window[both]
    return window[:n]


def windows_for(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows by differencing; the count rises until none exceeds the capacity."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, count)
        loads = np.bincount(window, weights=sizes, minlength=count)
        over = loads[loads > capacity] - capacity
        if not len(over):
            return window, count
        count += max(1, int(over.sum() // capacity))


def pack(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token once."""
    sequences, rests = [], []
    for doc, length in enumerate(lengths):
        full = length - length % capacity
        sequences += [[(doc, start, capacity)] for start in range(0, full, capacity)]
        if length > full:
            rests.append((doc, full, length - full))
    if not rests:
        return sequences
    sizes = np.array([length for _, _, length in rests], dtype=np.int64)
    window, count = windows_for(sizes, capacity)
    packed: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    for w, piece in zip(window.tolist(), rests):
        packed[w].append(piece)
    loads = np.bincount(window, weights=sizes, minlength=count).astype(np.int64)
    total = int(sizes.sum())
    heaviest_first = np.argsort(-loads, kind="stable").tolist()
    kept, dissolved = heaviest_first[: total // capacity], heaviest_first[total // capacity:]
    loose = [piece for w in reversed(dissolved) for piece in packed[w]]

    def take(wanted: int) -> list[tuple[int, int, int]]:
        """So many tokens of the loose pieces; the last one is cut."""
        taken = []
        while wanted:
            doc, start, length = loose.pop()
            used = min(length, wanted)
            taken.append((doc, start, used))
            if used < length:
                loose.append((doc, start + used, length - used))
            wanted -= used
        return taken

    for w in kept:
        sequences.append(packed[w] + take(capacity - int(loads[w])))
    left = total % capacity
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            sequences.append(take(1 << bit))
    return sequences


def pack_documents(
    docs: DataFrame, tokenizer: str, rule: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
    *, end_id: int = 2, capacity: int = 4096, group_tokens: int = 1 << 20,
    cached_chars: int = 4_000_000,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers. Every sequence
    holds ``capacity`` tokens or a power of two. Null and empty texts hold the end id alone; rows
    with null or repeated ids are packed like any other, each row a document of its own. Other
    columns are ignored; an empty table gives no piece. Sequence ids are unique and the same
    when a task runs again, but not consecutive across tasks. ``cached_chars`` bounds the chunks of
    text that a worker remembers.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [c.split(" ")[0] for c in PIECES.split(", ")]
    kinds = [*[pa.int64()] * 6, pa.binary()]

    def pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, rule, cached_chars).encode
        sequence = TaskContext.get().partitionId() << 40
        keys, held, tokens = [], [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows = []
            for parts in pack([len(x) // 4 for x in held], capacity):
                offset = 0
                for doc, start, length in parts:
                    ids = held[doc][4 * start: 4 * (start + length)]
                    rows.append((keys[doc], start, length, len(held[doc]) // 4, sequence, offset, ids))
                    offset += length
                sequence += 1
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for frame in gathered(frames):
            texts = frame.column(1)
            ids = frame.column(0).to_pylist()
            for a, b in batches(texts):
                for key, x in zip(ids[a:b], encode(texts.slice(a, b - a))):
                    keys.append(key)
                    held.append(x + end)
                    tokens += len(held[-1]) // 4
                    if tokens >= group_tokens:
                        yield from packed()
                        keys, held, tokens = [], [], 0
            release_memory()
        if held:
            yield from packed()
        keys, held = [], []
        release_memory()

    return docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).mapInArrow(pieces, PIECES)
