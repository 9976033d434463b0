"""Token ids on disk: one zstandard frame per document under a shared dictionary.

A store is a folder with three Parquet tables, written and read by Spark:

``blocks``      a row holds consecutive documents: their ids, token counts, the offset of
                each frame (one more than documents), the frames one after the other, the hash
                of the dictionary, and the tokens before the block within its part.
``parts``       tokens before each part (one row per write task).
``dictionary``  the shared dictionary and its hash.

A single document is read by its block's range of ids and its two offsets; no other frame is
decompressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.tokens import batches, encoder, gathered

BLOCKS = (
    "part int, block int, first_doc long, last_doc long, n_docs long, n_tokens long, before long,"
    " dictionary string, doc_ids array<long>, counts array<long>, offsets array<long>, frames binary"
)
TOKENS = "doc_id long, part int, local_start long, n_tokens long, ids binary"


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(
    docs: DataFrame, tokenizer: str, rule: str | None, doc_id: str = "doc_id", text: str = "text",
    *, width: int = 2, size: int = 32_768, documents: int = 2_000, piece: int = 8_192, seed: int = 11,
) -> bytes:
    """A dictionary trained on serialised ids of at most ``documents`` pieces of documents.

    The sample is spread over the whole table: about as many documents as wanted pass a threshold on
    a hash of id and text, and of these the smallest hashes stay. Tasks encode their whole texts, and
    a hash says which piece of at most ``piece`` bytes of ids is taken. That bounds the training
    only, on the driver with 16 MB at most; the dictionary changes the size of the frames, never
    what is read back. Where the sample is small, so is the dictionary: an eighth of it. Empty, if
    there are no texts to learn from.
    """
    mark = F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text))
    share = min(1.0, 1.5 * documents / max(docs.count(), 1))
    some = docs.where(F.length(text) > 0).select(mark.alias("mark"), F.col(text).alias("text")).where(
        (F.col("mark") / F.lit(2.0**63)).between(-share, share)
    )

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, rule).encode
        for frame in gathered(frames):
            marks, pieces = frame.column(0).to_pylist(), []
            for a, b in batches(frame.column(1)):
                for key, ids in zip(marks[a:b], encode(frame.column(1).slice(a, b - a))):
                    data = _narrow(ids, width)
                    start = (key >> 8) % max(1, (len(data) - piece) // width + 1) * width
                    pieces.append(data[start:start + piece])
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(pieces, pa.binary())], ["mark", "ids"])

    sample = some.mapInArrow(cut, "mark long, ids binary").orderBy(F.abs("mark"), "ids").limit(documents)
    pieces = [bytes(r.ids) for r in sample.collect() if len(r.ids) >= 8]
    # The trainer refuses samples that are few or alike; with fewer bytes a smaller one can be had.
    for some_size in (min(size, sum(map(len, pieces)) // 8), 1024, 256):
        try:
            if some_size >= 256:
                return zstandard.train_dictionary(some_size, pieces).as_bytes()
        except zstandard.ZstdError:
            continue
    # Too little for the trainer: the sample itself is the dictionary's content.
    return b"".join(pieces)[-size:]


def _dictionary(data: bytes, level: int = 3) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    dictionary = zstandard.ZstdCompressionDict(data)
    dictionary.precompute_compress(level=level)
    return dictionary


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, rule: str | None = None,
    doc_id: str = "doc_id", text: str = "text",
    *, end_id: int = 0, width: int = 2, dictionary: bytes = b"", level: int = 3,
    block_bytes: int = 4 << 20, parts: int | None = None,
) -> None:
    """Encode every whole text, add ``end_id``, and write the store in ascending order of ids.

    Null and empty texts hold the end id alone. Rows with a null id come first; rows of one id
    are ordered by their text, and equal rows follow each other, each with its own frame. Other
    columns are ignored. An empty table gives a store without blocks. ``width`` is the bytes of
    a stored id, 2 for vocabularies up to 65,536. A task holds one block and one Arrow batch.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    digest = hashlib.sha256(dictionary).hexdigest()
    end = np.array([end_id], dtype="<u4").tobytes()

    def blocks(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, rule).encode
        compress = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary, level)).compress
        part = TaskContext.get().partitionId()
        number, before, size, held, ids, counts = 0, 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            known = [i for i in ids if i is not None]
            row = [
                part, number, min(known, default=None), max(known, default=None), len(ids),
                sum(counts), before, digest, ids, counts, offsets.tolist(), b"".join(held),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

        for frame in gathered(frames, 16 << 20):
            texts = frame.column(1)
            keys = frame.column(0).to_pylist()
            for a, b in batches(texts, 32 << 20):
                for key, x in zip(keys[a:b], encode(texts.slice(a, b - a))):
                    x += end
                    ids.append(key)
                    counts.append(len(x) // 4)
                    held.append(compress(_narrow(x, width)))
                    size += len(held[-1])
                    if size >= block_bytes:
                        yield block()
                        number, before, size = number + 1, before + sum(counts), 0
                        held, ids, counts = [], [], []
        if ids:
            yield block()

    names = [c.split(" ")[0] for c in BLOCKS.split(", ")]
    longs = pa.list_(pa.int64())
    kinds = [
        pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
        pa.string(), longs, longs, longs, pa.binary(),
    ]
    (
        docs.select(
            F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
        )
        .repartitionByRange(parts, "id", F.xxhash64("text"))
        .sortWithinPartitions("id", F.xxhash64("text"), "text")
        .mapInArrow(blocks, BLOCKS)
        .write.parquet(f"{path}/blocks")
    )
    # One row per write task: the window over all of them is bounded by the number of parts.
    (
        spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
        .select("part", (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("base"))
        .write.parquet(f"{path}/parts")
    )
    spark.createDataFrame(
        [(digest, bytearray(dictionary), width)], "dictionary string, data binary, width int"
    ).write.parquet(f"{path}/dictionary")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of a store: doc_id, start, n_tokens and ids (little-endian unsigned 32-bit).

    With ``doc_ids`` (a short list) only blocks whose range holds one of them are read, and
    only their frames are decompressed. Blocks under another dictionary than the store's raise.
    """
    digest, data, width = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(data)
    wanted = None if doc_ids is None else frozenset(doc_ids)

    def documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        for batch in rows:
            for row in batch.to_pylist():
                if row["dictionary"] != digest:
                    raise ValueError("the block was written under another dictionary")
                out, size, start = [], 0, row["before"]
                offsets, frames = row["offsets"], row["frames"]
                for i, (key, count) in enumerate(zip(row["doc_ids"], row["counts"])):
                    if wanted is None or key in wanted:
                        ids = _wide(decompress(frames[offsets[i]:offsets[i + 1]]), width)
                        out.append((key, row["part"], start, count, ids))
                        size += len(ids)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out, size = [], 0
                    start += count
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    names = [c.split(" ")[0] for c in TOKENS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    blocks = spark.read.parquet(f"{path}/blocks")
    if doc_ids is not None:
        near = F.lit(False)
        for i in doc_ids:
            near |= (F.col("first_doc") <= i) & (F.col("last_doc") >= i)
        blocks = blocks.where(near)
    blocks = blocks.select("part", "before", "dictionary", "doc_ids", "counts", "offsets", "frames")
    # A row per write task of the store.
    parts = spark.read.parquet(f"{path}/parts")
    return (
        blocks.mapInArrow(documents, TOKENS).join(F.broadcast(parts), "part")
        .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids")
    )
