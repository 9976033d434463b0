import hashlib
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemill.llm import queries
from tidemill.llm.packing import differencing, pack, pack_documents, windows_for
from tidemill.llm.token_store import read_tokens, train_dictionary, write_tokens
from tidemill.llm.tokens import ChunkEncoder, batches
from tidemill.llm.wordpiece import Automaton, count_pieces
from tidemill.session import shared_folder

DATA = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \n b", "\na", "a\n", "a\tb c", "x \ty",
    "it's don't 'sx '", "<|endoftext|> a <|startoftext|>", "ab cd ef", "é ́x İI Σ",
    "\x1cab cd\x1d", "1.5, (x). ..!? a,b", "\u3000a b", "word " * 50, "\U0001f600 \U0001f600x",
]


def ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoders():
    return [
        (path, ChunkEncoder(path, rule, 300))
        for path, rule in ((BYTE, "space"), (WORD, "white"), (BYTE, None))
    ]


def check(encoders, texts):
    for path, encoder in encoders:
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert got == ids(path, texts)


def test_chunks_give_the_ids_of_whole_texts(encoders):
    check(encoders, ODD)
    check(encoders, ODD[::-1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x0b'.,sdlé!ab1Á ", max_size=40), max_size=6))
def test_any_text_is_encoded_whole(encoders, texts):
    check(encoders, texts)


def test_batches_hold_every_text_once():
    texts = ["x" * n for n in (5, 1, 9, 30, 2, 2)]
    slices = list(batches(pa.array(texts), 10))
    assert [i for a, b in slices for i in range(a, b)] == list(range(6))
    assert all(sum(map(len, texts[a:b])) <= 10 or b - a == 1 for a, b in slices)
    assert list(batches(pa.array([], pa.string()), 10)) == []


def test_store_round_trip(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    want, start = {}, 0
    for key, x in zip(sorted(rows), ids(BYTE, [rows[k] for k in sorted(rows)])):
        data = np.array([*x, 0], dtype="<u4").tobytes()
        want[key] = (start, len(x) + 1, zlib.crc32(data))
        start += len(x) + 1
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op1_token_store(spark, DATA).collect()}
    assert got == want


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_round_trip_under_a_shared_dictionary(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    dictionary = train_dictionary(docs, BYTE, "space")
    assert len(dictionary) >= 1024
    assert train_dictionary(docs.repartition(7, "lang"), BYTE, "space") == dictionary
    sizes = {}
    for name, used in (("with", dictionary), ("without", b"")):
        path = shared_folder(spark, f"test-tokens-{name}")
        write_tokens(docs, path, BYTE, "space", end_id=0, dictionary=used)
        blocks = spark.read.parquet(f"{path}/blocks")
        assert {r.dictionary for r in blocks.select("dictionary").collect()} == {hashlib.sha256(used).hexdigest()}
        # Short documents are what a shared dictionary is for.
        frames = [
            b - a for r in blocks.select("counts", "offsets").collect()
            for n, a, b in zip(r.counts, r.offsets, r.offsets[1:]) if n < 400
        ]
        sizes[name] = sum(frames)
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        got = {r.doc_id: bytes(r.ids) for r in read_tokens(spark, path).collect()}
        want = ids(BYTE, list(texts.values()))
        assert got == {k: np.array([*x, 0], dtype="<u4").tobytes() for k, x in zip(texts, want)}
    print("bytes of short frames:", sizes)
    assert sizes["with"] < 0.9 * sizes["without"]


def test_the_sample_is_spread_over_the_table(spark):
    # Rows of the second half alone hold words of their own; a sample of the first files would miss them.
    rows = [(i, f"left{i % 50} right{i % 7} " * 40 if i < 500 else f"zebra{i % 50} quartz{i % 7} " * 40) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    dictionary = train_dictionary(docs, BYTE, "space", size=4096, documents=100, piece=64)
    later = ids(BYTE, [t for _, t in rows[500:550]])
    assert any(np.array(x[i:i + 3], "<u2").tobytes() in dictionary for x in later for i in range(20))


def test_store_of_odd_rows_and_single_reads(spark):
    texts = [*ODD, None, "long " * 30_000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a", "x", 1), (3, " a", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, n_tokens int")
    path = shared_folder(spark, "test-tokens")
    dictionary = train_dictionary(docs, BYTE, "space", size=256)
    assert dictionary
    write_tokens(docs, path, BYTE, "space", end_id=0, dictionary=dictionary, block_bytes=64, parts=3)
    got = read_tokens(spark, path).collect()
    by_id = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, bytes(r.ids)) for r in got)
    starts = [r[1] for r in by_id]
    assert starts == [0, *np.cumsum([r[2] for r in by_id])[:-1].tolist()]
    for key, _, n, data in by_id:
        text = "a" if key == -1 else texts[key] or ""
        assert data == np.array([*ids(BYTE, [text])[0], 0], dtype="<u4").tobytes() and n == len(data) // 4
    one = read_tokens(spark, path, [3, 17]).collect()
    assert sorted(r.doc_id for r in one) == [3, 3, 17]
    assert {(r.doc_id, r.start) for r in one} <= {(r.doc_id, r.start) for r in got}


def test_store_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = shared_folder(spark, "test-tokens")
    assert train_dictionary(docs, BYTE, "space") == b""
    write_tokens(docs, path, BYTE, "space")
    assert read_tokens(spark, path).count() == 0


def test_another_dictionary_is_refused(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    path = shared_folder(spark, "test-tokens")
    dictionary = train_dictionary(docs, BYTE, "space", size=4096)
    assert dictionary
    write_tokens(docs, path, BYTE, "space", dictionary=dictionary)
    spark.createDataFrame([("0", bytearray(b""), 2)], "dictionary string, data binary, width int").write.mode(
        "overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        read_tokens(spark, path).count()


def test_differencing_balances():
    assert sorted(np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    assert len(set(differencing(np.array([5, 5, 5]), 3).tolist())) == 3
    sizes = np.random.default_rng(1).integers(1, 500, 300)
    loads = np.bincount(differencing(sizes, 20), weights=sizes, minlength=20)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() < 0.02 * loads.mean()


def test_the_window_count_rises_with_the_load():
    sizes = np.array([60, 60, 60])
    window, count = windows_for(sizes, 100)
    assert count == 3 and len(set(window.tolist())) == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([16, 64, 100]))
def test_packing_holds_every_token_once_without_padding(lengths, capacity):
    sequences = pack(lengths, capacity)
    seen = sorted(piece for s in sequences for piece in s)
    at = 0
    for doc, length in enumerate(lengths):
        start = 0
        while start < length:
            assert seen[at][:2] == (doc, start) and seen[at][2] > 0
            start += seen[at][2]
            at += 1
        assert start == length
    assert at == len(seen)
    for s in sequences:
        size = sum(length for _, _, length in s)
        assert size == capacity or size < capacity and size & (size - 1) == 0


def test_packing_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    keys = sorted(docs)
    tokens = dict(zip(keys, ([*x, 2] for x in ids(WORD, [docs[k] for k in keys]))))
    pieces = queries.op5_packing(spark, DATA).collect()
    seen, sequences = dict.fromkeys(keys, 0), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert seen[p.doc_id] == p.start and p.doc_tokens == len(tokens[p.doc_id])
        data = np.array(tokens[p.doc_id][p.start:p.start + p.length], dtype="<u4").tobytes()
        assert zlib.crc32(data) == p.ids_crc32
        seen[p.doc_id] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert seen == {k: len(tokens[k]) for k in keys}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == 4096 or end & (end - 1) == 0


def test_packing_odd_rows(spark):
    rows = [(None, "a b", 1), (1, None, 1), (1, None, 1), (2, "", 1), (3, "long " * 9000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    got = pack_documents(docs, WORD, "white").collect()
    assert sum(r.length for r in got) == 3 + 1 + 1 + 1 + 9001
    assert all(len(r.ids) == 4 * r.length for r in got)
    assert pack_documents(docs.limit(0), WORD, "white").count() == 0


def greedy(pieces, word):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abcd", max_size=20))
def test_automaton_counts_like_greedy_matching(pieces, word):
    assert Automaton(pieces).count(word) == greedy(set(pieces), word)


def test_token_counts_match_brute_force(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    got = {r.doc_id: r for r in queries.op2_token_counts(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        counts = [greedy(pieces, "▁" + w) for w in (doc.text or "").encode().decode().split()]
        r = got[doc.doc_id]
        assert (r.n_words, r.n_pieces, r.n_unknown) == (
            len(counts), sum(abs(c) for c in counts), counts.count(-1)
        )


def test_token_counts_of_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "the  ͸ the x", 0), (4, "a" * 50_000, 0), (4, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = count_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert [(r.doc_id, r.n_words, r.n_unknown) for r in got][:3] == [(1, 0, 0), (2, 0, 0), (None, 3, 1)]
    assert got[3].n_words == 1 and got[3].n_pieces > 1000 and len(got) == 5
    assert count_pieces(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_only_odd_chunks_are_looked_at_alone(monkeypatch):
    looked, odd = [], ChunkEncoder._odd
    monkeypatch.setattr(ChunkEncoder, "_odd", lambda self, m, f, i: (looked.append(m[i]), odd(self, m, f, i))[1])
    text = " ".join(f"word{i}, x{i}" for i in range(100)) + " a  b"
    encoder = ChunkEncoder(BYTE, "space")
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids(BYTE, [text])[0]
    assert looked == [""]


@pytest.mark.parametrize("path, rule", [(BYTE, "space"), (WORD, "white")])
def test_chunks_cost_no_calls_of_their_own(path, rule):
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{',' * (i % 3)}" for i in range(17_576)]
    text, calls = " ".join(words), []
    encoder = ChunkEncoder(path, rule)
    sys.setprofile(lambda frame, event, arg: event in ("call", "c_call") and calls.append(event))
    try:
        got = encoder.encode([text])
    finally:
        sys.setprofile(None)
    assert np.frombuffer(got[0], "<u4").tolist() == ids(path, [text])[0]
    assert len(calls) < len(words) / 10


def test_a_capital_whose_lower_case_ends_in_a_mark_stays_with_its_punctuation():
    texts = ["aİ. İ, x", "İİ! a", "b İ-"]
    for path, rule in ((BYTE, "space"), (WORD, "white")):
        got = [np.frombuffer(x, "<u4").tolist() for x in ChunkEncoder(path, rule).encode(texts)]
        assert got == ids(path, texts)


def test_the_cache_drops_parts_that_are_no_longer_in_use():
    encoder = ChunkEncoder(BYTE, "space", 500)
    for i in range(40):
        text = " ".join(f"stay{chr(97 + i % 26)} w{i}x{j}." for j in range(50))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids(BYTE, [text])[0]
        assert len(encoder.parts) == len(encoder.ids) == len(encoder.odd) == len(encoder.used) < 300
