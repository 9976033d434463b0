import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import queries
from tidemill.llm.runs import find_runs, kept_words, runs_of

SMALL = "/root/testdata/sf0.001"


def brute(words):
    """All runs by trying every period."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            if length >= max(6, 4 * q) and not any(
                all(words[i] == words[i + d] for i in range(start, start + length - d)) for d in range(1, q)
            ):
                found[start, q] = length
            start = end
    return sorted((s, length, q) for (s, q), length in found.items())


def collapsed(words, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def check(texts):
    sizes = [len(t) for t in texts]
    flat = [w for t in texts for w in t]
    codes = np.array([sorted(set(flat)).index(w) for w in flat], dtype=np.int64)
    start, length, period = runs_of(codes, np.repeat(np.arange(len(texts)), sizes))
    got = list(zip(start.tolist(), length.tolist(), period.tolist()))
    want, base = [], 0
    for t in texts:
        want += [(s + base, n, q) for s, n, q in brute(t)]
        base += len(t)
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), max_size=4))
def test_runs_of_two_words(texts):
    check([list(t) for t in texts])


def test_planted_runs():
    rng = random.Random(3)
    for _ in range(40):
        texts = []
        for _ in range(3):
            words = []
            for _ in range(rng.randint(0, 5)):
                unit = rng.choices("abcdefgh", k=rng.randint(1, 9))
                whole = unit * rng.randint(1, 9)
                words += whole[: max(1, len(whole) - rng.randint(0, len(unit)))] + rng.choices("abcd", k=rng.randint(0, 4))
            texts.append(words)
        check(texts)
    check([["a"] * 5000, [], ["a"] * 6, ["a"] * 5, list("ab") * 3, list("abc") * 400 + ["a", "b"]])


def test_kept_words():
    keep = kept_words(8, np.array([0, 1]), np.array([6, 7]), np.array([1, 2]))
    assert keep.tolist() == [True] + [False] * 7


def test_odd_texts(spark):
    texts = [None, "", " \t\n", "a", "a a a a a a", "a\x0ba\x0ca\ra\na\ta b", "　 　 　 　 　 　", "x\x1cy " * 9, "é " * 50_000]
    rows = [(i if i % 3 else None, t, i) for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = find_runs(docs).collect()
    assert len(got) == len(rows)
    want = []
    for key, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [(0, len(words), 1)] if len(words) > 5 and len(set(words)) == 1 else brute(words)
        want.append((key, len(words), runs, collapsed(words, runs)))
    order = str
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=order) == sorted(want, key=order)
    assert find_runs(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_runs(spark, SMALL).collect()}
    assert got.keys() == docs.keys()
    chosen = 0
    for key, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if len(words) > 1500:
            continue
        h, n = zlib.crc32(str(key).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            chosen += 1
        runs, r = brute(words), got[key]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda x: (x[0], x[2])))
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert chosen > 5
