import random

import numpy as np
import pytest

from tidemill.llm import near_dup, queries
from tidemill.llm.components import components

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, node int"


def brute_force(rows):
    """n_shingles and the smallest id reachable, from all pairs of sets of word tuples."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = len(words)
        sets.append({tuple(words[i:i + 5]) for i in range(n - 4)} if n >= 5 else {tuple(words)} if n else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {key: (len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows)}


def result(spark, rows):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    return near_dup.grouped(docs).collect()


def edited(rng, words, share):
    return [rng.choice("pqrstuvwxyz") * 3 if rng.random() < share else w for w in words]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = brute_force([(r.doc_id, r.text) for r in docs])
    got = queries.op6_near_duplicates(spark, DATA).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies_and_a_shared_passage(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=120)
    passage = rng.choices(vocabulary, k=50)
    texts = [" ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.04, 0.06]))) for _ in range(150)]
    texts += [" ".join(passage + rng.choices(vocabulary, k=40)) for _ in range(100)]
    texts += [texts[3]] * 20
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute_force(rows)
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    for block in (near_dup.BLOCK, 16):
        monkeypatch.setattr(near_dup, "BLOCK", block)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, rows)} == want


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two THREE"), (5, "one  two three"), (6, "one two"),
        (None, "one two three"), (7, "x" * 100_000), (8, "y " * 50_000), (9, "Y " * 60_000), (9, "Y " * 60_000),
        (10, "É a b c d e"), (11, "é a b c d e"),
    ]
    got = result(spark, rows)
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows)
    assert by_id[1] == (0, 1, True) and by_id[2] == (0, 2, True) and by_id[3] == (0, 3, True)
    assert by_id[4] == (1, 4, True) and by_id[5] == (1, 4, False) and by_id[6] == (1, 6, True)
    assert by_id[None] == (1, None, True)
    assert by_id[7] == (1, 7, True) and by_id[8] == (1, 8, True) and by_id[9] == (1, 8, False)
    assert by_id[11][1] == 11
    assert result(spark, []) == []


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (3, None), (None, "a b c d e f"), (None, None)]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    left = near_dup.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 3]
    assert near_dup.deduplicated(docs.limit(0)).count() == 0


def test_posterior_bounds():
    table = near_dup.least_matches(75, 1e-5)
    assert len(table) == near_dup.HASHES // near_dup.BATCH and all(a < b for a, b in zip(table, table[1:]))
    rng = np.random.default_rng(3)
    left = rng.integers(0, 256, (2000, near_dup.HASHES), dtype=np.uint8)
    equal = rng.random((2000, near_dup.HASHES))
    right = np.where(equal < 0.78, left, left ^ 1).astype(np.uint8)
    assert len(near_dup.surviving(left, right, table)) >= 1998
    right = np.where(equal < 0.5, left, left ^ 1).astype(np.uint8)
    assert len(near_dup.surviving(left, right, table)) == 0


def test_signatures_estimate_the_similarity():
    rng = random.Random(2)
    words = [f"w{rng.random()}" for _ in range(600)]
    a, b = near_dup.shingles(" ".join(words[:500])), near_dup.shingles(" ".join(words[60:560]))
    both = len(np.intersect1d(a, b))
    j = both / (len(a) + len(b) - both)
    (_, x), (_, y) = near_dup.sketch(a), near_dup.sketch(b)
    rate = np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8))
    assert abs(rate - j) < 0.12


@pytest.mark.parametrize("held", [500_000, 7])
def test_components_match_union_find(spark, monkeypatch, held):
    from tidemill.llm import components as module

    monkeypatch.setattr(module, "HELD", held)
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert components(frame.limit(0)).count() == 0


def test_the_row_that_stays_of_one_id_does_not_depend_on_the_layout(spark):
    text = "one two three four five six seven"
    rows = [(1, text, f"c{i}") for i in range(6)] + [(2, text, "d"), (None, text, "n"), (3, None, "x"), (3, None, "y")]
    kept = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        frame = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)
        kept.add(tuple(sorted(map(str, near_dup.deduplicated(frame).collect()))))
    assert len(kept) == 1 and len(kept.pop()) == 3
