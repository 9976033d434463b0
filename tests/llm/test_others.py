import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import compare
from tidemill.llm import chat, cotraining, licenses, mixing, quality_rules, queries
from tidemill.llm.topk import competitive, top_k
from tidemill.session import written

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    got = compare.spark_result(queries.QUERIES[name](spark, SMALL))
    assert compare.difference(got, compare.sql_result(compare.connect(SMALL), queries.ORACLES[name])) is None


# -- top-k ----------------------------------------------------------------------


def test_maxscore_prunes_only_what_cannot_compete():
    rng = np.random.default_rng(4)
    for _ in range(50):
        terms = rng.integers(-50, 50, (12, 300)).astype(float) * (rng.random((12, 300)) < 0.4)
        query = rng.integers(-9, 9, 12).astype(float)
        want = query @ terms
        bar = float(np.sort(want)[-7])
        at, scores = competitive(query, terms, terms.min(axis=1), terms.max(axis=1), bar)
        assert at.tolist() == np.flatnonzero(want >= bar).tolist()
        assert scores.tolist() == want[want >= bar].tolist()


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 9), (1, [0.5, 0.5], 9), (2, [0.5, 0.1], 9), (3, [0.5, 0.9], 9), (3, [0.5, 0.9], 9),
        (4, None, 9), (5, [None, 1.0], 9), (6, [nan, 1.0], 9), (7, [inf, 1.0], 9), (8, [1.0], 9),
        (None, [9.0, 9.0], 9), (9, [-1.0, 3.0], 9), (100, [-0.0001, 1e200], 9), (200, [], 9), (300, [], 9),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = top_k(vectors, vectors.where("vec_id % 100 = 0"), 4, shard=3, block_bytes=100).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert by[0] == [(1, 1, 512 * 1024), (2, 2, 512 * 1024), (3, 3, 512 * 1024), (4, 3, 512 * 1024)]
    assert [r[1:] for r in by[100]] == [(i, 2**63 - 1) for i in (1, 2, 3, 3)]
    assert by[200] == [(1, 300, 0)] and by[300] == [(1, 200, 0)]
    assert top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    assert top_k(vectors, vectors.limit(0)).count() == 0


# -- chat format -----------------------------------------------------------------


def test_chat_round_trip_of_odd_turns(spark):
    texts = ["<|im_end|>\n", "<\\|im_end|>", "<", "|x", "<\\\\|", "", None, "a\nb", "long " * 30_000, "é<|"]
    roles = ["user", "assistant", "tool\n<|im_end|>", None, "a b+%"]
    rows = [(1, i, roles[i % 5], t, "x") for i, t in enumerate(texts)]
    rows += [(2, 0, "system", "s", "x"), (2, 1, "user", "u", "x"), (2, 2, "assistant", "a", "x")]
    rows += [(None, None, "user", "u", "x"), (3, 0, "user", "u", "x"), (3, 0, "user", "u", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.read_turns(chat.format_turns(frame)).collect()
    got = {}
    for r in sorted(out, key=lambda r: r.place):
        got.setdefault(r.conv_id, []).append(r)
    assert [(t.role, t.text) for t in got[1]] == [(r or "", t or "") for _, _, r, t, _ in rows[:10]]
    assert "".join(t.loss_text for t in got[1]) == "".join(t or "" for _, _, r, t, _ in rows[:10] if r == "assistant")
    in_order = {k: all(t.legal and (t.ends or not t.last) for t in v) for k, v in got.items()}
    assert in_order == {1: False, 2: True, 3: False, None: False}
    assert [[t.place for t in v if t.last] for v in got.values()] == [[len(v)] for v in got.values()]
    assert [(t.text, t.loss) for t in got[2]] == [("s", False), ("u", False), ("a", True)]
    assert len(got[3]) == 2
    for r in chat.format_turns(frame).collect():
        assert "".join(s.text for s in r.segments).count("<|im_end|>") == 1
    assert chat.format_turns(frame.limit(0)).count() == 0


def test_one_conversation_with_most_rows(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(20_000)] + [(i, 0, "user", "x") for i in range(100, 200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = chat.read_turns(chat.format_turns(frame)).where("conv_id = 7").orderBy("place").collect()
    assert [(r.place, r.text) for r in out] == [(i + 1, f"t{i}") for i in range(20_000)]
    assert all(r.legal for r in out) and [r.place for r in out if r.last] == [20_000]
    with pytest.raises(Exception, match="not a formatted turn"):
        chat.read_turns(spark.sql("select 1 as conv_id, array(named_struct('text', 'x', 'loss', true)) as segments")).collect()


def test_chat_digests(spark):
    row = {r.conv_id: r for r in queries.op8_chat_format(spark, SMALL).collect()}[-1]
    text = queries.CONTROL_TEXT
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# -- quality rules ----------------------------------------------------------------


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_measures_of_odd_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "a", "a b", "a b c a b c", "a a a a a", "a\n\na\n a\na", "\x0b\x0ca\r\nb ", "é#*|<>é", "x" * 50_000]
    texts += [" ".join(rng.choices("abc", k=n)) for n in (10, 60, 300)] + ["w1 w2 w3 w4\n" * 3000]
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", i) for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = quality_rules.judged(docs, ["doc_id", "n_words"]).collect()
    assert len(got) == len(rows)
    for r in got:
        want = measures(texts[r["row"].doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["row"].n_words == r["row"].doc_id
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.quality_filter(docs.limit(0)).count() == 0


def test_bins_keep_their_order_and_error(spark):
    from pyspark.sql import functions as F

    values = [*range(2000), *(2**k + d for k in range(12, 60) for d in (-1, 0, 1))]
    frame = spark.createDataFrame([(v,) for v in sorted(values)], "v long")
    rows = frame.select("v", quality_rules.bin_of(F.col("v")).alias("b")).select(
        "v", "b", quality_rules.least_of(F.col("b")).alias("low")).collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(r.low <= r.v and (r.v - r.low) * 128 <= r.v for r in rows)


def fences(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    rows = quality_rules.with_rates(quality_rules.measured(frame, ["doc_id"], "lang", "source", "text"))
    sketch = quality_rules.sketches(written(rows, "test-rates"))
    names = [f"most_{r}" for r in quality_rules.RATES]
    return {r.source: [r[n] for n in names] for r in quality_rules.limits(sketch).collect()}


def habits(rng, n, symbols, length, lines, shouts, repeats):
    """A text: so many words with such a share of symbols, lines, capitals and repeated phrases."""
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(length - 1, length + 2))) for _ in range(n)]
    for i in range(n):
        if rng.random() < symbols:
            words[i] += "#"
        if rng.random() < shouts:
            words[i] = words[i].upper()
    for _ in range(int(repeats * n / 4)):
        i, j = rng.randrange(n - 4), rng.randrange(n - 4)
        words[i:i + 4] = words[j:j + 4]
    rows = [" ".join(words[i:i + 8]) for i in range(0, n, 8)]
    for i in range(len(rows)):
        if rng.random() < lines:
            rows[i] = rows[0]
    return "\n".join(rows)


def test_fences_follow_the_habits_of_a_source(spark):
    rng = random.Random(4)
    rows = [(i, "en", "plain", habits(rng, 200, 0, 5, 0, 0, 0)) for i in range(400)]
    rows += [(i, "en", "odd", habits(rng, 200, rng.random() * 0.3, rng.randrange(4, 9), rng.random() * 0.3, rng.random() * 0.2, rng.random() * 0.2)) for i in range(400)]
    got = fences(spark, rows)
    assert all(odd > plain for odd, plain in zip(got["odd"], got["plain"]))


def test_a_source_full_of_junk_is_bounded_by_the_table(spark):
    rng = random.Random(4)
    rows = [(i, "en", f"s{i % 4}", habits(rng, 100, 0, 5, 0, 0, 0)) for i in range(1200)]
    rows += [(i, "en", "junk", habits(rng, 100, 0.9 if i % 2 else 0, 5, 0, 0, 0)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    kept = {(r.source, r.text) for r in quality_rules.quality_filter(frame).collect()}
    assert not any(s == "junk" and t.count("#") > 30 for s, t in kept)
    assert sum((s, t) in kept for _, _, s, t in rows if t.count("#") == 0) > 0.99 * 1350


def test_clean_documents_are_kept(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rules = {r.doc_id: r for r in queries.op10_quality_rules(spark, DATA).collect()}
    clean = [rules[i] for i, q in labels.items() if q == 1 and not rules[i].base_failed]
    junk = [rules[i] for i, q in labels.items() if q == 0 and not rules[i].base_failed]
    assert all(r.kept for r in clean)
    assert sum(not r.kept for r in junk) > 0.7 * len(junk)


# -- classifier -------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    test = {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    model = cotraining.train(docs, labels.where("doc_id % 3 <> 0"))
    got = {
        r["row"].doc_id: r.score
        for r in cotraining.scored(docs, model, ["doc_id"]).collect() if r["row"].doc_id in test
    }
    right = [(s >= 0.5) == bool(test[i]) for i, s in got.items()]
    assert np.mean(right) > 0.95
    assert np.mean([s >= 0.35 for i, s in got.items() if test[i]]) > 0.98


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(2000) < 0.5).astype(float)
    one = np.concatenate([rng.normal(y[:, None] * 1.6, 1, (2000, 4)), rng.normal(0, 1, (2000, 20))], axis=1)
    two = np.concatenate([rng.normal(y[:, None] * 3, 1, (2000, 2)), rng.normal(0, 1, (2000, 4))], axis=1)
    few = slice(0, 24)
    alone = cotraining.co_train(one[few], two[few], y[few], one[:0], two[:0])
    both = cotraining.co_train(one[few], two[few], y[few], one[24:1500], two[24:1500])
    accuracy = lambda m: np.mean((m.text.margin(one[1500:]) > 0) == y[1500:])
    assert accuracy(both) > accuracy(alone)


def test_every_document_teaches_whatever_the_layout(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    more = docs.select((F.col("doc_id") + 1_000_000).alias("doc_id"), F.concat("text", F.lit(" more"), "doc_id"), "lang", "source")
    docs = docs.union(more).union(more.withColumn("doc_id", F.col("doc_id") * 2 + 1)).toDF(*docs.columns)
    viewed = written(
        docs.select("doc_id", cotraining.features(F.col("text"), F.col("lang"), F.col("source")).alias("features")), "v"
    )
    rng = np.random.default_rng(3)
    models = [cotraining.Linear(rng.normal(0, 8, n).round(2), 0.0) for n in (cotraining.TEXT, cotraining.PAGE)]
    known = [r.doc_id for r in docs.where("doc_id % 10 = 0").select("doc_id").distinct().collect()]
    first, second = (cotraining._taught(viewed.repartition(n), models, known, 0.95) for n in (1, 7))
    rows = [r for r in viewed.collect() if r.doc_id % 10]
    assert first.pool == second.pool == len(rows) > 2000
    xs = [np.array([x for x in view]) for view in zip(*(
        (lambda t, p: (np.bincount(t.column, t.value, cotraining.TEXT), p[0]))(*cotraining.unpacked([r.features])) for r in rows
    ))]
    margins = [m.margin(x) for m, x in zip(models, xs)]
    for view in (0, 1):
        assert (first.count[view] == second.count[view]).all() and (first.sums[view] == second.sums[view]).all()
        for label, sure in ((0, margins[1 - view] <= -np.log(19)), (1, margins[1 - view] >= np.log(19))):
            half = slice(label * 64, label * 64 + 64)
            assert first.count[view][half].sum() == sure.sum()
            assert np.allclose(first.sums[view][half].sum(axis=0) / cotraining.UNIT, xs[view][sure].sum(axis=0))
        means, label, weight = first.examples(view, 0.1, 100.0)
        for kind, sure in ((0, margins[1 - view] <= -np.log(19)), (1, margins[1 - view] >= np.log(19))):
            want = min(sure.sum(), 0.1 * len(rows)) / len(rows) * 100
            assert abs(weight[label == kind].sum() - want) < 1e-6


def test_classifier_on_odd_tables(spark):
    rows = [(i, None if i % 5 == 0 else "" if i % 5 == 1 else "x " * i, None, "s", "q") for i in range(40)]
    docs = spark.createDataFrame([*rows, (None, "x", "en", None, "q"), rows[7]],
                                 "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = cotraining.classify(docs, labels, ["doc_id", "score"])
    assert got.count() == 42 and got.where("score is null").count() == 0
    beside = cotraining.classify(docs, labels, ["doc_id", "score"], beside=True)
    assert sorted(map(str, beside.collect())) == sorted(map(str, got.collect()))
    none = cotraining.classify(docs, labels.limit(0), ["doc_id"])
    assert none.where("kept and score is null").count() == 42
    assert cotraining.classify(docs.limit(0), labels, ["doc_id"]).count() == 0


# -- mixing -----------------------------------------------------------------------


def test_exponent_meets_the_target(spark):
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "source string, share double")
    p = np.array([0.7, 0.2, 0.1])
    entropy = lambda w: -(w * np.log(w)).sum()
    for wanted in (0.1, 0.5, 0.9):
        a = mixing.exponent(shares, entropy=wanted)
        w = p**a / (p**a).sum()
        assert abs(entropy(w) - (entropy(p) + wanted * (np.log(3) - entropy(p)))) < 1e-4
    a = mixing.exponent(shares, repetition=2.0)
    assert 2 - 1e-3 < 7 ** (1 - a) <= 2
    assert mixing.exponent(shares, repetition=100) == 0.0


def test_budgets_are_met_in_permuted_blocks(spark):
    rng = random.Random(3)
    rows = [(i, "abc"[min(2, i % 9 // 4)], "w " * rng.randrange(0, 60), 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int")
    for settings in ({"entropy": 0.7}, {"repetition": 1.5}, {"entropy": 0.3, "budget": 20_000}):
        got = mixing.mixed(docs, ["doc_id", "copies"], block_tokens=2000, **settings).collect()
        assert sorted(r["row"].doc_id for r in got) == list(range(3000))
        total = sum(r.n_tokens for r in got)
        for s in "abc":
            own = [r for r in got if r.source == s]
            tokens, taken = sum(r.n_tokens for r in own), sum(r.n_tokens * r.copies for r in own)
            weight = own[0].weight
            if "budget" in settings:
                assert 0 <= taken - weight * 20_000 < 61
            assert {r.copies for r in own} <= {own[0].epochs, own[0].epochs + 1}
            # Blocks of the last epoch are taken whole, but for one.
            last = {}
            for r in own:
                last.setdefault(r.block, set()).add(r.copies > r.epochs)
            assert sum(len(v) == 2 for v in last.values()) <= 1 and tokens <= total
        if "budget" not in settings:
            assert min(r.copies for r in got) >= 1


def test_epochs_go_through_blocks_in_other_orders(spark):
    rng = random.Random(3)
    rows = [(i, "ab"[i % 8 == 0], "w " * rng.randrange(1, 60)) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    settings = {"repetition": 4.0, "block_tokens": 1000}
    copies = {r["row"].doc_id: r.copies for r in mixing.mixed(docs, ["doc_id"], **settings).collect()}
    got = mixing.epochs_of(docs, ["doc_id"], **settings).collect()
    assert Counter(r["row"].doc_id for r in got) == Counter(copies)
    assert len({(r["row"].doc_id, r.epoch) for r in got}) == len(got)
    orders = {}
    for r in sorted(got, key=lambda r: r["at"]):
        if r.source == "b" and r.block not in (seen := orders.setdefault(r.epoch, [])):
            seen.append(r.block)
    whole = [o for e, o in sorted(orders.items()) if len(o) == len(orders[0])]
    assert len(whole) >= 2 and whole[0] != whole[1] and all(set(o) == set(whole[0]) for o in whole)
    # The mix itself: copies lie apart, and each tenth of it holds both sources alike.
    out = [(r.doc_id, r.source) for r in mixing.mix(docs, **settings).collect()]
    assert Counter(i for i, _ in out) == Counter(copies)
    assert all(a[0] != b[0] for a, b in zip(out, out[1:]))
    tenth, share = len(out) // 10, sum(s == "b" for _, s in out) / len(out)
    for i in range(10):
        assert abs(sum(s == "b" for _, s in out[i * tenth:(i + 1) * tenth]) / tenth - share) < 0.1


def test_mixing_odd_rows(spark):
    rows = [(1, None, "a b", 0), (1, None, "a b", 0), (2, "s", None, 0), (3, "s", "", 0), (None, "t", "x y z", 0), (5, "t", "w " * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, weight int")
    got = mixing.mix(docs, repetition=1.25)
    assert got.columns == docs.columns
    assert Counter(tuple(r) for r in got.collect()) >= Counter(rows)
    assert mixing.mix(docs.limit(0), entropy=0.5).count() == 0


# -- licences ---------------------------------------------------------------------


def test_licences_and_their_inheritance(spark):
    files = spark.createDataFrame([
        ("a/LICENSE.txt", "Licensed under the Apache License,\nVersion 2.0.", 1),
        ("a/x.py", "# Released under the MIT license\ncode", 1), ("a/y.py", "code", 1), ("a/b/c/z.py", None, 1),
        ("a/b/LICENSE", "Licensed under CC BY-NC 4.0.", 1), ("top.py", "", 1), ("q/w.py", "MIT " * 20_000, 1),
        (None, "Released under the MIT License.", 1), ("a/y.py", "code", 1),
        ("q/r/two.py", "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", 1),
    ], "path string, text string, score int")
    got = {r.path: r for r in licenses.scan(files).collect()}
    assert len(got) == 8
    assert got["a/LICENSE.txt"].own == "Apache-2.0" and got["a/x.py"].own == "MIT"
    assert (got["a/y.py"].license, got["a/y.py"].from_directory) == ("Apache-2.0", "a")
    assert (got["a/b/c/z.py"].license, got["a/b/c/z.py"].from_directory) == ("CC-BY-NC-4.0", "a/b")
    assert got["top.py"].license is None and got["q/w.py"].license is None
    assert got["q/r/two.py"].own == "CC-BY-NC-4.0" and got["q/r/two.py"].n_licenses == 2
    assert licenses.scan(files.limit(0)).count() == 0


def test_licence_texts_and_headers(spark):
    texts = licenses.full_texts()
    rows = [(f"{n}/LICENSE", f"Copyright (c) 2024 Some One\n\n{t}") for n, t in texts.items()]
    rows += [(f"{n}/src/main.c", "int main;") for n in texts]
    headers = {
        "spdx.c": ("// SPDX-License-Identifier: MIT", "MIT"), "title.c": ("// MIT License\ncode", "MIT"),
        "both.rs": ("// SPDX-License-Identifier: (Apache-2.0 OR GPL-3.0-or-later WITH X-exception)", "Apache-2.0"),
        "more.py": ("# foo.py, a small tool, Released under the MIT License by A. N. Other and friends", "MIT"),
        "block.c": ("/*\n * Licensed under the Apache License,\n * Version 2.0 (the \"License\");\n */", "Apache-2.0"),
        "gpl.c": ("terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or", "GPL-3.0"),
        "lgpl.c": ("GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "LGPL-2.1"),
        "x/COPYING": ("Attribution-NonCommercial 4.0 International\n\nlegal code", "CC-BY-NC-4.0"),
        "prose.md": ("We compared the MIT license with others and like a license.", None),
        "lone.txt": ("licence", None),
    }
    rows += [(path, text) for path, (text, _) in headers.items()]
    got = {r.path: r for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for name in texts:
        assert got[f"{name}/LICENSE"].own == name and got[f"{name}/LICENSE"].score > 0.9
        assert (got[f"{name}/src/main.c"].license, got[f"{name}/src/main.c"].from_directory) == (name, name)
    assert {path: got[path].own for path in headers} == {path: want for path, (_, want) in headers.items()}
    assert got["both.rs"].n_licenses == 2


def test_stand_in_licence_files(spark):
    rows = queries.op3_license_files(spark, SMALL).collect()
    files = [r for r in rows if "/LICENSE-" in r.path]
    assert files and all(r.own for r in files)
    assert any(r.inherited for r in rows)


def test_key_words_lose_no_match():
    rng = random.Random(1)
    weights = {t: {w: rng.random() for w in rng.sample("abcdefghij", 6)} for t in "xyz"}
    keys = set(licenses._key_words(weights, 0.7))
    for _ in range(2000):
        unit = {w: rng.random() for w in rng.sample("abcdefghijklm", rng.randrange(1, 8))}
        for weight in weights.values():
            dot = sum(v * weight.get(w, 0) for w, v in unit.items())
            norm = sum(v * v for v in unit.values()) ** 0.5 * sum(v * v for v in weight.values()) ** 0.5
            assert dot / norm < 0.7 or keys & unit.keys()


# -- pipeline ---------------------------------------------------------------------


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        before, after = ({r.doc_id for r in f.select("doc_id").collect()} for f in (docs, out))
        if name == "quality_classifier":
            assert all(i in after for i in before if labels.get(i) == 1)
        if name == "source_mixing":
            assert after == before
        docs = out
    assert corpus_pipeline.run(spark, SMALL).count() > 0
