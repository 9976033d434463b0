import os

import numpy as np
import pytest

from tidemill.operators import knn
from tidemill.plans.queries import QUERIES


def frame(spark, vectors, name):
    return spark.createDataFrame(
        [(i, v) for i, v in enumerate(vectors)], f"{name}_id long, {name} array<float>")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(600, 16)).astype("float32")
    corpus[200:400] = corpus[0]  # a third of the corpus is one vector
    queries = rng.normal(size=(15, 16)).astype("float32")
    queries[0] = corpus[0]
    c = frame(spark, corpus.tolist(), "vec").withColumnRenamed("vec", "embedding").cache()
    return corpus, queries, c, frame(spark, queries.tolist(), "query").cache()


def brute(corpus, queries, k):
    c, q = corpus.astype("float64"), queries.astype("float64")
    scores = (q @ c.T) / (np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)) + 1e-9)
    scores = np.round(scores, 12)
    return {
        (i, r + 1): int(j)
        for i in range(len(q))
        for r, j in enumerate(np.lexsort((np.arange(len(c)), -scores[i]))[:k])
    }


def found(df):
    return {(r.query_id, r["rank"]): r.neighbour_id for r in df.collect()}


def test_exact(data):
    corpus, queries, c, q = data
    assert found(knn.knn_exact(q, c, 7, 16)) == brute(corpus, queries, 7)


def test_exact_for_many_queries(data, monkeypatch):
    corpus, queries, c, q = data
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 6 * 16 * 8)
    assert found(knn.knn_exact(q, c, 7, 16)) == brute(corpus, queries, 7)


def test_unusable_vectors_and_large_k(spark):
    corpus = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, [None, 1.0])],
        "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([("a", [2.0, 0.0])], "query_id string, query array<float>")
    got = knn.knn_exact(queries, corpus, 10, 2).orderBy("rank").collect()
    assert [(r.neighbour_id, round(r.score, 6)) for r in got] == [(1, 1.0), (4, 0.0), (5, 0.0)]


def test_approx_recall(data, spark, monkeypatch):
    corpus, queries, c, q = data
    index = knn.build_cells(c, 8, 16)
    assert sum(index.sizes.values()) == 600
    exact = knn.knn_exact(q, c, 5, 16)
    all_cells = knn.knn_approx(q, index, 5, nprobe=8)
    assert found(all_cells) == brute(corpus, queries, 5)
    some = knn.knn_approx(q, index, 5, nprobe=5).cache()
    assert knn.mean_recall(exact, some).first().mean_recall >= 0.8
    probes = knn.probes_for_recall(q, index, exact.cache(), 5, 0.95)
    assert knn.mean_recall(exact, knn.knn_approx(q, index, 5, probes)).first().mean_recall >= 0.95
    assert some.groupBy("query_id").count().filter("count != 5").isEmpty()
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 6 * 16 * 8)
    assert found(knn.knn_approx(q, index, 5, nprobe=5)) == found(some)


def test_probes_until_enough_rows(data):
    index = knn.CellIndex("", np.eye(3), {0: 1, 1: 1, 2: 10}, "vec_id", "embedding", 3)
    assert index.probes(np.array([[1.0, 0.1, 0.0]]), 1, 5) == [[0, 1, 2]]
    assert index.probes(np.array([[0.0, 0.1, 1.0]]), 1, 5) == [[2]]


def test_recall_bounds(spark):
    exact = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "query_id long, neighbour_id long")
    none = exact.filter("false")
    assert {r.recall for r in knn.recall(exact, exact).collect()} == {1.0}
    assert {r.recall for r in knn.recall(exact, none).collect()} == {0.0}
    assert knn.mean_recall(none, exact).first().mean_recall == 0.0


def test_group_centres_and_attributes(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (1, [3.0, 2.0]), (2, [0.0, 1.0])], "label int, v array<float>")
    got = {r.label: r.centre for r in knn.group_centres(df, "label", "v", 2).collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 1.0]}
    near = spark.createDataFrame([(1, 7, 0.5)], "query_id long, neighbour_id long, score double")
    table = spark.createDataFrame([(7, "vip", 100)], "vec_id long, name string, size int")
    assert knn.with_attributes(near, table).select("name", "size").first() == ("vip", 100)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_of_the_approximate_query(spark, scale):
    folder = f"/root/testdata/{scale}"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    exact, approx = (QUERIES[n](spark, folder) for n in ("knn_exact", "knn_approx_rows"))
    assert set(approx.columns) == {"query_id", "neighbour_id", "score", "rank"}
    assert approx.count() == exact.count()
    assert knn.mean_recall(exact, approx).first().mean_recall >= 0.9
    assert QUERIES["recall_at_k"](spark, folder).first().reached
