import numpy as np
import pytest

from tidemill.llm import collisions
from tidemill.llm.collisions import Plan, least_counts, linked


def brute(rows, cosine=0.93):
    """rows: (vec_id, vector, label). Links, components and kept by all pairs."""
    fine = [
        i for i, (key, v, label) in enumerate(rows)
        if key is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    groups = {}
    for i in fine:
        groups.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    root, count = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for members in groups.values():
        x = np.array([rows[i][1] for i in members], dtype=np.float64)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= cosine
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            count[members[a]] += 1
            root[find(members[a])] = find(members[b])
    least = {}
    for i in fine:
        least[find(i)] = min(least.get(find(i), 1 << 62), rows[i][0])
    out = []
    for i, (key, _, _) in enumerate(rows):
        component = least[find(i)] if i in fine else key
        out.append((key, count[i], component, key == component))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def clustered(seed, n, dim, label):
    """Random vectors, tight clusters, a loose one at the limit, and exact copies."""
    rng = np.random.default_rng(seed)
    x = [rng.standard_normal((n, dim))]
    for size, spread in ((200, 0.1), (90, 0.02), (150, 0.24), (120, 0.36), (100, 0.0), (5, 0.1), (2, 0.3)):
        centre = rng.standard_normal(dim)
        x.append(centre + spread * rng.standard_normal((size, dim)))
    x = np.concatenate(x)
    x *= rng.uniform(0.1, 9, (len(x), 1))
    return [(v.tolist(), label) for v in x]


@pytest.mark.parametrize("wanted", [512, 40])
def test_planted_clusters(spark, monkeypatch, wanted):
    # Fewer wanted members a cell give several projections a table, smaller blocks more of them.
    monkeypatch.setattr(collisions, "WANTED", wanted)
    rows = clustered(1, 300, 64, 1) + clustered(2, 200, 24, 2)
    if wanted < 100:
        monkeypatch.setattr(collisions, "BLOCK", 50)
    order = np.random.default_rng(0).permutation(len(rows))
    rows = [(int(k) * 3, *row) for k, row in zip(order, rows)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    assert found(linked(frame)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "a"), (2, [2.0, 0.1], "a"), (3, [1.0, 0.0], None), (4, [1.0, 0.0], "b"), (5, None, "a"),
        (6, [0.0, 0.0], "a"), (7, [nan, 1.0], "a"), (8, [inf, 1.0], "a"), (9, [None, 1.0], "a"), (10, [], "a"),
        (11, [1.0, 0.0, 0.0], "a"), (None, [1.0, 0.0], "a"), (12, [1e200, 1e199], "a"), (13, [1e-300, 0.0], "a"),
        (1, [1.0, 0.0], "a"), (0, [-1.0, 0.0], "a"), (14, [0.0, 1.0], "b"),
    ]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, label string, n_links int")
    assert found(linked(frame)) == brute(rows)
    assert linked(frame.limit(0)).count() == 0


def test_pairs_at_the_limit_are_found(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        x, y = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        c = 0.93 + (1e-6 if i % 2 else -1e-6)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(linked(frame)) == brute(rows)


def test_calibration():
    plan = Plan(5000, 0.93, 1e-6)
    assert (1 - collisions.NEAR**plan.k) ** plan.tables <= 1e-6
    rng = np.random.default_rng(3)
    hits = (rng.random((200_000, collisions.COUNTED)) < collisions.NEAR).cumsum(axis=1)
    for i, least in enumerate(least_counts(1e-4)):
        missed = (hits[:, (i + 1) * collisions.BATCH - 1] < least).mean()
        assert missed <= 2e-4
