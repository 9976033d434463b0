import os

import numpy as np
import pytest

from tests.llm.test_collisions import brute, clustered, found
from tidemill import session
from tidemill.llm import collisions
from tidemill.llm.collisions import Plan, linked


def size_of(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()))


def test_disk_is_a_few_times_the_vectors(spark, monkeypatch, folder):
    monkeypatch.setattr(collisions, "BLOCK", 40)  # 640 vectors a cell at most: larger labels have caps
    peak, given = [0], session.shared_folder

    def below(_, purpose):
        peak.append(size_of(folder))
        return f"{folder}/{os.path.basename(given(spark, purpose))}"

    monkeypatch.setattr(session, "shared_folder", below)
    rng = np.random.default_rng(5)
    rows = [(i, x.tolist(), i % 2) for i, x in enumerate(rng.standard_normal((8000, 64)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(2)
    before = shuffled(spark)
    assert linked(frame).count() == 8000
    vectors = 8000 * 64 * 4
    assert max(peak) < 3 * vectors  # before: every copy that was dealt stayed, 40 times the vectors
    assert shuffled(spark) - before < vectors


@pytest.mark.parametrize("kind", ["float", "double"])
def test_caps_in_rounds_of_pieces(spark, monkeypatch, kind):
    monkeypatch.setattr(collisions, "BLOCK", 20)
    monkeypatch.setattr(collisions, "WANTED", 40)
    rounds, given = [], collisions._rounds
    monkeypatch.setattr(collisions, "_rounds", lambda volume, most: rounds.extend(given(volume, 2000)) or rounds)
    rng = np.random.default_rng(11)
    loose = rng.standard_normal(32) + 0.25 * rng.standard_normal((700, 32))  # a label in few caps
    rows = clustered(3, 700, 64, 1) + [(x.tolist(), 2) for x in loose] + clustered(4, 60, 16, 3)
    rows += [(x.tolist(), 4) for x in np.float32(rng.standard_normal((90, 16)) * 1e-42)]
    rows += [([0.0] * 16, 4), (None, 1), ([1.0, 2.0], 1)]
    if kind == "float":
        rows = [(v and np.float32(v).tolist(), label) for v, label in rows]
    order = rng.permutation(len(rows))
    rows = [(int(k), *row) for k, row in zip(order, rows)]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    assert found(linked(frame)) == brute(rows)
    assert len(rounds) > 2 and max(turns for _, _, turns in rounds) > 1


@pytest.mark.parametrize("share", [0, 0.5, 1])
def test_pairs_share_caps_as_often_as_planned(share):
    plan = Plan(40_000, 0.93, 0.05, "f8", 8 * 24)
    radius = share * plan.ball
    rng, n = np.random.default_rng(2), 3000
    x, y = rng.standard_normal((2, n, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    angle = plan.angle + 2 * radius  # of the centres of balls with members at the limit
    bound = np.full(n, plan.bound - plan.slope * radius, np.float32)
    lying = [set(zip(*collisions._lying(plan, z, bound))) for z in (x, np.cos(angle) * x + np.sin(angle) * y)]
    assert plan.tables > 100
    missed = 1 - len({row for row, _ in lying[0] & lying[1]}) / n
    assert missed < 0.065


def test_settings_of_the_session_stay(spark):
    before = spark.conf.get(collisions.CLEAN, None)
    linked(spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")).count()
    assert spark.conf.get(collisions.CLEAN, None) == before
