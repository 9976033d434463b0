import os

import public_tokenizers
import pyarrow as pa

from tidemill.llm import near_dup, packing, release_memory


def resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_freed_memory_goes_back_to_the_system():
    held = [os.urandom(60_000) for _ in range(2000)]
    last = held[-1]
    before = resident()
    held.clear()
    release_memory()
    assert last and before - resident() > 80_000_000


def test_tasks_give_memory_back_when_they_end(monkeypatch):
    calls = []
    monkeypatch.setattr(near_dup, "release_memory", lambda: calls.append("near"))
    frame = pa.record_batch({"id": pa.array([1, 2]), "text": pa.array(["a b c d e f", None])})
    assert [b.column(1).to_pylist() for b in near_dup._features(iter([frame]))] == [[2, 0]]
    assert sum(b.num_rows for b in near_dup._sets(iter([frame]))) == 2
    assert calls == ["near", "near"]


def test_packing_gives_memory_back_after_each_batch(monkeypatch):
    calls, taken = [], []

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, pieces, schema):
            taken.append(pieces)

    monkeypatch.setattr(packing, "release_memory", lambda: calls.append(1))
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": lambda: type("C", (), {"partitionId": lambda s: 0})()}))
    monkeypatch.setattr(packing.F, "col", lambda name: type("C", (), {"cast": lambda s, k: s, "alias": lambda s, n: s})())
    monkeypatch.setattr(packing.F, "coalesce", lambda *c: c[0])
    monkeypatch.setattr(packing.F, "lit", lambda v: v)
    packing.pack_documents(Docs(), public_tokenizers.path("word_bpe_49k.json"), "white")
    frame = pa.record_batch({"id": pa.array([1]), "text": pa.array(["a b"])})
    assert sum(b.num_rows for b in taken[0](iter([frame]))) >= 1
    assert len(calls) == 2
