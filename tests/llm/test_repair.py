import hashlib
import itertools
import random
import re
import zlib

from tidemill.llm import queries, repair

SMALL = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def cheapest(kinds):
    """Cost and least audit by dynamic programming over whole strings of edits."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def inserted(best):
        out = dict(best)
        for _ in range(3):
            for s, (cost, audit) in list(out.items()):
                for role, t in after[s].items():
                    if role != "s":
                        out[t] = min(out.get(t, (10**9, "")), (cost + 3, audit + "I"))
        return out

    for kind in kinds:
        initial, fault = "sua?"[kind // 4], kind % 4
        new = {}
        for s, (cost, audit) in inserted(best).items():
            ways = [(4, "D", s)]
            if fault < 2:
                more = 3 * (fault == 1)
                ways += [(3 + more, "R", t) for role, t in after[s].items() if role != "s"]
                ways += [(more, "K", after[s][initial])] if initial in after[s] else []
            for add, letter, t in ways:
                new[t] = min(new.get(t, (10**9, "")), (cost + add, audit + letter))
        best = new
    return min(v for s, v in inserted(best).items() if s in (0, 3))


def whole(kinds, size):
    """As the operator does it: chunks of the given size."""
    parts = [kinds[i:i + size] for i in range(0, len(kinds), size)]
    chunks = []
    for part in parts:
        vectors = [repair.forward(repair.start_at(s), part) for s in repair.STATES]
        chunks.append({"costs": [c for v in vectors for c in v[0]], "orders": [o for v in vectors for o in v[1]]})
    cost, borders = repair.crossings(chunks)
    audit = "".join(repair.audit_between(p, s, t) for p, (s, t) in zip(parts, borders))
    return cost, audit + repair.CLOSING[borders[-1][1]]


def test_every_short_conversation():
    for n in (1, 2, 3):
        for kinds in itertools.product(range(16), repeat=n):
            assert whole(list(kinds), 4096) == cheapest(kinds)


def test_longer_conversations_in_any_chunks():
    rng = random.Random(5)
    for _ in range(400):
        kinds = [rng.choice((0, 4, 8, 12)) + rng.choices(range(4), (6, 1, 1, 1))[0] for _ in range(rng.randint(4, 60))]
        want = cheapest(kinds)
        for size in (1, 3, 7, 4096):
            assert whole(kinds, size) == want


def expected(rows):
    """The whole contract for the rows of one conversation, after damage and in order."""
    seen, kinds, faults = set(), [], []
    for turn, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 2 if not solid else 3 if (role, text) in seen else 0 if solid[-1] in ".!?" else 1
        seen.add((role, text))
        faults.append(fault)
        kinds.append(4 * ("sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + fault)
    cost, audit = cheapest(kinds)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(rows, rows[1:]))
    out, at = [], 0
    for letter in audit:
        last = out[-1][0][:1] if out else ""
        if letter == "I":
            out.append(("assistant" if last == "u" else "user", ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((role if letter == "K" else "assistant" if last == "u" else "user", text))
    assert GOOD.match("".join(r[:1] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, digest)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_query_against_brute_force(spark):
    by = {}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        rows = by.setdefault(r.conv_id, [])
        draw = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r.text)}.get(draw, r.text)
        row = (r.turn, "user" if draw == 4 else r.role, text)
        rows += [] if draw == 0 else [row, row] if draw == 3 else [row]
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in queries.op13_conversation_repair(spark, SMALL).collect()}
    assert got == {k: expected(in_order(v)) for k, v in by.items()}


def test_damage_of_odd_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "a."), (1, 2, None, "b.!?c"), (None, 1, "", "")]
    rows += [(i, 0, "user", "Hi. You?") for i in range(100, 160)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = {}
    for r in queries.damaged(frame).collect():
        by.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        want = ("user" if draw == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(draw, text))
        assert by.get((conv, turn), []) == [want] * {0: 0, 3: 2}.get(draw, 1)


def test_odd_conversations(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, None, "system", "s."), (None, 3, "assistant", "x " * 50_000 + "!")]
    rows += [(None, None, None, None), (2, 5, "tool", "t?"), (3, 9, "user2", "\x0b\t"), (4, 1, "system", "s."), (4, 7, "assistant", "q")]
    hot = [(9, i, rng.choice(("user", "assistant", "system", "")), rng.choice(("a.", "b", "", "c!", f"{i}.", f"{i}?"))) for i in range(6000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + hot], "conv_id long, turn long, role string, text string, id string")
    monkeypatch.setattr(repair, "CHUNK", 512)
    edits, reports = repair.repair(frame)
    digests = {r.conv_id: (r.audit, r.repaired_sha256) for r in repair.digests(edits).collect()}
    got = {r.conv_id: tuple(r[f] for f in FIELDS[:6]) + digests[r.conv_id] for r in reports.collect()}
    by = {}
    for conv, turn, role, text in rows + hot:
        by.setdefault(conv, []).append((turn, role or "", text or ""))
    assert got == {k: expected(in_order(v)) for k, v in by.items()}
    kept = edits.where("edit = 'K' and conv_id is null").collect()
    assert [k.text for k in kept] == ["x " * 50_000 + "!"]
    edits, reports = repair.repair(frame.limit(0))
    assert edits.count() == 0 and reports.count() == 0 and repair.digests(edits).count() == 0
