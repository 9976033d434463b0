"""Repair of the turn order of conversations at least cost, by divide and conquer.

A repaired conversation is empty, or a system turn (or none) and then user and assistant turns in
alternation. Four states say what may follow: nothing yet, a system turn, a user's, an
assistant's. Each row is kept, given another role or deleted, and empty turns may be inserted;
the letters of the edits (K, R, D, I) in order are the audit. Of the cheapest repairs that with the
least audit (by ASCII) is wanted.

Two audits of the same rows that end in different states are never prefixes of each other, as each
ends where its last row is used. So the vector of a stretch of rows is four costs and the order of
the four least audits, and vectors go from row to row without any text. Hirschberg's scheme finds
the path: vectors forward from the start and backward from the end meet in the middle, the state
with the least sum, of these that with the least audit, is crossed, and both halves are solved alike.

Conversations are cut into chunks of bounded size wherever they are long. A chunk gives its costs and
orders from each state to each; these meet per conversation, which settles the states at all
borders, and then the chunks are solved by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import shuffle_width, written

WHITE = " \t\n\x0b\f\r"
CHUNK = 4096
STATES = range(4)  # nothing yet, after a system turn, after a user's, after an assistant's
FAR = 1 << 60
KEEP, RETITLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = "sua"
IN_ORDER = {("s", "u"), ("u", "a"), ("a", "u")}
# State -> the state after a turn of a user or an assistant that may stand there, and its role.
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
ROLES = {2: "user", 3: "assistant"}
# What closes a conversation that ends in a state.
CLOSING = {0: "", 1: "II", 2: "I", 3: ""}

Vector = tuple[tuple[int, ...], tuple[int, ...]]


@lru_cache(maxsize=64)
def moves(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state, state) -> the least cost and audit of one row, with the turns inserted before it.

    ``kind``: four times the place of the role's initial in "sua" (3: another), and the fault.
    """
    initial, fault = divmod(kind, 4)
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for state in STATES:
        at, before = state, 0
        for inserted in range(3):
            ways = [(DELETE, "D", at)]
            if fault in (FINE, TRUNCATED):
                more = CUT_OFF if fault == TRUNCATED else 0
                ways.append((RETITLE + more, "R", NEXT[at]))
                if initial == 0 and at == 0:
                    ways.append((KEEP + more, "K", 1))
                if initial in (1, 2) and NEXT[at] == initial + 1:
                    ways.append((KEEP + more, "K", NEXT[at]))
            for cost, letter, to in ways:
                new = (before + cost, "I" * inserted + letter)
                out[state, to] = min(new, out.get((state, to), new))
            at, before = NEXT[at], before + INSERT
    return out


@lru_cache(maxsize=100_000)
def _step(costs: tuple[int, ...], order: tuple[int, ...], kind: int) -> Vector:
    best = []
    for to in STATES:
        ways = [
            (costs[s] + cost, order[s], audit) for s in STATES
            if costs[s] < FAR and (way := moves(kind).get((s, to))) for cost, audit in [way]
        ]
        best.append(min(ways, default=(FAR, 4, "")))
    ranked = sorted(STATES, key=lambda t: best[t][1:])
    return tuple(b[0] for b in best), tuple(ranked.index(t) for t in STATES)


def forward(vector: Vector, kinds: list[int]) -> Vector:
    """Costs and order of the least audits after these rows. Costs are carried less their least."""
    costs, order = vector
    base = 0
    for kind in kinds:
        costs, order = _step(costs, order, kind)
        least = min(costs)
        if least:
            base += least
            costs = tuple(c - least if c < FAR else FAR for c in costs)
    return tuple(c + base if c < FAR else FAR for c in costs), order


@lru_cache(maxsize=100_000)
def _back(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    way = moves(kind)
    return tuple(
        min((way[s, t][0] + costs[t] for t in STATES if (s, t) in way and costs[t] < FAR), default=FAR)
        for s in STATES
    )


def backward(costs: tuple[int, ...], kinds: list[int]) -> tuple[int, ...]:
    """Costs to the end from each state before these rows."""
    base = 0
    for kind in reversed(kinds):
        costs = _back(costs, kind)
        least = min(costs)
        if least:
            base += least
            costs = tuple(c - least if c < FAR else FAR for c in costs)
    return tuple(c + base if c < FAR else FAR for c in costs)


def start_at(state: int) -> Vector:
    return tuple(0 if s == state else FAR for s in STATES), tuple(STATES)


def audit_between(kinds: list[int], state: int, to: int) -> str:
    """The least audit of the cheapest edits of the rows that lead from a state to another."""
    if not kinds:
        return ""
    if len(kinds) == 1:
        return moves(kinds[0])[state, to][1]
    half = len(kinds) // 2
    left, right = kinds[:half], kinds[half:]
    costs, order = forward(start_at(state), left)
    rest = backward(start_at(to)[0], right)
    cross = min(STATES, key=lambda s: (costs[s] + rest[s], order[s]))
    return audit_between(left, state, cross) + audit_between(right, cross, to)


def crossings(chunks: list[dict]) -> tuple[int, list[tuple[int, int]]]:
    """The cost of a conversation and the states in which each of its chunks begins and ends.

    A chunk has ``costs`` and ``orders``: sixteen numbers, from each state to each.
    """
    rest = tuple(INSERT * len(CLOSING[s]) for s in STATES)
    behind = []
    for chunk in reversed(chunks):
        behind.append(rest)
        costs = chunk["costs"]
        rest = tuple(min(costs[4 * s + t] + rest[t] for t in STATES) for s in STATES)
    total, state, out = rest[0], 0, []
    for chunk, rest in zip(chunks, reversed(behind)):
        costs, orders = chunk["costs"], chunk["orders"]
        to = min(STATES, key=lambda t: (costs[4 * state + t] + rest[t], orders[4 * state + t]))
        out.append((state, to))
        state = to
    return total, out


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_LONG, _LONGS = pa.int64(), pa.list_(pa.int64())
SUMMARY = "conv_id long, chunk long, costs array<long>, orders array<long>, first long, last long, illegal long"
_SUMMARY = pa.schema([
    ("conv_id", _LONG), ("chunk", _LONG), ("costs", _LONGS), ("orders", _LONGS), ("first", _LONG),
    ("last", _LONG), ("illegal", _LONG),
])


def _illegal(kinds: list[int]) -> int:
    initials = [(INITIALS + "?")[k // 4] for k in kinds]
    return sum(pair not in IN_ORDER for pair in zip(initials, initials[1:]))


def _summaries(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, chunk, rows (id, kind) in; SUMMARY out."""
    for frame in frames:
        out = []
        for row in frame.to_pylist():
            kinds = [r["kind"] for r in row["rows"]]
            vectors = [forward(start_at(s), kinds) for s in STATES]
            out.append({
                "conv_id": row["conv_id"], "chunk": row["chunk"], "costs": [c for v in vectors for c in v[0]],
                "orders": [o for v in vectors for o in v[1]], "first": kinds[0], "last": kinds[-1],
                "illegal": _illegal(kinds),
            })
        yield _table(out, _SUMMARY)


BORDERS = "conv_id long, chunk long, state long, to long, ends boolean, cost long, illegal long"
_BORDERS = pa.schema([
    ("conv_id", _LONG), ("chunk", _LONG), ("state", _LONG), ("to", _LONG), ("ends", pa.bool_()),
    ("cost", _LONG), ("illegal", _LONG),
])


def _settled(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, chunks (summaries in order) in; BORDERS out, cost and illegal with the last chunk."""
    for frame in frames:
        out = []
        for row in frame.to_pylist():
            chunks = row["chunks"]
            cost, borders = crossings(chunks)
            illegal = sum(c["illegal"] for c in chunks)
            illegal += sum(_illegal([a["last"], b["first"]]) for a, b in zip(chunks, chunks[1:]))
            for i, (chunk, (state, to)) in enumerate(zip(chunks, borders)):
                ends = i == len(chunks) - 1
                out.append({
                    "conv_id": row["conv_id"], "chunk": chunk["chunk"], "state": state, "to": to, "ends": ends,
                    "cost": cost if ends else None, "illegal": illegal if ends else None,
                })
        yield _table(out, _BORDERS)


EDITS = "conv_id long, chunk long, edits array<struct<place: int, edit: string, id: long, role: string>>"
_EDITS = pa.schema([
    ("conv_id", _LONG), ("chunk", _LONG),
    ("edits", pa.list_(pa.struct([
        ("place", pa.int32()), ("edit", pa.string()), ("id", _LONG), ("role", pa.string()),
    ]))),
])


def _edited(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, chunk, rows, state, to, ends in; EDITS out, a null role for what keeps its own."""
    for frame in frames:
        out = []
        for row in frame.to_pylist():
            audit = audit_between([r["kind"] for r in row["rows"]], row["state"], row["to"])
            audit += CLOSING[row["to"]] if row["ends"] else ""
            state, used, edits = row["state"], 0, []
            for place, letter in enumerate(audit):
                this = None if letter == "I" else row["rows"][used]
                used += letter != "I"
                role = None
                if letter in "IR":
                    state = NEXT[state]
                    role = ROLES[state]
                elif letter == "K":
                    state = this["kind"] // 4 + 1
                edits.append({"place": place, "edit": letter, "id": this and this["id"], "role": role})
            out.append({"conv_id": row["conv_id"], "chunk": row["chunk"], "edits": edits})
        yield _table(out, _EDITS)


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond &= a[c].eqNullSafe(b[c])
    return cond


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The edits of all conversations, and a report on each.

    ``edits``: conv_id, chunk, place, edit (K, R, D or I), role and text, in the order of chunk and
    place; a deleted row has the role and text that it had, an inserted turn an empty text.
    ``reports``: conv_id, gaps, blank, duplicate, truncated, illegal and cost. Gaps are the numbers
    missing between the least and the greatest turn; illegal counts neighbours whose initials
    aren't su, ua or au.

    Rows are ordered by turn (nulls first), then role and text. A row's fault is the first of:
    blank (no character but white space), duplicate (role and text of an earlier row), truncated
    (the last such character is none of .!?). Blank and duplicate rows are deleted.
    Deleting costs 4, another role 3, an inserted turn 3, a truncated row that stays 3.

    Null roles and texts are empty; a null conversation id is a conversation like any other;
    repeated rows are duplicates; other columns are ignored, whatever their names; an empty table
    gives no rows. Texts only pass through Spark. No task holds more of a conversation than a chunk
    of 4096 rows, and 300 bytes for each of its chunks.
    """
    spark = rows.sparkSession
    empty = F.lit("")
    given = rows.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    mark = F.md5("text")
    ordered = written(
        given.repartitionByRange(shuffle_width(spark), "conv_id", "turn", "role", mark)
        .sortWithinPartitions("conv_id", "turn", "role", mark)
        .select(*order, F.monotonically_increasing_id().alias("id")),
        "repair-rows",
    )
    solid = F.translate("text", WHITE, "") != ""
    # The first of equal turns, where there are several; merged in tasks before the shuffle.
    firsts = written(
        ordered.where(solid).groupBy("conv_id", "role", mark.alias("mark"))
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "repair-repeated",
    )
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    marked = ordered.select(
        "conv_id", "turn", "id", "role", mark.alias("mark"), solid.alias("solid"),
        last.isin(".", "!", "?").alias("whole"),
        F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3).alias("initial"),
    )
    marked = marked.join(firsts, _same(marked, firsts, "conv_id", "role", "mark"), "left").select(
        marked["conv_id"], "turn", "id", "initial",
        F.when(~F.col("solid"), BLANK).when(F.col("id") > F.col("first"), DUPLICATE)
        .when(~F.col("whole"), TRUNCATED).otherwise(FINE).alias("fault"),
    )
    marked = written(marked, "repair-marked")
    chunks = written(
        marked.groupBy("conv_id", F.expr(f"id div {CHUNK}").alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("id", (4 * F.col("initial") + F.col("fault")).alias("kind")))).alias("rows")),
        "repair-chunks",
    )
    summary = chunks.mapInArrow(_summaries, SUMMARY)
    parts = F.array_sort(F.collect_list(F.struct("chunk", "costs", "orders", "first", "last", "illegal")))
    borders = written(
        summary.groupBy("conv_id").agg(parts.alias("chunks")).mapInArrow(_settled, BORDERS), "repair-borders"
    )
    solved = chunks.join(borders, _same(chunks, borders, "conv_id", "chunk")).select(
        chunks["conv_id"], chunks["chunk"], "rows", "state", "to", "ends"
    )
    edits = solved.mapInArrow(_edited, EDITS).select("conv_id", "chunk", F.inline("edits"))
    edits = edits.select("conv_id", "chunk", "place", "edit", F.col("id").alias("of"), F.col("role").alias("new_role"))
    edits = edits.join(
        ordered.select("id", "role", "text"), F.col("of") == F.col("id"), "left"
    ).select(
        "conv_id", "chunk", "place", "edit", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", empty).alias("text"),
    )

    def number(fault: int) -> Column:
        return F.count_if(F.col("fault") == fault)

    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), number(BLANK).alias("blank"),
        number(DUPLICATE).alias("duplicate"), number(TRUNCATED).alias("truncated"),
    )
    found = borders.where("ends")
    reports = counts.join(found, _same(counts, found, "conv_id")).select(
        counts["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost"
    )
    return edits, reports


DIGESTS = "conv_id long, audit string, repaired_sha256 string"


def _digested(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits in, sorted by conversation and place; DIGESTS out. Texts are hashed as they come."""
    key, audit, sha, any_turn = None, None, None, False
    for frame in frames:
        out = []
        for conv, edit, role, text in zip(*(frame.column(i).to_pylist() for i in range(4))):
            if audit is None or conv != key:
                if audit is not None:
                    out.append((key, "".join(audit), sha.hexdigest()))
                key, audit, sha, any_turn = conv, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                sha.update(f"{chr(10) if any_turn else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                any_turn = True
        yield _digest_rows(out)
    if audit is not None:
        yield _digest_rows([(key, "".join(audit), sha.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))],
        ["conv_id", "audit", "repaired_sha256"],
    )


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation: conv_id, audit and the sha256 of its repaired turns (``role:text``, newlines between).

    A digest needs its conversation in order, so that one task reads it; texts aren't gathered but
    hashed as they stream by, and only the audit, a letter per edit, is held.
    """
    return (
        edits.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "place")
        .select("conv_id", "edit", "role", "text").mapInArrow(_digested, DIGESTS)
    )
