"""Near-duplicate vectors by collisions in one-dimensional projections.

1. Dense groups of near copies become balls: a centre, a radius and a weight. All members of a ball
   lie within so small an angle of its centre that any two of them are linked, by the triangle
   inequality of angles; no pair inside a ball is looked at. Every other vector is a node of
   its own, with radius 0.
2. Every node is projected on many random directions. The cap of a direction holds the nodes whose
   projections reach a bound (lower for balls, by their radius). Two vectors at the limit share a
   cap with a known probability, so that so many caps are drawn that a pair at the limit shares one
   but for the chosen miss probability. A small group has one cell with all of its nodes instead.
3. The nodes of a cap meet in a cell. Inside a task, products of blocks in single precision, with a
   bound for their error, give the pairs; a pair belongs to the first cap that it shares.
4. Collisions of a pair are counted over many more projections, in batches: two nodes collide in a
   projection if their windows, centred on their own values, meet. Windows are as wide as ``Z``
   deviations of the difference of a pair at the limit. A pair leaves once its count falls below
   what a linked pair reaches, but for the chosen miss probability. The cosine in double precision
   of what is left decides. Pairs of balls are settled by their bounds, or else by their members.

Per node only the number of links and one link to a smaller node leave a task, never pairs. Cells
and balls that are too large for a task are cut into blocks, and blocks meet in pairs.

Disk is bounded by the vectors: they are written once, as given, and again with the numbers of their
caps; then they are dealt to cells in rounds of some caps each, of one and a half times as many rows
as there are nodes. A copy is deleted when the next one is written, and files of a shuffle when its result is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import asin, ceil, comb, cos, erf, erfc, exp, inf, log, log1p, pi, sin, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidemill.llm import release_memory
from tidemill.llm.components import components
from tidemill.session import Scratch, written

Z = 2.0
NEAR = erf(Z / sqrt(2))  # a pair at the limit collides in a projection
COUNTED, BATCH = 64, 16  # projections that are counted, and how many at a time
BLOCK = 1024  # members of a ball in one piece; a piece of a cell has up to 16 times as many
PIECE = 1 << 23  # bytes of the vectors in a piece of a cell, at most
WANTED = 512  # members of a cell that caps aim at, at least
DENSE, ROUNDS = 64, 2  # members of a cell that may become a ball, and passes over what is left
SMALL = 100_000  # rows of one number that may be sent to every task
HELD = 1 << 24  # bytes of vectors that a task deals together
PACK = 1 << 15  # bytes of the vectors in one row
DEALT = 200_000  # rows that a round may deal, however few the nodes are
RANGES = 256  # of caps, in whole numbers of which rounds are planned
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def chord(angle: float) -> float:
    return 2 * sin(angle / 2)


def least_counts(miss: float) -> list[int]:
    """After each batch of projections: the fewest collisions that aren't pruned."""
    table = []
    for n in range(BATCH, COUNTED + 1, BATCH):
        cdf, m = 0.0, -1
        while cdf < miss:
            m += 1
            cdf += comb(n, m) * NEAR**m * (1 - NEAR) ** (n - m)
        table.append(m)
    return table


def both_above(x: float, y: float, rho: float) -> float:
    """Two normal values of correlation ``rho``: the probability that they reach x and y."""
    if x == -inf or y == -inf:
        return 1.0 if x == y else erfc(max(x, y) / sqrt(2)) / 2
    steps, apart = 400, sqrt(1 - rho * rho)
    at = [x + 8 * i / steps for i in range(steps + 1)]
    f = [exp(-v * v / 2) * erfc((y - rho * v) / apart / sqrt(2)) / 2 for v in at]
    return (sum(f) - (f[0] + f[-1]) / 2) * 8 / steps / sqrt(2 * pi)


class Plan:
    """Caps, windows and balls for groups of at most ``n`` vectors of ``size`` bytes."""

    def __init__(self, n: int, cosine: float, miss: float, kind: str = "f8", size: int = 8):
        self.cosine, self.angle, self.kind = cosine, pi / 2 - asin(cosine), kind
        self.half = Z * chord(self.angle) / 2
        self.counts = least_counts(miss / (COUNTED // BATCH))
        self.ball = 0.4 * self.angle  # two members of a ball are at most 0.8 of the limit apart
        self.ball_k = max(4, ceil(log(max(n, 2) / 16) / log(2)))
        self.piece = max(64, min(16 * BLOCK, PIECE // max(size, 1)))
        self.large = np.empty(0, np.int64)  # groups with caps; the others are a cell each
        # With cells of so many members, looking for a node's caps costs what its pairs cost.
        share = min(0.25, max(sqrt(2 / n), WANTED / n)) if n > self.piece else 1.0
        self.bound = -NormalDist().inv_cdf(share) if share < 1 else -inf
        both = both_above(self.bound, self.bound, cosine) * (0.999 if share < 1 else 1)
        # A shared cap is as likely as k collisions in a row; of so many caps a pair shares one.
        self.k = log(both) / log(NEAR)
        self.tables = ceil(log(miss) / log1p(-both)) if share < 1 else 1
        self.slope = self._slope(both) if share < 1 else 0.0

    def _slope(self, both: float) -> float:
        """Caps are so much lower per radius that balls with members at the limit share them as often."""
        radii = [(self.ball * i / 4, self.ball * j / 4) for i in range(5) for j in range(i, 5)]
        low, high = 0.0, 40.0
        for _ in range(16):
            slope = (low + high) / 2
            fine = all(
                both_above(self.bound - slope * x, self.bound - slope * y, cos(self.angle + x + y)) >= both
                for x, y in radii
            )
            low, high = (low, slope) if fine else (slope, high)
        return 1.05 * high

    def directions(self, dim: int, what: str) -> np.ndarray:
        columns = {"counted": COUNTED, "balls": ROUNDS * self.ball_k}
        seed = [93, dim, sorted(columns).index(what)]
        return np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, columns[what]))

    def caps(self, dim: int, begin: int, end: int) -> np.ndarray:
        """The directions of some caps, in single precision; ``begin`` decides on them."""
        random = np.random.Generator(np.random.PCG64([93, dim, 9, begin]))
        return random.standard_normal((dim, end - begin), dtype=np.float32)

    def windows(self, radius: np.ndarray) -> np.ndarray:
        return self.half + Z * 2 * np.sin(radius / 2)


def _hashed(start: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """64-bit keys of cells: a group's number and whole coordinates."""
    with np.errstate(over="ignore"):
        x = start.astype(np.int64).view(np.uint64)
        for column in coordinates.T:
            x = (x ^ (x >> np.uint64(32))) * _MIX + column.astype(np.int64).view(np.uint64) * _ODD
        x = (x ^ (x >> np.uint64(29))) * _MIX
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of a binary column, one row after another."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column) or column.buffers()[2] is None:
        return np.empty(0, kind)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view(kind)


def _sizes(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False)


def _vectors(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrices of a column of packed numbers, by dimension."""
    sizes = _sizes(column)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = column if len(at) == len(column) else column.take(pa.array(at))
        yield at, _flat(rows, kind).reshape(len(at), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows with length 1, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    return x


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose rows are the numbers up to the next end."""
    values = np.ascontiguousarray(values)
    step = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = np.concatenate([[0], ends]).astype(np.int64) * step
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.reshape(-1).view(np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def _packed(matrix: np.ndarray) -> pa.Array:
    return _binary(matrix, np.arange(1, len(matrix) + 1))


def _batch(names: str, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names.split(" "))


def _held(frames: Iterator[pa.RecordBatch], column: int, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Batches put together until a column has so many bytes."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += frame.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(f.num_rows for f in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _where(mask: np.ndarray) -> np.ndarray:
    """Places of the few true values of a matrix, in one number."""
    flat = np.ascontiguousarray(mask).reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    eights = np.flatnonzero(flat.view(np.uint64))
    row, column = np.nonzero(flat.reshape(-1, 8)[eights])
    return eights[row] * 8 + column


def _spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, one span after another."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


UNITS = "rid long, vec_id long, group long, code binary"


def _units(kind: str):
    def units(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """rid, vec_id, group, vector in; the vectors' numbers out, null for what takes no part.

        A vector is multiplied by a power of two, which changes no digit, so that its largest number
        is about 1. Its numbers stay in the precision in which they are given.
        """
        for frame in frames:
            lists = frame.column(3)
            codes, place = [pa.array([], pa.binary())], np.full(len(lists), -1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == size)
                flat = lists.take(pa.array(at)).flatten()
                x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), -1)  # null: nan
                top = np.abs(x).max(axis=1)
                fine = np.isfinite(top) & (top > 0)
                place[at[fine]] = np.arange(fine.sum()) + sum(map(len, codes))
                codes.append(_packed(np.ldexp(x[fine], -np.frexp(top[fine])[1][:, None]).astype(kind)))
            taken = pa.concat_arrays(codes).take(pa.array(place, mask=place < 0))
            yield _batch("rid vec_id group code", *frame.columns[:3], taken)

    return units


def _ball_cells(plan: Plan, turn: int, whole: bool):
    def cells(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """rid, group, code in; the same and a cell out, or the cell only."""
        for frame in frames:
            out = np.empty(frame.num_rows, dtype=np.int64)
            group = frame.column(1).to_numpy()
            for at, x in _vectors(frame.column(2), plan.kind):
                d = plan.directions(x.shape[1], "balls")[:, turn * plan.ball_k:(turn + 1) * plan.ball_k]
                out[at] = _hashed(group[at] + turn, np.floor(_unit(x) @ d / 2 + 0.37))
            yield _batch("rid group code cell", *frame.columns, out) if whole else _batch("cell", out)

    return cells


def _sums(plan: Plan):
    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """cell, code in; a sum per cell of some MB of rows out."""
        for frame in _held(frames, 1):
            cell = frame.column(0).to_numpy()
            for at, x in _vectors(frame.column(1), plan.kind):
                order = np.argsort(cell[at], kind="stable")
                keys, begin = np.unique(cell[at][order], return_index=True)
                yield _batch("cell total", keys, _packed(np.add.reduceat(_unit(x)[order], begin, axis=0)))

    return sums


def _centres(plan: Plan):
    def centres(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """cell, total in, sorted by cell; a centre per cell out, as numbers of the vectors' precision."""
        key, total = None, None

        def centre() -> Iterator[pa.RecordBatch]:
            top = np.abs(total).max()
            if top > 0:
                yield _batch("cell centre", [key], _packed((total / top).astype(plan.kind)[None]))

        for frame in frames:
            for cell, data in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist()):
                x = np.frombuffer(data, dtype=np.float64)
                if cell == key and len(x) == len(total):
                    total = total + x
                else:
                    if key is not None and cell != key:
                        yield from centre()
                    key, total = cell, x
        if key is not None:
            yield from centre()

    return centres


def _within(plan: Plan):
    def within(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """rid, group, cell, code, centre in; members of balls and their angles to the centre out."""
        for frame in frames:
            same = np.flatnonzero(_sizes(frame.column(3)) == _sizes(frame.column(4)))
            frame = frame.take(pa.array(same))
            angle = np.empty(frame.num_rows)
            for (at, x), (_, y) in zip(_vectors(frame.column(3), plan.kind), _vectors(frame.column(4), plan.kind)):
                # By the chord, which is exact for small angles.
                angle[at] = 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(_unit(x) - _unit(y), axis=1) / 2))
            near = np.flatnonzero(angle <= plan.ball)
            yield _batch("rid group cell angle", *frame.select([0, 1, 2]).take(pa.array(near)).columns, angle[near])

    return within


def _few(frame: DataFrame) -> DataFrame:
    """A written frame, sent to every task if it is small."""
    return F.broadcast(frame) if frame.count() <= SMALL else frame


def _balls(open_: DataFrame, plan: Plan, turn: int) -> tuple[DataFrame, DataFrame] | None:
    """Balls (node, group, code, radius, weight) and their members (rid, node) among open vectors."""
    scratch, given = Scratch(open_.sparkSession, "vector-balls"), open_.select("rid", "group", "code")
    dense = scratch.written(
        given.mapInArrow(_ball_cells(plan, turn, False), "cell long").groupBy("cell").count()
        .where(f"count >= {DENSE}").select("cell"),
        "dense",
    )
    if dense.isEmpty():
        return None
    keyed = given.mapInArrow(_ball_cells(plan, turn, True), "rid long, group long, code binary, cell long")
    inside = keyed.join(_few(dense), "cell")
    sums = inside.select("cell", "code").mapInArrow(_sums(plan), "cell long, total binary")
    centres = scratch.written(
        sums.repartition("cell").sortWithinPartitions("cell").mapInArrow(_centres(plan), "cell long, centre binary"),
        "centres",
    )
    # Centres are vectors: a small part of SMALL of them is at most a few MB.
    side = F.broadcast(centres) if centres.count() <= SMALL // 100 else centres
    near = scratch.written(
        inside.join(side, "cell").select("rid", "group", "cell", "code", "centre")
        .mapInArrow(_within(plan), "rid long, group long, cell long, angle double"),
        "near",
    )
    heads = scratch.written(
        near.groupBy("cell").agg(
            F.min("rid").alias("node"), F.first("group").alias("group"), F.max("angle").alias("radius"),
            F.count("*").alias("weight"),
        ).where("weight > 1"),
        "heads",
    )
    if heads.isEmpty():
        scratch.clear()
        return None
    balls = heads.join(centres, "cell").select("node", "group", F.col("centre").alias("code"), "radius", "weight")
    members = near.join(_few(heads.select("cell", "node")), "cell").select("rid", "node")
    balls, members = written(balls, "vector-heads"), written(members, "vector-members")
    scratch.clear()
    return balls, members


def _lying(plan: Plan, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the caps they lie in, sorted by both."""
    rows, caps, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 1024
    unit = np.empty(x.shape, np.float32)
    for begin in range(0, len(x), 4096):
        unit[begin:begin + 4096] = _unit(x[begin:begin + 4096])
    for first in range(0, plan.tables, step):
        d = plan.caps(x.shape[1], first, min(first + step, plan.tables))
        for begin in range(0, len(x), 4096):
            part = slice(begin, begin + 4096)
            row, cap = np.divmod(_where(unit[part] @ d >= bound[part, None]), d.shape[1])
            rows.append(row + begin)
            caps.append(cap + first)
    row, cap = np.concatenate(rows), np.concatenate(caps)
    order = np.argsort(row, kind="stable")
    return row[order], cap[order]


def _packs(step: int, *keys: np.ndarray) -> np.ndarray:
    """Ends of packs: rows with equal keys, of some KB at most."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    begins = np.flatnonzero(new)
    bounds = np.concatenate([[0], begins, [len(new)]])
    most = max(1, PACK // step)
    ends = [np.arange(most, high - low, most) + low for low, high in zip(bounds[:-1], bounds[1:]) if high - low > most]
    return np.unique(np.concatenate([*ends, bounds[1:]]))


# Packs of nodes; radius and weight are empty where all are single vectors.
NODES = "group long, n int, node binary, code binary, radius binary, weight binary, caps binary, many binary"


def _capped(plan: Plan):
    def capped(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, group, code, radius, weight in; NODES out, with the caps that the nodes lie in.

        Cap -1 has all nodes of a group that isn't large.
        """
        for frame in _held(frames, 2, HELD // 4):
            for at, x in _vectors(frame.column(2), plan.kind):
                node, group, radius, weight = (frame.column(i).to_numpy()[at] for i in (0, 1, 3, 4))
                order = np.lexsort((group, weight > 1))
                x, node, group, radius, weight = x[order], node[order], group[order], radius[order], weight[order]
                large = np.flatnonzero(np.isin(group, plan.large))
                bound = (plan.bound - plan.slope * radius[large]).astype(np.float32)
                row, cap = _lying(plan, x[large], bound)
                other = np.setdiff1d(np.arange(len(x)), large)
                row, cap = np.concatenate([large[row], other]), np.concatenate([cap, np.full(len(other), -1)])
                order = np.argsort(row, kind="stable")
                many = np.bincount(row, minlength=len(x))
                ends = _packs(x.itemsize * x.shape[1], group, weight > 1)
                ball = np.where(weight > 1, 1, 0)
                of_balls = np.cumsum(ball)[ends - 1]
                yield _batch(
                    "group n node code radius weight caps many", group[ends - 1],
                    np.diff(ends, prepend=0).astype(np.int32), _binary(node, ends), _binary(x, ends),
                    _binary(radius[ball > 0], of_balls), _binary(weight[ball > 0], of_balls),
                    _binary(cap[order].astype(np.int32), np.cumsum(many)[ends - 1]),
                    _binary(many.astype(np.int32), ends),
                )
        release_memory()

    return capped


def _crowds(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """group, caps of packs in; group, cap and number of nodes out."""
    for frame in frames:
        cap = _flat(frame.column(1), "i4")
        group = np.repeat(frame.column(0).to_numpy(), _sizes(frame.column(1)) // 4)
        order = np.lexsort((cap, group))
        cap, group = cap[order], group[order]
        new = np.r_[True, (cap[1:] != cap[:-1]) | (group[1:] != group[:-1])][:len(cap)]
        begin = np.flatnonzero(new)
        yield _batch("group cap n", group[begin], cap[begin], np.diff(np.r_[begin, len(cap)]))


def _spread(column: pa.Array, n: np.ndarray, kind: str, other: float) -> np.ndarray:
    """Numbers of the nodes of packs; of packs that don't have them, one and the same."""
    out = np.full(n.sum(), other, dtype=kind)
    out[np.repeat(_sizes(column) > 0, n)] = _flat(column, kind)
    return out


# Packs of the nodes of a cap, with the earlier caps they lie in.
CELLS = "group long, cap int, node binary, code binary, radius binary, weight binary, before binary, many binary"


def _dealt(plan: Plan, low: int, high: int):
    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """NODES in, CELLS of the caps from low to high out."""
        for frame in _held(frames, 3):
            each = _sizes(frame.column(3)) // np.maximum(frame.column(1).to_numpy(), 1)
            for step in np.unique(each):
                part = frame.take(pa.array(np.flatnonzero(each == step)))
                n = part.column(1).to_numpy()
                x = _flat(part.column(3), plan.kind).reshape(n.sum(), -1)
                node, group = _flat(part.column(2), "i8"), np.repeat(part.column(0).to_numpy(), n)
                radius = _spread(part.column(4), n, "f8", 0.0)
                weight = _spread(part.column(5), n, "i8", 1)
                caps, many = _flat(part.column(6), "i4"), _flat(part.column(7), "i4").astype(np.int64)
                begin = np.cumsum(many) - many
                some = np.flatnonzero((caps >= low) & (caps < high))
                row = np.repeat(np.arange(len(node)), many)[some]
                order = np.lexsort((caps[some], group[row], weight[row] > 1))
                row, some = row[order], some[order]
                if not len(row):
                    continue
                ends = _packs(step, caps[some], group[row], weight[row] > 1)
                before = some - begin[row]
                done = 0
                for ends in np.array_split(ends, max(1, len(row) * step // PIECE)):
                    if not len(ends):
                        continue
                    r, b, cap = row[done:ends[-1]], before[done:ends[-1]], caps[some[done:ends[-1]]]
                    ends, done = ends - done, ends[-1]
                    ball = weight[r] > 1
                    of_balls = np.cumsum(ball)[ends - 1]
                    yield _batch(
                        "group cap node code radius weight before many", group[r[ends - 1]], cap[ends - 1],
                        _binary(node[r], ends), _binary(x[r], ends), _binary(radius[r[ball]], of_balls),
                        _binary(weight[r[ball]], of_balls), _binary(caps[_spans(begin[r], b)], np.cumsum(b)[ends - 1]),
                        _binary(b.astype(np.int32), ends),
                    )
        release_memory()

    return dealt


class _Meeting:
    """Links between the members of one cell, or of two blocks of it."""

    def __init__(self, plan: Plan, packs: pa.Table, one: int, two: int):
        self.plan = plan
        column = {name: packs.column(name).combine_chunks() for name in packs.column_names}
        n = _sizes(column["node"]) // 8
        self.node, self.radius = _flat(column["node"], "i8"), _spread(column["radius"], n, "f8", 0.0)
        self.weight = _spread(column["weight"], n, "i8", 1)
        self.given = _flat(column["code"], plan.kind).reshape(len(self.node), -1)
        self.before, self.many = _flat(column["before"], "i4"), _flat(column["many"], "i4").astype(np.int64)
        piece = np.repeat(column["piece"].to_numpy(), n)
        self.sides = np.flatnonzero(piece == one), np.flatnonzero(piece == two)
        self.same = one == two
        self.links = np.zeros(len(self.node), dtype=np.int64)
        self.root: dict[int, int] = {}
        self.open: list[tuple[np.ndarray, np.ndarray]] = []

    def find(self, i: int) -> int:
        while (up := self.root.setdefault(i, i)) != i:
            self.root[i] = i = self.root[up]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = np.array([self.find(i) for i in nodes.tolist()])
        a, b = roots[place[:len(a)]], roots[place[len(a):]]
        pairs = np.unique(np.column_stack([a, b])[a != b], axis=0)
        for x, y in pairs.tolist():
            x, y = self.find(x), self.find(y)
            if x != y:
                low, high = (x, y) if self.node[x] < self.node[y] else (y, x)
                self.root[high] = low

    def settle(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Pairs that passed their counts, and their vectors with length 1."""
        plan = self.plan
        score = np.einsum("ij,ij->i", x, y)
        spread = self.radius[a] + self.radius[b]
        apart = np.linalg.norm(x - y, axis=1)
        angle = 2 * np.arcsin(np.minimum(1.0, apart / 2))
        sure = np.where(spread == 0, score >= plan.cosine, angle + spread <= plan.angle - 1e-9)
        maybe = (spread > 0) & ~sure & (angle - spread <= plan.angle + 1e-9)
        if maybe.any():
            self.open.append((a[maybe], b[maybe]))
        a, b = a[sure], b[sure]
        if len(a):
            np.add.at(self.links, a, self.weight[b])
            np.add.at(self.links, b, self.weight[a])
            self.join(a, b)

    def first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether this is the first cap that a pair shares."""
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        many = self.many[nodes]
        begin = (np.cumsum(self.many) - self.many)[nodes]
        caps, number, times = np.unique(self.before[_spans(begin, many)], return_inverse=True, return_counts=True)
        number, shared = (np.cumsum(times > 1) - 1)[number], (times > 1)[number]
        words = -(-int((times > 1).sum()) // 64)
        if not words:
            return np.ones(len(a), dtype=bool)
        bits = np.zeros((len(nodes), words), dtype=np.uint64)
        row, number = np.repeat(np.arange(len(nodes)), many)[shared], number[shared]
        np.bitwise_or.at(bits, (row, number // 64), np.uint64(1) << (number % 64).astype(np.uint64))
        a, b, step = place[:len(a)], place[len(a):], max(1, (1 << 21) // words)
        return np.concatenate([
            ~(bits[a[i:i + step]] & bits[b[i:i + step]]).any(axis=1) for i in range(0, len(a), step)
        ])

    def decide(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs that may be linked."""
        keep = self.first(a, b)
        a, b = a[keep], b[keep]
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        unit = _unit(self.given[nodes])
        counted = unit @ self.plan.directions(unit.shape[1], "counted")
        x, y = place[:len(a)], place[len(a):]
        half = self.plan.windows(self.radius[nodes])
        hits = np.zeros(len(a), dtype=np.int64)
        for i, least in enumerate(self.plan.counts):
            batch = slice(i * BATCH, (i + 1) * BATCH)
            apart = np.abs(counted[x, batch] - counted[y, batch])
            hits = hits + (apart <= (half[x] + half[y])[:, None]).sum(axis=1)
            keep = hits >= least
            a, b, x, y, hits = a[keep], b[keep], x[keep], y[keep], hits[keep]
        if len(a):
            self.settle(a, b, unit[x], unit[y])

    def run(self, step: int = 256) -> None:
        left, right = self.sides
        most = max(1000, (1 << 21) // self.given.shape[1])  # pairs whose vectors a task holds
        single, angle = self.given.astype(np.float32), self.plan.angle
        single /= np.sqrt(np.einsum("ij,ij->i", single, single))[:, None]
        slack = (2 * single.shape[1] + 16) * 2.0**-23  # the largest error of a product of rows of length 1
        widest = self.radius.max()
        for begin in range(0, len(left), step):
            rows = left[begin:begin + step]
            columns = right[begin:] if self.same else right
            reach = angle + self.radius[rows].max() + widest
            bound = np.float32((cos(reach) if reach < pi else -1) - slack)
            x, y = np.divmod(_where(single[rows] @ single[columns].T >= bound), len(columns))
            if self.same:
                x, y = x[y > x], y[y > x]
            a, b = rows[x], columns[y]
            for i in range(0, len(a), most):
                self.decide(a[i:i + most], b[i:i + most])

    def result(self) -> tuple[list[np.ndarray], ...]:
        """Columns a, b, n, wa, wb: links of nodes (a, a smaller node, their number, 0, 0), open pairs."""
        some = np.flatnonzero(self.links)
        root = np.array([self.find(i) for i in some.tolist()], dtype=np.int64)
        zero = np.zeros(len(some), dtype=np.int64)
        out = [(self.node[some], self.node[root], self.links[some], zero, zero)]
        for a, b in self.open:
            out.append((self.node[a], self.node[b], np.zeros(len(a), np.int64), self.weight[a], self.weight[b]))
        return tuple([o[i] for o in out] for i in range(5))


FOUND = "a long, b long, n long, wa long, wb long"


def _meet(plan: Plan):
    def meet(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """CELLS with one, two, piece in, sorted by group, cap, one, two; FOUND out."""
        held: tuple[list, ...] = ([], [], [], [], [])
        key, packs = None, []

        def solve() -> None:
            table = pa.Table.from_batches(packs)
            if table.num_rows > 1 or _sizes(packs[0].column(2))[0] > 8:
                meeting = _Meeting(plan, table, *key[2:])
                meeting.run()
                for column, new in zip(held, meeting.result()):
                    column.extend(new)

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in held]
            for c in held:
                c.clear()
            return _batch("a b n wa wb", *columns)

        for frame in frames:
            keys = [frame.column(i).to_numpy() for i in (0, 1, 8, 9)]
            new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            bounds = np.r_[0, np.flatnonzero(new) + 1, frame.num_rows]
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if low == high:
                    continue
                this = tuple(int(k[low]) for k in keys)
                if packs and this != key:
                    solve()
                    packs.clear()
                    if sum(map(len, held[0])) > 50_000:
                        yield flush()
                key = this
                packs.append(frame.slice(low, high - low))
        if packs:
            solve()
        yield flush()
        release_memory()

    return meet


def _unpacked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n, node, code, weight of packs in; rid, node, code of single vectors out."""
    for frame in frames:
        frame = frame.take(pa.array(np.flatnonzero(_sizes(frame.column(3)) == 0)))
        n, size = frame.column(0).to_numpy(), _sizes(frame.column(2))
        node, step = _flat(frame.column(1), "i8"), np.repeat(size // np.maximum(n, 1), n)
        whole, ends = _flat(frame.column(2), "u1"), np.cumsum(step)
        yield _batch("rid node code", node, node, _binary(whole, ends))


def _by_members(plan: Plan):
    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """a, b, one, two, side, rid, code in, sorted by the first four; rid, n and a, b of the links out."""

        def solve(rows: list[tuple]) -> pa.RecordBatch | None:
            left, right = ([r for r in rows if r[4] == side] for side in (0, 1))
            if not left or not right:
                return None
            x, y = (
                _unit(np.frombuffer(b"".join(r[6] for r in side), dtype=plan.kind).reshape(len(side), -1))
                for side in (left, right)
            )
            linked = x @ y.T >= plan.cosine
            counts = np.r_[linked.sum(axis=1), linked.sum(axis=0)]
            some = np.flatnonzero(counts)
            rid = np.array([r[5] for r in left + right])[some]
            return _batch("rid n a b", rid, counts[some], np.full(len(some), rows[0][0]), np.full(len(some), rows[0][1]))

        rows: list[tuple] = []
        for frame in frames:
            for row in zip(*(c.to_pylist() for c in frame.columns)):
                if rows and row[:4] != rows[0][:4]:
                    if (out := solve(rows)) is not None:
                        yield out
                    rows = []
                rows.append(row)
        if rows and (out := solve(rows)) is not None:
            yield out

    return compare


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Files of a shuffle are deleted when the table is written that needs them; not with the session."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def _rounds(volume: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """Ranges that are dealt together (from, to) and the rounds for it, of about ``most`` rows each."""
    rounds, sums = [], 0
    for at, rows in sorted(volume.items()):
        if rounds and sums + rows <= most:
            rounds[-1][1], sums = at, sums + rows
        else:
            rounds.append([at, at, 1])
            sums = rows
        rounds[-1][2] = max(rounds[-1][2], ceil(sums / most))
    return [tuple(r) for r in rounds]


def _found(plan: Plan, packs: DataFrame) -> DataFrame:
    """FOUND among nodes: cells are dealt and compared in rounds, of 1.5 rows a node each."""
    spark = packs.sparkSession
    crowds = written(
        packs.select("group", "caps").mapInArrow(_crowds, "group long, cap int, n long")
        .groupBy("group", "cap").agg(F.sum("n").alias("n"))
        .select("group", "cap", "n", F.ceil(F.col("n") / plan.piece).cast("int").alias("pieces")),
        "vector-crowds",
    )
    # Whole ranges are dealt at once; of cells of many pieces, only some pairs of pieces are.
    width = ceil(plan.tables / RANGES)
    at = F.floor(F.col("cap") / width).alias("at")
    volume = {r[0]: r[1] for r in crowds.groupBy(at).agg(F.sum(F.col("n") * F.col("pieces"))).collect()}
    nodes = packs.agg(F.sum("n")).first()[0] or 0
    heavy = crowds.where("pieces > 1").select("group", "cap", "pieces")
    heavy = None if heavy.isEmpty() else _few(heavy)
    cell, found = ["group", "cap", "one", "two"], []
    for low, high, turns in _rounds(volume, max(nodes * 3 // 2, DEALT)):
        first, last = (-1 if low < 0 else low * width), ((high + 1) * width if high >= 0 else 0)
        dealt = packs.mapInArrow(_dealt(plan, first, last), CELLS)
        if heavy is None:
            cut = dealt.select("*", *(F.lit(0).alias(c) for c in ("one", "two", "piece")))
        else:
            pieces = F.coalesce("pieces", F.lit(1))
            cut = (
                dealt.join(heavy, ["group", "cap"], "left")
                .withColumn("piece", F.pmod(F.xxhash64("node"), pieces).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
                .select(
                    *dealt.columns, F.least("piece", "other").alias("one"), F.greatest("piece", "other").alias("two"),
                    "piece",
                )
            )
        for turn in range(turns):
            some = cut if turns == 1 else cut.where(F.pmod(F.xxhash64(*cell), F.lit(turns)) == turn)
            found.append(written(
                some.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_meet(plan), FOUND), "vector-found"
            ))
    whole = spark.createDataFrame([], FOUND)
    for some in found:
        whole = whole.unionByName(some)
    return whole


def linked(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    *, cosine: float = 0.93, miss: float = 1e-6,
) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    Two vectors of one label are linked if their cosine in double precision is ``cosine`` or more;
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id
    reachable over links and ``kept`` marks that vector. A pair at the limit is missed with a
    probability of at most twice ``miss``, a closer one with less; no pair below it is linked.

    Vectors that are null, empty or zero, or hold null or non-finite components, and those with
    a null label or id are linked with nothing, are their own component and are kept. Vectors of
    different lengths aren't compared. Rows that share an id count each; ties and repeated rows
    are linked like any others. Other columns are ignored, whatever their names; an empty table
    gives no rows.

    A label with n vectors that are spread out costs about n to the power of 1.5 products, as many
    for finding the caps (some 2 n / 2 to the power of 0.5) as for the pairs in them, and each vector
    is dealt some 25 to 30 times. Disk is bounded: the copies of vectors there are at a time don't
    grow faster than the input.
    """
    with _shuffles_dropped(vectors.sparkSession):
        return _linked(vectors, vec_id, vector, label, cosine, miss)


def _linked(vectors: DataFrame, vec_id: str, vector: str, label: str, cosine: float, miss: float) -> DataFrame:
    spark = vectors.sparkSession
    given = vectors.schema[vector].dataType
    kind = "f4" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "f8"
    x = F.col(vector) if kind == "f4" else F.col(vector).cast("array<double>")
    source = Scratch(spark, "vector-source")
    units = source.written(
        vectors.select(
            F.monotonically_increasing_id().alias("rid"), F.col(vec_id).cast("long").alias("vec_id"),
            F.xxhash64(F.col(label).cast("string"), F.size(vector)).alias("group"),
            F.when(F.col(label).isNotNull() & F.col(vec_id).isNotNull(), x).alias("x"),
        ).mapInArrow(_units(kind), UNITS),
        "units",
    )
    ids = written(units.select("rid", "vec_id", F.col("code").isNotNull().alias("fine")), "vector-ids")
    open_ = units.where("code is not null").select("rid", "group", "code")
    groups = written(
        open_.groupBy("group").agg(F.count("*").alias("n"), F.max(F.length("code")).alias("size")), "vector-groups"
    )
    largest, size = groups.agg(F.max("n"), F.max("size")).first()
    plan = Plan(largest or 0, cosine, miss, kind, size or 8)
    large = groups.where(F.col("n") > plan.piece).select("group").collect()
    plan.large = np.array(sorted(r[0] for r in large), dtype=np.int64)

    balls = spark.createDataFrame([], "node long, group long, code binary, radius double, weight long")
    members = spark.createDataFrame([], "rid long, node long")
    inner, inner_of = Scratch(spark, "vector-inner"), spark.createDataFrame([], "rid long, node long, code binary")
    for turn in range(ROUNDS):
        new = _balls(open_, plan, turn)
        if new is None:
            continue
        balls, members = balls.unionByName(new[0]), members.unionByName(new[1])
        some = _few(new[1])
        inner_of = inner_of.unionByName(
            inner.written(open_.join(some, "rid").select("rid", "node", "code"), "members")
        )
        rest = Scratch(spark, "vector-open")
        open_ = rest.written(open_.join(some.select("rid"), "rid", "left_anti"), "open")
        source.clear()
        source = rest
    single = open_.select(
        F.col("rid").alias("node"), "group", "code", F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("weight")
    )
    nodes = Scratch(spark, "vector-nodes")
    packs = nodes.written(
        balls.unionByName(single).select("node", "group", "code", "radius", "weight")
        .mapInArrow(_capped(plan), NODES),
        "packs",
    )
    source.clear()
    found = _found(plan, packs)

    # Pairs of balls that their bounds leave open: their members are compared, block by block.
    parts = [F.ceil(F.col(w) / BLOCK).cast("int") for w in ("wa", "wb")]
    pairs = written(
        found.where("wa > 0").select("a", "b", parts[0].alias("pa"), parts[1].alias("pb")), "vector-pairs"
    )
    by_members = spark.createDataFrame([], "rid long, n long, a long, b long")
    if not pairs.isEmpty():
        sides = pairs.select("*", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("a").alias("node")),
            F.struct(F.lit(1).alias("side"), F.col("b").alias("node")),
        )).alias("s")).select("a", "b", "pa", "pb", "s.side", "s.node")
        needed = _few(written(sides.select("node").distinct(), "vector-needed"))
        alone = packs.select("n", "node", "code", "weight").mapInArrow(_unpacked, "rid long, node long, code binary")
        some = nodes.written(inner_of.unionByName(alone).join(needed, "node", "left_semi"), "compared")
        own = F.pmod(F.xxhash64("rid"), F.when(F.col("side") == 0, F.col("pa")).otherwise(F.col("pb"))).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("pb")).otherwise(F.col("pa")) - 1))
        block = ["a", "b", "one", "two"]
        by_members = written(
            sides.join(some, "node").withColumn("own", own).withColumn("other", other).select(
                "a", "b", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("one"),
                F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("two"), "side", "rid", "code",
            )
            .repartition(*block).sortWithinPartitions(*block)
            .mapInArrow(_by_members(plan), "rid long, n long, a long, b long"),
            "vector-by-members",
        )
    nodes.clear()
    inner.clear()

    links = found.where("wa = 0 and a <> b").select("a", "b").unionByName(by_members.select("a", "b").distinct())
    per_node = written(
        balls.select("node", (F.col("weight") - 1).alias("n"), F.lit(None).cast("long").alias("component"))
        .unionByName(found.where("wa = 0").select(F.col("a").alias("node"), "n", F.lit(None).alias("component")))
        .unionByName(components(links).select("node", F.lit(0).alias("n"), "component"))
        .groupBy("node").agg(F.sum("n").alias("node_links"), F.max("component").alias("component")),
        "vector-nodes",
    )
    of_rows = written(by_members.groupBy("rid").agg(F.sum("n").alias("row_links")), "vector-row-links")
    rows = written(
        ids.where("fine").join(members, "rid", "left").withColumn("node", F.coalesce("node", "rid"))
        .join(per_node, "node", "left").join(of_rows, "rid", "left")
        .select(
            F.coalesce("component", "node").alias("component"), "vec_id",
            (F.coalesce("node_links", F.lit(0)) + F.coalesce("row_links", F.lit(0))).cast("long").alias("n_links"),
        ),
        "vector-rows",
    )
    least = written(rows.groupBy("component").agg(F.min("vec_id").alias("component_id")), "vector-least")
    inside = rows.join(least, "component").select("vec_id", "n_links", "component_id")
    alone = ids.where("not fine").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return inside.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
