"""Mixing sources to target weights by a temperature. DataFrame functions only.

A source's weight is its share of the tokens to the power of an exponent, normalised: 1 keeps the
shares, 0 makes all sources equal. The exponent is bisected, many candidates a pass, until the
weights have the wanted entropy or repeat no source more than the limit.

A budget of tokens is realised by permutations of blocks. Documents are dealt into blocks by a
hash; each epoch of a source goes through its blocks in another order. Whole epochs take every
document; the last one takes blocks in order while the budget lasts, and documents in order within
the block where it ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import Scratch, written

CANDIDATES = 32
STEPS = 10_000
ORDER = ("at", "source", "position", "tie")
SMALL = 100_000  # sources that may be sent to every task
WHITE = " \t\n\x0b\f\r"


def _draw(*parts: Column) -> Column:
    """A number of 60 bits from a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 15), 16, 10).cast("long")


def words(text: Column) -> Column:
    """The number of words of a whole text: the default measure of tokens."""
    plain = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def _measures(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights, and the largest repetition over the smallest, for each exponent."""
    log = F.log("share")
    columns = [c for i, a in enumerate(exponents) for c in (
        F.sum(F.exp(a * log)).alias(f"z{i}"), F.sum(F.exp(a * log) * log).alias(f"s{i}"),
    )]
    row = shares.agg(F.min(log).alias("least"), F.max(log).alias("most"), *columns).first()
    if row.least is None:
        return [(0.0, 1.0)] * len(exponents)
    return [
        (math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"], math.exp((1 - a) * (row.most - row.least)))
        for i, a in enumerate(exponents)
    ]


def exponent(
    shares: DataFrame, *, entropy: float | None = None, repetition: float | None = None
) -> float:
    """The smallest exponent in [0, 1], in steps of 0.0001, that meets the target.

    ``entropy``: the wanted share (0 to 1) of the way from the sources' own entropy to that of equal
    weights, at most. ``repetition``: the most times that one source is seen more often than
    another. Both fall as the exponent rises, so that it is bisected, many candidates a pass.
    """
    (flat, _), (own, _) = _measures(shares, [0.0, 1.0])

    def meets(measures: tuple[float, float]) -> bool:
        if entropy is not None:
            return measures[0] <= own + entropy * (flat - own)
        return measures[1] <= repetition

    low, high = -1, STEPS  # the target is missed at low and met at high
    while high - low > 1:
        grid = sorted({low + (high - low) * (i + 1) // (CANDIDATES + 1) for i in range(CANDIDATES)} - {low})
        for step, measures in zip(grid, _measures(shares, [g / STEPS for g in grid])):
            if meets(measures):
                high = step
                break
            low = step
    return high / STEPS


def weights(
    rows: DataFrame, *, entropy: float | None = None, repetition: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """Per source: tokens, share, weight, budget (tokens) and whole epochs.

    ``rows``: source, tokens. Without a total ``budget`` it is the least at which every source is
    seen once in full, so that nothing is left out.
    """
    sources = rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = sources.agg(F.sum("tokens")).scalar()
    shares = written(
        sources.select("source", "tokens", (F.col("tokens") / total).alias("share")), "mixing-shares"
    )
    a = exponent(shares, entropy=entropy, repetition=repetition)
    raw = F.exp(a * F.log("share"))
    norm = shares.agg(F.sum(raw)).scalar()
    whole = F.lit(budget)
    if budget is None:
        whole = shares.agg(F.sum("tokens") * F.max(F.col("share") / raw)).scalar() * norm
    return shares.select(
        "source", "tokens", "share", (raw / norm).alias("weight"),
        F.greatest(F.round(whole * raw / norm).cast("long"), F.lit(0)).alias("budget"),
    ).withColumn("epochs", F.expr("budget div tokens"))


class _Mix:
    """What is planned for a table: how often a row of a source and with a draw is taken, and where."""

    def __init__(
        self, rows: DataFrame, *, seed: int, block_tokens: int, entropy: float | None,
        repetition: float | None, budget: int | None,
    ):
        """``rows``: source, n_tokens and draw of every document."""
        self.seed = seed
        self.scratch = Scratch(rows.sparkSession, "mixing")
        self.rows = self.scratch.written(rows, "rows")
        plan = weights(
            self.rows.select("source", F.col("n_tokens").alias("tokens")), entropy=entropy,
            repetition=repetition, budget=budget,
        )
        self.plan = self.scratch.written(
            plan.withColumn("left", F.col("budget") - F.col("epochs") * F.col("tokens"))
            .withColumn("blocks", F.expr(f"tokens div {block_tokens} + 1")),
            "weights",
        )
        self.few = self.plan.count() <= SMALL
        self._last_epoch()

    def _joined(self, frame: DataFrame, side: DataFrame, send: bool) -> DataFrame:
        """A left join by source, and by block (and epoch) where the side has them."""
        keys = [c for c in ("source", "block", "epoch") if c in side.columns]
        side = side.withColumnsRenamed({c: f"of_{c}" for c in keys})
        same = F.lit(True)
        for c in keys:
            same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
        return frame.join(F.broadcast(side) if send else side, same, "left").drop(*[f"of_{c}" for c in keys])

    def dealt(self, frame: DataFrame) -> DataFrame:
        """A frame with source and draw, with its source's plan and the row's block."""
        side = self.plan.select("source", "blocks", "epochs", "left", "weight")
        # The draw picks the block with its high bits and the place in the block with all of them.
        high = F.call_function("shiftright", F.col("draw"), F.lit(20))
        return self._joined(frame, side, self.few).withColumn("block", F.pmod(high, F.coalesce("blocks", F.lit(1))))

    def turn(self, epoch: str) -> Column:
        return _draw(F.lit(str(self.seed)), *[F.col(c).cast("string") for c in ("source", epoch, "block")])

    def _last_epoch(self) -> None:
        """The last epoch takes blocks in the order of their own turns, by sums per block."""
        dealt = self.dealt(self.rows)
        sums = (
            dealt.where("blocks is not null").groupBy("source", "block")
            .agg(F.sum("n_tokens").alias("in_block"), F.max("epochs").alias("epochs"), F.max("left").alias("left"))
        )
        in_turn = Window.partitionBy("source").orderBy(self.turn("epochs"), "block")
        room = F.greatest(F.col("left") - F.col("before"), F.lit(0))
        blocks = self.scratch.written(
            sums.withColumn("before", F.sum("in_block").over(in_turn) - F.col("in_block"))
            .select("source", "block", room.alias("room"), "in_block"),
            "blocks",
        )
        use = F.when(F.col("room") >= F.col("in_block"), "full").when(F.col("room") > 0, "part").otherwise("none")
        self.uses = blocks.select("source", "block", use.alias("use"))
        # Blocks number the tokens over ``block_tokens``: their size is checked before they are sent.
        self.sent = blocks.count() <= SMALL
        # A block is taken in full, in part (one per source, which has about ``block_tokens``) or not.
        partly = blocks.where("room > 0 and room < in_block").select("source", "block", "room")
        places = Window.partitionBy("source").orderBy("draw", "n_tokens")
        edge = (
            self._joined(dealt, partly, self.few).where("room is not null")
            .select("source", "draw", "n_tokens", "room")
            .withColumn("upto", F.sum("n_tokens").over(places.rowsBetween(Window.unboundedPreceding, -1)))
            .where(F.coalesce("upto", F.lit(0)) < F.col("room"))
            .groupBy("source").agg(F.max("draw").alias("last_draw"))
        )
        self.edges = self.scratch.written(edge, "edges")

    def taken(self, frame: DataFrame) -> DataFrame:
        """A frame with source and draw, with block, position, weight, epochs and copies."""
        used = self._joined(self._joined(self.dealt(frame), self.uses, self.sent), self.edges, self.few)
        part = (F.col("use") == "part") & (F.col("draw") <= F.col("last_draw"))
        extra = F.coalesce((F.col("use") == "full") & (F.col("left") > 0) | part, F.lit(False))
        copies = F.when(F.col("epochs").isNull(), 1).otherwise(F.col("epochs") + extra.cast("long")).cast("long")
        return used.withColumn("position", F.col("draw")).withColumn("copies", copies).drop(
            "draw", "blocks", "left", "use", "last_draw"
        )

    def epochs(self, frame: DataFrame) -> DataFrame:
        """What `taken` gives, with a row per epoch, from 0, and its block's turn in it."""
        rows = self.taken(frame).where("copies > 0")
        rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        return rows.withColumn("turn", self.turn("epoch"))

    def placed(self, frame: DataFrame) -> DataFrame:
        """What `epochs` gives, with each row's place in its source's run."""
        # By sums per block and epoch, which are few; documents lie within their block by their draw.
        run = Window.partitionBy("source").orderBy("epoch", "turn", "block")
        places = self.scratch.written(
            self.epochs(self.rows).groupBy("source", "epoch", "turn", "block")
            .agg(F.count("*").alias("in_block"), F.max("position").alias("top"))
            .withColumn("upto", F.sum("in_block").over(run))
            .withColumn("all", F.sum("in_block").over(Window.partitionBy("source"))).drop("turn"),
            "places",
        )
        within = F.col("position") / (F.col("top") + 1)  # even, as positions are draws
        return self._joined(self.epochs(frame), places, places.count() <= SMALL).withColumn(
            "at", (F.col("upto") - F.col("in_block") + within * F.col("in_block")) / F.col("all")
        ).drop("in_block", "upto", "all", "top")


def _planned(
    docs: DataFrame, carried: list[str], *, source: str = "source", doc_id: str = "doc_id",
    text: str = "text", tokens: Column | None = None, entropy: float | None = None,
    repetition: float | None = None, budget: int | None = None, seed: int = 7, block_tokens: int = 1 << 20,
) -> tuple[_Mix, DataFrame]:
    """The plan of a mix, and the rows to apply it to: row (the carried columns), source, n_tokens, draw."""
    count = words(F.col(text)) if tokens is None else tokens.cast("long")
    draw = _draw(F.lit(str(seed)), F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.col(source).cast("string").alias("source"), F.coalesce(count, F.lit(0)).alias("n_tokens"),
        draw.alias("draw"),
    )
    plan = _Mix(
        rows.drop("row"), seed=seed, block_tokens=block_tokens, entropy=entropy, repetition=repetition, budget=budget
    )
    return plan, rows


def mixed(docs: DataFrame, carried: list[str], **settings) -> DataFrame:
    """Every document with its part in the mix: ``row`` (the carried columns), source, n_tokens,
    block, position (an order within the block), weight, epochs and copies.

    Settings: ``source``, ``doc_id``, ``text`` (names of columns), ``tokens`` (a measure, else the
    number of words of the whole text), one of the targets ``entropy`` and ``repetition``, a
    total ``budget`` of tokens, ``seed`` and ``block_tokens``.

    ``copies`` counts how often the document is taken: once per whole epoch of its source, and once
    more if the last epoch's budget reaches it. That epoch takes a document while the tokens taken
    before it are below the budget, so that a source is over it by less than one document. A null
    source is a source of its own. Null and empty texts, and others without tokens, cost nothing
    and are taken once per whole epoch; if their whole source has none, once. Texts of any length
    are counted whole. Equal rows share block and position and are taken alike. An empty table
    stays empty. Columns that aren't carried are left out, whatever their names.
    """
    plan, rows = _planned(docs, carried, **settings)
    return plan.taken(rows)


def epochs_of(docs: DataFrame, carried: list[str], **settings) -> DataFrame:
    """A row per document and epoch: the columns of `mixed`, epoch (from 0), turn, at and tie.

    ``turn`` is the place of the block in its source's order in that epoch, a draw from the seed,
    source, epoch and block; ``at`` is the row's place in its source's whole run, from 0 to 1: its
    epochs one after the other, the blocks of each in order of their turns, the documents of a block
    in order of their positions. The last, partial epoch takes blocks in the same order of turns by
    which `mixed` chose them. Sorted by ``at``, every source is spread over the mix in proportion.
    ``tie`` parts equal rows, so that a sort can deal many of them over its tasks.
    """
    plan, rows = _planned(docs, carried, **settings)
    return plan.placed(rows).withColumn(
        "tie", F.xxhash64("position", "epoch", F.monotonically_increasing_id())
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them, a row per epoch, with their columns as they came.

    Sorted by place, so that epochs of one document lie apart and sources are spread.
    """
    return epochs_of(docs, docs.columns, **settings).orderBy(*ORDER).select("row.*")
