"""Running results along an order, for keys that may hold a large part of all rows.

A window per key puts all rows of a key in one task. Here a heavy key is cut
into consecutive pieces. What a piece needs to know of the pieces before it is
worked out from one summary row per piece, and enters the piece as an extra
first row, so the windows run once, per (key, piece), after a single shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.session import shuffle_width, written

# A key with fewer rows than this is never cut.
LEAST_HEAVY_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: list[str], least_rows: int = LEAST_HEAVY_ROWS) -> DataFrame:
    """Keys (``_heavy_<key>``) with more rows than a quarter of an average shuffle partition.

    There are at most four times as many as shuffle partitions, whatever the data, so the
    result may be broadcast. ``_pieces`` is the number of such quarters that a key fills.
    """
    counts = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).scalar()
    limit = F.greatest(total / (4 * shuffle_width(df.sparkSession)), F.lit(least_rows), F.lit(1))
    return counts.filter(F.col("_n") > limit).select(
        *[F.col(k).alias(f"_heavy_{k}") for k in keys], F.ceil(F.col("_n") / limit).cast("int").alias("_pieces")
    )


def _cuts(df: DataFrame, keys: list[str], order: str, heavy: DataFrame) -> DataFrame:
    """Heavy keys with the quantiles of their own rows that cut them into even pieces."""
    own = df.join(F.broadcast(heavy), _all(keys, "_heavy_")).groupBy(
        *[f"_heavy_{k}" for k in keys], "_pieces"
    )
    # As many quantiles as the heaviest key needs, which is bounded by the shuffle width; a lighter
    # key takes those nearest to its own number of pieces.
    most = max(2, heavy.agg(F.max("_pieces")).first()[0] or 0)
    quantiles = [i / most for i in range(1, most)]
    every = own.agg(F.percentile_approx(order, quantiles, max(1000, 10 * most)).alias("_every"))
    step = F.greatest(F.floor(F.lit(most) / F.col("_pieces")).cast("int"), F.lit(1))
    return every.select(
        *[f"_heavy_{k}" for k in keys],
        F.filter("_every", lambda c, i: F.pmod(i + 1, step) == 0).alias("_cuts"),
    )


def _all(keys: list[str], prefix: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def in_pieces(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    piece: Column | None,
    carry: dict[str, str],
    least_rows: int = LEAST_HEAVY_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """Rows with the extra first rows of pieces, and the window to run over them.

    ``piece`` must not decrease along ``order`` and must not be NULL. Without it a heavy key is
    cut at quantiles of its own rows along the first order column. ``carry`` says per column what
    the extra row holds: ``sum`` of all earlier rows, the ``last`` earlier value,
    or the ``last_set`` (last one that is not NULL). The extra rows have
    ``_is_row`` 0; drop them with `real_rows` after applying the window. The rows
    are read up to four times, so pass written or cached ones if they are costly.
    """
    heavy = heavy_keys(df, keys, least_rows)
    if piece is None:
        heavy = written(_cuts(df, keys, order[0], written(heavy, "heavy-keys")), "heavy-cuts")
        first = F.col(order[0])
        # NULLs are first in the order, and so in the first piece.
        piece = F.size(F.filter("_cuts", lambda c: c < first))
    heavy = F.broadcast(heavy.withColumn("_is_heavy", F.lit(True)))
    marked = (
        df.join(heavy, _all(keys, "_heavy_"), "left")
        .withColumn("_piece", F.when(F.col("_is_heavy"), piece))
        .drop("_is_heavy", "_cuts", "_pieces", *[f"_heavy_{k}" for k in keys])
        .withColumn("_is_row", F.lit(1))
    )
    at = F.struct(*order)
    how = {
        "sum": lambda c: F.sum(c),
        "last": lambda c: F.max_by(c, at),
        "last_set": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)),
    }
    summary = (
        marked.filter(F.col("_piece").isNotNull())
        .groupBy(*keys, "_piece")
        .agg(*[how[kind](c).alias(c) for c, kind in carry.items()])
    )
    pieces = Window.partitionBy(*keys).orderBy("_piece")
    before = pieces.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "sum": lambda c: F.sum(c).over(before),
        "last": lambda c: F.lag(c).over(pieces),
        "last_set": lambda c: F.last(c, ignorenulls=True).over(before),
    }
    first_rows = summary.select(
        *keys, "_piece", F.lit(0).alias("_is_row"), F.row_number().over(pieces).alias("_nth"),
        *[carried[kind](c).alias(c) for c, kind in carry.items()],
    ).filter(F.col("_nth") > 1).drop("_nth")
    rows = marked.unionByName(first_rows, allowMissingColumns=True)
    return rows, Window.partitionBy(*keys, "_piece").orderBy("_is_row", *order)


def real_rows(df: DataFrame) -> DataFrame:
    """Without the extra first rows and helper columns."""
    return df.filter(F.col("_is_row") == 1).drop("_is_row", "_piece")
