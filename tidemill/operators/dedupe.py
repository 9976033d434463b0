"""Latest row per key, and the change-only filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.prefix import LEAST_HEAVY_ROWS, in_pieces, real_rows


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    newest_first: list[str],
    tie_break: Iterable[str] | None = None,
) -> DataFrame:
    """One row per key: the newest, where a NULL time counts as newest.

    Remaining ties are broken by ``tie_break`` (default: all other columns), so a
    replay picks the same row. Spark keeps only the first row per key in each
    task before the shuffle (the window group limit), so a heavy key sends one
    row per task.
    """
    used = {name.lower() for name in [*keys, *newest_first]}
    rest = list(tie_break) if tie_break is not None else [
        c for c in df.columns if c.lower() not in used
    ]
    order = [F.col(f"`{c}`").desc_nulls_first() for c in [*newest_first, *rest]]
    by_key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(by_key))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_changes(
    df: DataFrame, keys: list[str], order: list[str], value: Column, piece: Column | None = None,
    least_rows: int = LEAST_HEAVY_ROWS,
) -> DataFrame:
    """Rows whose value differs from the key's preceding one; first rows are kept.

    Exact for any number of keys: nothing is evicted. NULL equals NULL. ``piece``
    cuts the rows of a heavy key, e.g. by a range of offsets; it must not decrease along
    ``order``. Without it the key's own quantiles cut it.
    """
    valued = df.withColumn("_value", F.struct(value.alias("v")))
    rows, along = in_pieces(valued, keys, order, piece, {"_value": "last"}, least_rows)
    compared = rows.withColumn("_before", F.lag("_value").over(along))
    changed = F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(F.col("_value.v"))
    return real_rows(compared).filter(changed).drop("_value", "_before")
