"""Vector expressions on array columns, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Added to denominators so that a zero vector scores 0 instead of failing.
EPSILON = 1e-9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + EPSILON)


def l2_normalise(a: Column) -> Column:
    length = norm(a) + EPSILON
    return F.transform(a, lambda x: x.cast("double") / length)


def pseudo_embedding(text: Column, dim: int) -> Column:
    """Unit vector that depends only on the text (test data).

    Each element sums four hash-based uniforms, which is close enough to normal.
    """

    def element(i: Column) -> Column:
        parts = [
            F.pmod(F.xxhash64(F.md5(text.cast("binary")), i, F.lit(j)), F.lit(1_000_003))
            for j in range(4)
        ]
        return (parts[0] + parts[1] + parts[2] + parts[3]) / 1_000_003.0 - 2.0

    return l2_normalise(F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), element))
