"""Array-valued helpers (F5, F6, F7) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_last(c) -> Column:
    """``l[:-1]``: every element but the last; an empty array stays empty."""
    col = _col(c)
    return F.slice(col, 1, F.greatest(F.size(col) - 1, F.lit(0)))


def affine(c, offset: float, scale: float) -> Column:
    """Element-wise ``offset + scale * x``."""
    return F.transform(_col(c), lambda x: F.lit(offset) + F.lit(scale) * x)


def euclidean(x, y) -> Column:
    """Euclidean distance of two arrays, zipped to the shorter one.

    Zipping to the shorter length is the reference's behaviour; elements past
    the common length are ignored. The expression doesn't grow with the width.
    """
    a, b = _col(x), _col(y)
    n = F.least(F.size(a), F.size(b))
    a, b = F.slice(a, 1, n), F.slice(b, 1, n)
    sq = F.zip_with(a, b, lambda u, v: (u - v) * (u - v))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, t: acc + t))
