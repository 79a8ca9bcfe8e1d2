"""String helpers (F1, F2, F4): all native column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.strip()`` removes, derived by rule from
# ``str.isspace`` (the highest such code point is U+3000).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing whitespace of every kind, like ``str.strip()``.

    ``F.trim`` removes only ASCII spaces; ``btrim`` with the full set keeps the
    work inside codegen (no regex, no UDF). NULL stays NULL.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def split_fields(c, sep: str = ",") -> Column:
    """Split on a literal separator, keeping empty trailing fields (``str.split``)."""
    return F.split(_col(c), re.escape(sep), -1)


def field(parts, i: int) -> Column:
    """0-based field ``i`` of an array, NULL when the line is too short."""
    return F.get(_col(parts), i)
