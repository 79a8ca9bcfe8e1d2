"""Counter-based random numbers (F8): each value is a function of the seed, the row's
id and a stream number alone.

Unlike ``rand`` and ``randn`` they don't depend on the partitioning or on the order of
the rows, a retried task draws the same again, and any engine with BIGINT arithmetic
computes the same values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lehmer multipliers modulo 2^31 - 1; products stay below 2^47.
MODULUS, FIRST, SECOND = 2147483647, 48271, 40692


def stream_key(seed: int, stream: int) -> int:
    """The constant that tells streams and seeds apart."""
    return ((seed % MODULUS) * 16807 + (stream % MODULUS) * 69621 + 1) * FIRST % MODULUS


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def counter_bits(id_col: Column | str, seed: int, stream: int = 0) -> Column:
    """BIGINT in [0, 2^31 - 2]: three Lehmer steps with xor-shifts between them."""
    key, m = F.lit(stream_key(seed, stream)).cast("bigint"), F.lit(MODULUS).cast("bigint")
    i = _column(id_col).cast("bigint")
    x = F.pmod(F.pmod(i, m) * FIRST + key, m)
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = F.pmod(x * SECOND + F.pmod(F.shiftright(i, 31), m) + key, m)
    x = x.bitwiseXOR(F.shiftright(x, 13))
    return F.pmod(x * FIRST + key, m)


def uniform(id_col: Column | str, seed: int, stream: int = 0) -> Column:
    """DOUBLE strictly between 0 and 1."""
    return (counter_bits(id_col, seed, stream) + F.lit(0.5)) / F.lit(float(MODULUS))


def uniform_int(id_col: Column | str, n: int, seed: int, stream: int = 0) -> Column:
    """INT in [0, n - 1]."""
    return F.floor(counter_bits(id_col, seed, stream) * F.lit(n).cast("bigint") / F.lit(float(MODULUS))).cast("int")


def gaussian(id_col: Column | str, seed: int, stream: int = 0) -> Column:
    """N(0, 1) by Box and Muller, from the uniform streams 2 s and 2 s + 1."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(id_col, seed, 2 * stream)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(id_col, seed, 2 * stream + 1))


def fold(values: Column) -> Column:
    """BIGINT in [0, 2^31 - 2] from an array of numbers, to the 20th binary place: an
    id for rows that have none but their content."""
    m = F.lit(MODULUS).cast("bigint")
    return F.aggregate(values, F.lit(1).cast("bigint"),
                       lambda x, v: F.pmod(x * FIRST + F.pmod(F.floor(v.cast("double") * float(1 << 20)).cast("bigint"), m), m))
