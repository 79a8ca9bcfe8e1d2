"""Embedding whitening (operator 11): exact characteristic polynomial.

Vectors are scaled to integers x. With n distinct vectors (the fit list) and sums S,
M = n * sum(x x') - S S' is n * n times their covariance, and an integer matrix.

1. One pass over the fit list gives n, S and sum(x x') exactly: 22-bit limbs are
   multiplied as doubles in blocks whose sums stay below 2**53. Tasks write the
   triangle of their partial sums, and Spark adds them up as decimals.
2. det(t I - M) modulo enough primes below 2**31, a Spark task for some primes each:
   Hessenberg form by elimination, then the polynomial of its leading blocks. Chinese
   remaindering gives the integer coefficients, whose size is bounded beforehand.
3. All roots are real, so the sign changes of the coefficients around a point count
   the roots above it exactly (Budan, Fourier). Halving isolates the largest roots,
   safeguarded Newton steps on exact integers narrow them to 2**-``ROOT_BITS``. Roots
   that can't be told apart at that width are one root with a multiplicity.
4. The null space of M - e I is found by inverse iteration in long decimals, as many
   vectors as the root's multiplicity, made orthonormal; only then rounded to double.

What is handled in the driver is one d x d matrix and its polynomial, whatever the
number of rows.

Results: a row whose vector is null, empty, or holds null or non-finite entries is left
out, and so is one whose length isn't the most frequent of the fit list (of several,
the greatest). |scale * c| counts as at most 2**62. Components with eigenvalue 0 can't be
whitened and are left out (so a fit list of one vector gives no rows); ties of
eigenvalues give any orthonormal basis, the same for all rows. Repeated rows count once
in the fit list and come back each. A deviation beyond a long is null. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import only, saved

LIMB = 22
PART = 60  # bits of the low part of a sum sent as two decimals
ROOT_BITS = 128
TOP_PRIME = (1 << 31) - 1


class Fit(NamedTuple):
    """n, sums of the integers without their offset, eigenvalues of M falling (exact to
    2**-ROOT_BITS), unit vectors as rows, trace of M, and the offset."""
    n: int
    sums: list[int]
    roots: list[Fraction]
    vectors: np.ndarray
    trace: int
    offset: int


# -- exact sums ---------------------------------------------------------------

def gram(y: np.ndarray) -> np.ndarray:
    """y' y of an int64 matrix as Python integers."""
    limbs, rest = [], y
    while len(rest) and int(max(rest.max(), -int(rest.min()))) >= 1 << LIMB:
        limbs.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
    limbs.append(rest)
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            most = max(1, int(np.abs(a).max(initial=1))) * max(1, int(np.abs(b).max(initial=1)))
            block = max(1, (1 << 53) // most)
            for k in range(0, len(y), block):
                part = a[k:k + block].T.astype(np.float64) @ b[k:k + block].astype(np.float64)
                out += part.astype(np.int64).astype(object) << (LIMB * (i + j))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of column ``y``, each an array of ``dims`` longs."""
    upper = np.triu_indices(dims + 1)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1), object)
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch.column(0))
                total += gram(np.hstack([np.ones((len(y), 1), np.int64), y]))
        values = [int(v) for v in total[upper]]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array([Decimal(v >> PART) for v in values], kind),
             pa.array([Decimal(v & ((1 << PART) - 1)) for v in values], kind)], ["at", "high", "low"])

    parts = fit.select("y").mapInArrow(partial, "at int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # d * d / 2 rows
    out = [[0] * (dims + 1) for _ in range(dims + 1)]
    for r in rows:
        i, j = int(upper[0][r["at"]]), int(upper[1][r["at"]])
        out[i][j] = out[j][i] = (int(r["high"]) << PART) + int(r["low"])
    return out[0][0], out[0][1:], [row[1:] for row in out[1:]]


# -- characteristic polynomial ------------------------------------------------

def is_prime(p: int) -> bool:
    """For p below 2**31 (Miller-Rabin with bases 2, 3, 5, 7)."""
    if p < 11 or p % 2 == 0:
        return p in (2, 3, 5, 7)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product passes ``bound``."""
    out, product, p = [], 1, TOP_PRIME
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t I - m) modulo the prime p, lowest degree first."""
    h, d = m % p, len(m)
    for k in range(d - 2):
        pivots = np.flatnonzero(h[k + 1:, k])
        if not len(pivots):
            continue
        if r := int(pivots[0]):
            h[[k + 1, k + 1 + r]] = h[[k + 1 + r, k + 1]]
            h[:, [k + 1, k + 1 + r]] = h[:, [k + 1 + r, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # of the leading blocks
    polys[0, 0] = 1
    for k in range(d):
        row = np.zeros(d + 1, np.int64)
        row[1:] = polys[k, :-1]
        factors, chain = np.empty(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            factors[i] = int(h[i, k]) * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else chain
        polys[k + 1] = (row - (factors[:, None] * polys[:k + 1] % p).sum(0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - m), lowest degree first, of an integer matrix without
    negative eigenvalues. One task for each few primes."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    primes = primes_beyond(2 * (2 + trace // d) ** d)  # the product of all (1 + e) is at most (1 + trace / d) ** d

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(m, object)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            polys = [polynomial_mod((whole % primes[i]).astype(np.int64), primes[i]).tolist() for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(polys, pa.list_(pa.int64()))], ["id", "poly"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(residues, "id bigint, poly array<bigint>").collect()
    whole = 1
    for p in primes:
        whole *= p
    out = [0] * (d + 1)
    for r in found:
        p = primes[r["id"]]
        rest = whole // p
        unit = rest * pow(rest, -1, p)
        out = [c + unit * x for c, x in zip(out, r["poly"])]
    out = [c % whole for c in out]
    return [c - whole if 2 * c > whole else c for c in out]


# -- real roots ---------------------------------------------------------------

def roots_above(poly: list[int], at: int, bits: int) -> int:
    """How many roots (all are real) lie above at / 2**bits, with multiplicity."""
    d = len(poly) - 1
    c = [x << (bits * (d - k)) for k, x in enumerate(poly)]  # the roots times 2**bits
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_and_slope(poly: list[int], at: int, bits: int) -> tuple[int, int]:
    """Polynomial and derivative at at / 2**bits, times 2**(bits * degree) and
    2**(bits * (degree - 1))."""
    value, slope, scale = 0, 0, 0
    for c in reversed(poly):
        slope = slope * at + value
        value = value * at + (c << scale)
        scale += bits
    return value, slope


def narrowed(poly: list[int], low: int, high: int, bits: int) -> int:
    """The one root above low / 2**bits, up to high / 2**bits, as a multiple of
    2**-bits; Newton steps, halving where they leave the interval."""
    rising = value_and_slope(poly, high, bits)[0] >= 0
    at = high
    while high - low > 1:
        value, slope = value_and_slope(poly, at, bits)
        if value == 0:
            return at
        if (value > 0) == rising:
            high = min(high, at)
        else:
            low = max(low, at)
        step = at - value // slope if slope else low
        if step in (at, at - 1, at + 1):  # narrow: look beside it
            step = high - 1 if at == high else low + 1
        at = step if low < step < high else (low + high) // 2
    return high


def largest_roots(poly: list[int], k: int) -> list[tuple[Fraction, int]]:
    """(root, multiplicity), falling, until ``k`` roots are named; positive ones only."""
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    d = len(poly) - 1
    if not d:
        return []
    top = 1 << max(1, (-poly[-2]).bit_length())  # the sum of the roots
    out, named = [], 0
    stack = [(0, top, 0, d, 0)]  # low, high, bits, roots above low, roots above high
    while stack and named < k:
        low, high, bits, above_low, above_high = stack.pop()
        count = above_low - above_high
        if not count:
            continue
        if count == 1 or (bits == ROOT_BITS and high - low == 1):
            more = ROOT_BITS - bits
            root = narrowed(poly, low << more, high << more, ROOT_BITS) if count == 1 else high
            out.append((Fraction(root, 1 << ROOT_BITS), count))
            named += count
            continue
        if high - low == 1:
            more = min(8, ROOT_BITS - bits)
            low, high, bits = low << more, high << more, bits + more
        middle = (low + high) // 2
        above = roots_above(poly, middle, bits)
        stack += [(low, middle, bits, above_low, above), (middle, high, bits, above, above_high)]
    return out


# -- null spaces --------------------------------------------------------------

def null_vectors(m: list[list[int]], root: Fraction, k: int) -> list[list[Decimal]]:
    """``k`` orthonormal vectors of the space that m - root I all but sends to zero."""
    d = len(m)
    size = max(1, max(abs(x) for row in m for x in row)).bit_length()
    with localcontext() as context:
        context.prec = 40 + (2 * size + 2 * ROOT_BITS) * 30103 // 100000
        context.Emax, context.Emin = 10 ** 9, -10 ** 9
        e = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(x) for x in row] for row in m], object)
        a[np.diag_indices(d)] -= e
        tiny = Decimal(10) ** (-context.prec // 2)
        order = np.arange(d)
        for i in range(d):
            r = i + int(np.argmax(np.abs(a[i:, i])))
            if r != i:
                a[[i, r]], order[[i, r]] = a[[r, i]], order[[r, i]]
            if a[i, i] == 0:
                a[i, i] = tiny
            a[i + 1:, i] /= a[i, i]
            a[i + 1:, i + 1:] -= a[i + 1:, i:i + 1] * a[i, i + 1:]

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order]
            for i in range(1, d):
                x[i] -= (a[i, :i] * x[:i]).sum()
            for i in range(d - 1, -1, -1):
                if i < d - 1:
                    x[i] -= (a[i, i + 1:] * x[i + 1:]).sum()
                x[i] /= a[i, i]
            return x

        seeds = [[Decimal((i * i * (j + 3) + 7 * i * j + i + j) % 101 + 1) for i in range(d)] for j in range(k)]
        vectors = [np.array(s, object) for s in seeds]
        for _ in range(4):
            done: list[np.ndarray] = []
            for v in vectors:
                v = solve(v)
                v = v / np.abs(v).max()
                for _ in range(2):
                    for u in done:
                        v = v - (u * v).sum() * u
                v = v / (v * v).sum().sqrt()
                done.append(v)
            vectors = done
        return [list(v) for v in vectors]


# -- operator -----------------------------------------------------------------

def scaled(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, y): floor(scale * c) for all rows with a vector of finite entries."""
    r = only(rows, id_col, vector_col).toDF("id", "v").select("id", F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    r = r.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    bound = float(1 << 62)
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(bound)), F.lit(-bound))).cast("bigint"))
    return r.select("id", whole.alias("y"))


def fit(vectors: DataFrame, k: int, offset: int) -> Fit | None:
    """The first ``k`` components of distinct ``vectors`` (y), all of one length."""
    first = vectors.first()
    if first is None:
        return None
    n, sums, products = exact_sums(vectors, len(first["y"]))
    m = [[n * p - a * b for p, b in zip(row, sums)] for row, a in zip(products, sums)]
    trace = sum(m[i][i] for i in range(len(m)))
    roots, found = [], []
    if trace:
        for root, count in largest_roots(characteristic_polynomial(vectors.sparkSession, m), k):
            count = min(count, k - len(roots))
            roots += [root] * count
            found += [[float(x) for x in v] for v in null_vectors(m, root, count)]
    return Fit(n, sums, roots, np.array(found, np.float64).reshape(len(found), len(sums)), trace, offset)


def projector(f: Fit):
    """Function from a matrix of y to their whitened values, one column a component."""
    whole = np.array([s // f.n for s in f.sums], object)
    clip = np.array([max(-(1 << 62), min(1 << 62, int(w))) for w in whole], np.int64)
    rest = np.array([float(Fraction(s, f.n) - int(w)) for s, w in zip(f.sums, whole)], np.float64)
    # over sqrt(e), where e = root / n ** 2
    weights = f.vectors.T * np.array([1 / float(_root(r / f.n ** 2)) for r in f.roots], np.float64)

    def project(y: np.ndarray) -> np.ndarray:
        return ((y - clip).astype(np.float64) - rest) @ weights

    return project


def _root(x: Fraction) -> Fraction:
    """Square root to some 100 bits."""
    shift = max(0, 200 - x.numerator.bit_length() + x.denominator.bit_length())
    shift += shift % 2
    return Fraction(isqrt((x.numerator << shift) // x.denominator), 1 << (shift // 2))


def identity_error(vectors: DataFrame, f: Fit) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity;
    tasks merge means and centred products."""
    k, project = len(f.roots), projector(f)
    if not k:
        return None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if m := batch.num_rows:
                z = project(matrix(batch.column(0)))
                own = z.mean(0)
                z, shift = z - own, own - mean
                products += z.T @ z + np.outer(shift, shift) * (n * m / (n + m))
                mean += shift * (m / (n + m))
                n += m
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array([float(n)] * (k * k), pa.float64()),
                                          pa.array(np.repeat(mean * n, k)), pa.array(np.tile(mean * n, k)),
                                          pa.array((products + n * np.outer(mean, mean)).ravel())], ["at", "n", "a", "b", "p"])

    parts = vectors.select("y").mapInArrow(partial, "at int, n double, a double, b double, p double")
    rows = parts.groupBy("at").agg(*(F.sum(c).alias(c) for c in ("n", "a", "b", "p"))).collect()  # k * k rows
    return max(abs(r["p"] / r["n"] - r["a"] / r["n"] * (r["b"] / r["n"]) - (r["at"] % (k + 1) == 0)) for r in rows)


def whitened(rows: DataFrame, k: int = 16, scale: float = 64.0, offset: int = 1_000_000,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each row
    left and each of at most ``k`` components."""
    ints = scaled(rows, id_col, vector_col, scale)
    distinct = saved(ints.select("y").distinct(), "fit-list")
    lengths = distinct.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    id_type = ints.schema["id"].dataType
    schema = (f"{id_col} {id_type.simpleString()}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    dims = lengths[0]["d"] if lengths else 0
    if len(lengths) > 1:
        distinct = distinct.where(F.size("y") == dims)
    f = fit(distinct, k, offset)
    if f is None or not f.roots:
        return rows.sparkSession.createDataFrame([], schema)
    error, project, found = identity_error(distinct, f), projector(f), len(f.roots)
    explained = [float(r / f.trace) for r in f.roots]
    sums = np.array(f.sums, object)

    def deviations(y: np.ndarray) -> list[int | None]:
        bound = f.n * (int(max(y.max(), -int(y.min()))) + 1) + max(abs(s) for s in f.sums)
        if bound * bound * len(f.sums) < 1 << 63:
            a = y * f.n - sums.astype(np.int64)
            return (a * a).sum(1).tolist()
        exact = ((y.astype(object) * f.n - sums) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]

    def rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_000):
                batch = whole.slice(at, 2_000)
                y = matrix(batch.column(1))
                m = len(y)
                each = np.repeat(np.arange(m), found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(each)).cast(to_arrow_type(id_type)), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * found, f.n, np.int64)), pa.array(deviations(y), pa.int64()).take(pa.array(each)),
                     pa.array(project(y).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * found, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return ints.where(F.size("y") == dims).mapInArrow(rows_out, schema)
