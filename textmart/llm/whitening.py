"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter matrix.

Entries become integers, ``x = floor(64 c) + 1000000``; the fit list is each distinct integer vector once. With n vectors of
sums S the matrix ``n * sum(x x') - S S'`` (n * n times the covariance) is summed exactly on the executors. Its
characteristic polynomial is found modulo many primes (Hessenberg reduction, one prime a row of a Spark job) and put
together by Chinese remaindering; a proven bound on the coefficients says how many primes are needed. All roots are real:
the sign changes of the polynomial shifted by ``a`` count the roots above ``a`` exactly, with multiplicity. Intervals are
halved until each holds one root; roots that stay together are known to be equal when their number agrees with the degree of
the polynomial's gcd with its derivative. A root is refined to ``BITS`` binary places and its component found by inverse
iteration in ``DIGITS`` decimal digits.

What reaches the driver is d * d numbers a vector length, whatever the number of rows. Work for d dimensions grows like
d^4 (d^3 a prime, about d primes a 31 bits of the largest eigenvalue).

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, others keep their id, repeated or
null; vectors of each length are a space of their own, with its own fit; eigenvalue zero has no component (it can't be
divided by), so constant vectors, a single distinct vector and vectors of length 0 return no rows; a space of lower rank
returns as many components as its rank; entries beyond 4e18 / 64 count as that; an empty table returns no rows; a
``deviation`` beyond 38 digits is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmart.session import cut_lineage

COMPONENTS = 16
SCALE, SHIFT, EDGE = 64, 1_000_000, 4e18
#: Binary places of a root, decimal digits of the inverse iteration.
BITS, DIGITS = 256, 140
LIMB, ROWS = 20, 4096  # products of two limbs over so many rows are exact in double precision


# ---- exact sums ------------------------------------------------------------------------------------------------------

def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, y)``: the integer entries less ``SHIFT`` (a shift changes neither deviations nor the scatter)."""
    c = F.col(vector_col).cast("array<double>")
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    y = F.transform(c, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(EDGE)), F.lit(-EDGE))).cast("long"))
    return vectors.filter(F.col(vector_col).isNotNull()).filter(~bad).select(F.col(id_col).alias("id"), y.alias("y")).filter("size(y) > 0")


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer matrix) of at most ``ROWS`` rows for each vector length in the batch; the vectors are column ``y``."""
    col = batch.column(batch.schema.get_field_index("y"))
    ends = np.asarray(col.offsets)
    values, sizes = np.asarray(col.values), np.diff(ends)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        for at in range(0, len(rows), ROWS):
            some = rows[at:at + ROWS]
            yield some, values[ends[some][:, None] + np.arange(d)]


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed integers as doubles ``l0 + l1 * 2^LIMB + ...``, as many as the largest entry needs."""
    parts = []
    while True:
        if -(1 << LIMB) < y.min() and y.max() < (1 << LIMB):
            return [*parts, y.astype(np.float64)]
        parts.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB


def scatter(fit_list: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For every vector length n, the sums S and ``n * sum(y y') - S S'`` as Python integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, y in by_length(batch):
                d, parts = y.shape[1], limbs(y)
                one = np.ones((len(y), 1))
                for a, left in enumerate([one, *parts]):  # row d of a total holds the sums and n
                    for b, right in enumerate([one, *parts]):
                        key = (d, LIMB * (max(a - 1, 0) + max(b - 1, 0)))
                        total = sums.setdefault(key, np.zeros((d + 1, d + 1), object))
                        rows = slice(d, None) if a == 0 else slice(0, d)
                        cols = slice(d, None) if b == 0 else slice(0, d)
                        total[rows, cols] += (left.T @ right).astype(np.int64)
        for (d, shift), total in sums.items():
            i, j = np.triu_indices(d + 1)
            full = lambda v: pa.array(np.full(len(i), v, np.int32))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([full(d), full(shift), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))], names=["d", "shift", "i", "j", "v"])

    parts = fit_list.select("y").mapInArrow(run, "d int, shift int, i int, j int, v decimal(38,0)")
    found: dict[int, np.ndarray] = {}
    for d, shift, i, j, v in parts.groupBy("d", "shift", "i", "j").agg(F.sum("v")).collect():  # d * d numbers a length
        m = found.setdefault(d, np.zeros((d + 1, d + 1), object))
        m[i, j] += int(v) << shift
        m[j, i] = m[i, j]
    return {d: (m[d, d], m[:d, d], m[d, d] * m[:d, :d] - np.outer(m[:d, d], m[:d, d])) for d, m in sorted(found.items())}


# ---- characteristic polynomial ---------------------------------------------------------------------------------------

def is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7):  # these bases decide every n below 3215031751
        x = pow(a, odd, n)
        if a % n and x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return n > 1


def primes_for(bound: int) -> list[int]:
    """Primes below 2^31, largest first, whose product exceeds ``bound``."""
    found, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of ``det(t I - matrix)`` modulo ``p`` by reduction to Hessenberg form."""
    h, d = matrix.copy(), len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        at = k + 1 + below[0]
        h[[k + 1, at]] = h[[at, k + 1]]
        h[:, [k + 1, at]] = h[:, [at, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, d + 1):
        c, t = np.zeros(m, np.int64), 1
        for i in range(m - 1, -1, -1):
            c[i] = t * int(h[i, m - 1]) % p
            t = t * int(h[i, i - 1]) % p if i else 0
        polys[m, 1:] = polys[m - 1, :-1]
        polys[m] = (polys[m] - (c[:, None] * polys[:m] % p).sum(0)) % p
    return polys[d]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Integers of smallest absolute value with the given residues (prime, values)."""
    product, values = 1, [0] * len(residues[0][1])
    for p, r in residues:
        inverse = pow(product, -1, p)
        values = [v + product * ((x - v) * inverse % p) for v, x in zip(values, r, strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients, constant first, for a positive semidefinite integer matrix; the primes are dealt to tasks."""
    d, trace = len(matrix), int(np.trace(matrix))
    mean = -(-trace // d)  # the k-th elementary symmetric function of the eigenvalues is at most C(d, k) mean^k
    primes = primes_for(2 * max(comb(d, k) * mean ** k for k in range(d + 1)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                found = polynomial_mod((matrix % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([found], pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    return remaindered([(r.p, r.c) for r in dealt.mapInArrow(run, "p long, c array<long>").collect()])


# ---- roots -----------------------------------------------------------------------------------------------------------

def scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are ``2^bits`` times as large."""
    d = len(poly) - 1
    return [c << bits * (d - k) for k, c in enumerate(poly)]


def roots_above(poly: list[int], a: int) -> int:
    """Roots greater than ``a``, with multiplicity, of a polynomial whose roots are all real: sign changes after a shift."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def gcd_degree(poly: list[int]) -> int:
    """Degree of the gcd of the polynomial and its derivative (the roots beyond the distinct ones); modulo a prime the degree
    is never too small, and too large only for the primes that divide a certain integer, so the least of three is taken."""
    def trimmed(f):
        while f and not f[-1]:
            f.pop()
        return f

    def at(p):
        f, g = [c % p for c in poly], trimmed([k * c % p for k, c in enumerate(poly)][1:])
        while g:
            inverse = pow(g[-1], -1, p)
            while len(f) >= len(g):
                q, at = f[-1] * inverse % p, len(f) - len(g)
                for k, c in enumerate(g):
                    f[at + k] = (f[at + k] - q * c) % p
                trimmed(f)
                if not f:
                    break
            f, g = g, f
        return len(f) - 1

    return min(at(p) for p in primes_for(1 << 90))


def isolated(poly: list[int]) -> tuple[int, list[tuple[int, int, int, int]]]:
    """(bits, intervals from the largest root on); an interval is (low, high, roots in it, roots above it), low < root <= high,
    in units of ``2^-bits``, and holds one distinct root. ``poly`` has positive real roots."""
    repeated, bits = gcd_degree(poly), 0
    top = 1 << max(abs(poly[-2]).bit_length(), 1)  # the sum of the roots
    while True:
        p, todo, done = scaled(poly, bits), [(0, top << bits, len(poly) - 1, 0)], []
        while todo:
            low, high, n, above = todo.pop()
            if n == 1 or (n and high - low == 1):
                done.append((low, high, n, above))
            elif n:
                mid = (low + high) // 2
                k = roots_above(p, mid) - above
                todo += [(low, mid, n - k, above + k), (mid, high, k, above)]  # the upper half is taken first
        if sum(n - 1 for _, _, n, _ in done) == repeated:
            return bits, done
        bits = bits * 2 or 64


def refined(poly: list[int], interval: tuple[int, int, int, int], bits: int) -> int:
    """The root in the interval, in units of ``2^-BITS`` and rounded down."""
    (low, high, n, above), extra = interval, max(BITS - bits, 0)
    p = scaled(poly, bits + extra)
    low, high = low << extra, high << extra
    while high - low > 1:
        mid = (low + high) // 2
        if n > 1:
            upper = roots_above(p, mid) > above
        else:  # a monic polynomial is positive where an even number of its roots is greater
            v = 0
            for c in reversed(p):
                v = v * mid + c
            upper = v != 0 and (v > 0) != (above % 2 == 0)
        low, high = (mid, high) if upper else (low, mid)
    return low >> max(bits - BITS, 0)


def null_space(matrix: np.ndarray, root: int, n: int) -> list[list[Decimal]]:
    """``n`` orthonormal vectors that the matrix takes to ``root / 2^BITS`` times themselves, by inverse iteration."""
    d, found = len(matrix), []
    with localcontext() as ctx:
        ctx.prec = DIGITS
        for off in range(1, 5):  # a shift that is itself an eigenvalue gives a zero pivot
            a = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
            a[np.arange(d), np.arange(d)] -= Decimal(root - off) / Decimal(1 << BITS)
            order = np.arange(d)
            for k in range(d):
                at = k + int(np.argmax(np.abs(a[k:, k])))
                a[[k, at]], order[[k, at]] = a[[at, k]], order[[at, k]]
                if not a[k, k]:
                    break
                if k + 1 < d:
                    a[k + 1:, k] /= a[k, k]
                    a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
            else:
                break

        def solved(b: np.ndarray) -> np.ndarray:
            b = b[order].copy()
            for k in range(1, d):
                b[k] -= a[k, :k].dot(b[:k])
            for k in range(d - 1, -1, -1):
                b[k] = (b[k] - (a[k, k + 1:].dot(b[k + 1:]) if k + 1 < d else 0)) / a[k, k]
            return b

        seed = 1
        for _ in range(n):
            start = []
            for _ in range(d):
                seed = seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
                start.append(Decimal(seed >> 40) - (1 << 23))
            v = np.array(start, object)
            for _ in range(3):
                v = solved(v)
                for _ in range(2):
                    for u in found:
                        v = v - u * u.dot(v)
                    v = v / v.dot(v).sqrt()
            found.append(v if v[int(np.argmax(np.abs(v)))] > 0 else -v)
    return [list(v) for v in found]


# ---- fit and whitening -----------------------------------------------------------------------------------------------

@dataclass
class Space:
    """The fit of one vector length: n vectors with sums S (less ``SHIFT``), components as rows, largest eigenvalue first."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    roots: np.ndarray      # square roots of the eigenvalues of the covariance
    explained: np.ndarray
    identity_error: float = 0.0

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """``n * y - S``, as 64-bit integers where they fit and as Python integers beyond."""
        most = max(abs(int(y.min())), abs(int(y.max()))) * self.n + max(abs(int(s)) for s in self.sums)
        return y * self.n - self.sums.astype(np.int64) if most < 1 << 62 else y.astype(object) * self.n - self.sums

    def squares(self, deviations: np.ndarray) -> list[int]:
        if deviations.dtype != object and max(-int(deviations.min()), int(deviations.max())) ** 2 * deviations.shape[1] < 1 << 62:
            return (deviations * deviations).sum(1).tolist()
        return [sum(int(v) ** 2 for v in row) for row in deviations]

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ self.components.T / self.roots


def solve(spark: SparkSession, n: int, sums: np.ndarray, matrix: np.ndarray, components: int) -> Space | None:
    """Largest eigenvalues and their components; the roots are dealt to tasks, where they are refined."""
    trace = int(np.trace(matrix))
    if not trace:
        return None
    poly = characteristic_polynomial(spark, matrix)
    while not poly[0]:
        poly = poly[1:]  # eigenvalue zero
    bits, intervals = isolated(poly)
    wanted, seen = [], 0
    for interval in intervals:
        if seen < components:
            wanted.append((len(wanted), *map(str, interval)))
            seen += interval[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, *interval in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                interval = tuple(map(int, interval))
                root = refined(poly, interval, bits)
                vectors = [[float(x) for x in v] for v in null_space(matrix, root, interval[2])]
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([str(root)]), pa.array([vectors], pa.list_(pa.list_(pa.float64())))], names=["k", "root", "vectors"])

    dealt = spark.createDataFrame(wanted, "k long, low string, high string, n string, above string").repartition(len(wanted))
    rows = sorted(dealt.mapInArrow(run, "k long, root string, vectors array<array<double>>").collect())
    with localcontext() as ctx:
        ctx.prec = DIGITS
        values = [(Decimal(int(r.root)) / Decimal(1 << BITS), v) for r in rows for v in r.vectors][:components]
        return Space(n, sums, np.array([v for _, v in values]), np.array([float(e.sqrt() / n) for e, _ in values]),
                     np.array([float(e / trace) for e, _ in values]))


def identity_errors(fit_list: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Largest absolute entry of the whitened fit list's covariance less the identity: means first, then centred products."""
    def summed(means: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for _, y in by_length(batch):
                    if (s := spaces.get(y.shape[1])) is not None:
                        w = s.whitened(s.deviations(y))
                        part = w.sum(0, keepdims=True) if means is None else (w - means[y.shape[1]]).T @ (w - means[y.shape[1]])
                        sums[y.shape[1]] = sums.get(y.shape[1], 0.0) + part
            for d, total in sums.items():
                i, j = (x.ravel().astype(np.int32) for x in np.indices(total.shape))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i), pa.array(j), pa.array(total.ravel())], names=["d", "i", "j", "v"])

        found: dict[int, np.ndarray] = {}
        rows = fit_list.select("y").mapInArrow(run, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v"))
        for d, i, j, v in rows.collect():  # at most COMPONENTS * COMPONENTS numbers a length
            k = len(spaces[d].roots)
            found.setdefault(d, np.zeros((1 if means is None else k, k)))[i, j] = v / spaces[d].n
        return found

    if not spaces:
        return {}
    return {d: float(np.abs(c - np.eye(len(c))).max()) for d, c in summed({d: m[0] for d, m in summed(None).items()}).items()}


def fit(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Space]:
    """The space of every vector length that has a positive eigenvalue. Copies are joined before the shuffle."""
    fit_list = cut_lineage(quantised(vectors, id_col=id_col, vector_col=vector_col).select("y").distinct())
    spark, spaces = vectors.sparkSession, {}
    for d, (n, sums, matrix) in scatter(fit_list).items():
        if (space := solve(spark, n, sums, matrix, components)) is not None:
            spaces[d] = space
    for d, error in identity_errors(fit_list, spaces).items():
        spaces[d].identity_error = error
    return spaces


def whiten(vectors: DataFrame, spaces: dict[int, Space], *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(<id_col>, component, n, deviation decimal(38,0), whitened, explained, identity_error)``, a row per vector and component."""
    rows = quantised(vectors, id_col=id_col, vector_col=vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, y in by_length(batch):
                if (s := spaces.get(y.shape[1])) is None:
                    continue
                z, k = s.deviations(y), len(s.roots)
                squares = [Decimal(v) if v < 10 ** 38 else None for v in s.squares(z)]
                each = np.repeat(np.arange(len(at)), k)
                full = lambda v: pa.array(np.tile(v, len(at)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at[each])), full(np.arange(1, k + 1, dtype=np.int32)), full(np.full(k, s.n, np.int64)),
                     pa.array(squares, pa.decimal128(38, 0)).take(pa.array(each)), pa.array(s.whitened(z).ravel()), full(s.explained),
                     full(np.full(k, s.identity_error))], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
