"""Whitening of vectors by components from the exact characteristic polynomial.

Vectors are put on a grid: x = floor(scale * c). The fit list is each distinct x once.
Its scatter n * sum(x x') - S S' is a matrix of whole numbers, added up in tasks without
rounding. Its characteristic polynomial is found modulo many primes, one Hessenberg
reduction each, in tasks, and put together by Chinese remainders. All its roots are
real, so the changes of sign of its coefficients, shifted to a, count the roots above a
exactly: halving isolates the largest ones, whatever lies between them, to far more
digits than a double has. A component is a null vector of scatter - root, by inverse
iteration in decimals of as many digits.

Roots equal to ``DIGITS`` digits are taken as one, and any orthonormal vectors of their
space as its components. What reaches the driver has the size of the dimensions squared.

Rows whose vector is null, is empty, has null or non-finite entries, entries that do not
fit a long on the grid, or another number of dimensions than most vectors have (of
equally many, the larger) are dropped. Repeated and null ids are kept, a row each. A
component of variance 0 (fewer distinct vectors than dimensions) has null ``whitened``
and 0 ``explained``, the latter null if nothing varies at all; ``deviation`` is null
where it exceeds a long. A table without a valid vector gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import isqrt, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from seasonlab.llm.common import stored

DIGITS = 50  # of a root, relative to the largest
LIMB = 20  # bits: products of limbs, added up over a block of rows, are exact in doubles
BLOCK = 1 << 12  # rows multiplied at once
PART = 1 << 40  # sums travel as digits of this base, added up as longs
PRIME_TOP = (1 << 31) - 1


# -- sums over the fit list, in tasks --------------------------------------------------


def on_grid(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """Valid rows with ``_x``, their vector on the grid."""
    least, most = -(2.0**62), 2.0**62
    cell = lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))
    valid = lambda c: F.coalesce((F.lit(float(scale)) * c.cast("double")).between(least, most), F.lit(False))
    v = F.col(f"`{vector}`")
    # a null entry is no double, NaN is above all numbers
    fine = df.where(v.isNotNull() & (F.size(v) > 0)).where(F.forall(v, valid))
    usual = fine.groupBy(F.size(v).alias("_d")).count().orderBy(F.desc("count"), F.desc("_d")).select("_d").head()
    if usual is None:
        return fine.limit(0).withColumn("_x", F.array().cast("array<bigint>"))
    return fine.where(F.size(v) == usual[0]).withColumn("_x", F.transform(v, cell))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal sizes as rows of longs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _digits(value: int) -> list[int]:
    """Digits of base PART, the last one signed."""
    out = []
    while not -PART // 2 <= value < PART // 2:
        out.append(value % PART)
        value //= PART
    return [*out, value]


def _products(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers, exactly: products of limbs in doubles."""
    top = max(int(x.max()), -int(x.min()), 1)
    limbs = []
    while True:
        if top < 1 << LIMB:
            limbs.append(x.astype(np.float64))
            break
        limbs.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x, top = x >> LIMB, (top >> LIMB) + 1
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def scatter_of(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums and sums of products of ``_x``, as whole numbers of any size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            for first in range(0, len(x), BLOCK):
                part = x[first : first + BLOCK]
                n += len(part)
                exact = part if abs(part).max() < 1 << 50 else part.astype(object)
                sums = exact.sum(axis=0).astype(object) + (0 if sums is None else sums)
                products = _products(part) + (0 if products is None else products)
        if not n:
            return
        d = len(sums)
        cells = [(-1, -1, n), *[(i, -1, s) for i, s in enumerate(sums)]]
        cells += [(i, j, products[i, j]) for i in range(d) for j in range(i + 1)]
        rows = [(i, j, k, digit) for i, j, value in cells for k, digit in enumerate(_digits(int(value)))]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)], names=["i", "j", "k", "v"])

    parts = fit.select("_x").mapInArrow(partial, "i long, j long, k long, v long")
    values: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect():
        values[r.i, r.j] = values.get((r.i, r.j), 0) + int(r.v) * PART**r.k
    n = values.get((-1, -1), 0)
    d = sum(j == -1 and i >= 0 for i, j in values)
    sums = [values[i, -1] for i in range(d)]
    scatter = np.zeros((d, d), dtype=object)
    for i in range(d):
        for j in range(i + 1):
            scatter[i, j] = scatter[j, i] = n * values[i, j] - sums[i] * sums[j]
    return n, sums, scatter


# -- characteristic polynomial -----------------------------------------------------------


def _is_prime(m: int) -> bool:
    """Miller and Rabin; these bases decide below 3.4e14."""
    d, s = m - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7, 11, 13, 17):
        x = pow(a, d, m)
        if x not in (1, m - 1) and all((x := x * x % m) != m - 1 for _ in range(s - 1)):
            return False
    return True


def primes_below(top: int, bits: float) -> list[int]:
    """The largest primes up to ``top`` whose product has more than ``bits`` bits."""
    found, have, m = [], 0.0, top | 1
    while have <= bits:
        if _is_prime(m):
            found.append(m)
            have += log2(m) - 1e-9
        m -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo a prime below 2**31, constant first, leading 1."""
    h, d = (matrix % p).astype(np.int64), len(matrix)
    for k in range(d - 2):  # to Hessenberg form, by similar matrices
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    found = np.zeros((d + 1, d + 1), dtype=np.int64)  # of the leading blocks
    found[0, 0] = 1
    for k in range(d):
        own = np.zeros(d + 1, dtype=np.int64)
        own[1:] = found[k, :-1]
        own = (own - h[k, k] * found[k]) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            own = (own - int(h[i, k]) * chain % p * found[i]) % p
        found[k + 1] = own
    return found[d].tolist()


def characteristic_polynomial(spark, scatter: np.ndarray) -> list[int]:
    """Coefficients of det(t - scatter) of a matrix of whole numbers without negative roots,
    constant first. Primes are dealt to tasks; their remainders come back.

    All coefficients together are at most the product of (1 + root), so at most
    (1 + trace / d) ** d.
    """
    d, trace = len(scatter), int(sum(scatter.diagonal()))
    bits = d * ((trace // d + 2).bit_length() + 1) + 2
    primes = primes_below(PRIME_TOP, bits)
    sent = spark.sparkContext.broadcast(scatter)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_modulo(sent.value, p) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, type=pa.int64()), pa.array(found, type=pa.list_(pa.int64()))], names=["p", "c"])

    tasks = max(1, min(len(primes) // 8, spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(reduce, "p long, c array<bigint>").collect()
    total = 1
    for p in primes:
        total *= p
    out = [0] * (d + 1)
    for r in rows:
        others = total // r.p
        unit = others * pow(others % r.p, -1, r.p)
        for k, c in enumerate(r.c):
            out[k] += c * unit
    return [c % total - total if c % total > total // 2 else c % total for c in out]


# -- roots ----------------------------------------------------------------------------------


def roots_above(polynomial: list[int], at: int, shift: int) -> int:
    """Roots above at / 2**shift, repeats counted, of a polynomial with real roots only.

    For such, the changes of sign of the coefficients of p(t + a) are exactly that many.
    """
    c = [v << (shift * (len(polynomial) - 1 - k)) for k, v in enumerate(polynomial)]
    for stop in range(len(c) - 1):
        for k in range(len(c) - 2, stop - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass
class Root:
    """A root in (low, low + 1] / 2**shift, and how many roots lie there."""

    low: int
    shift: int
    times: int

    def decimal(self) -> Decimal:
        with localcontext() as context:
            context.prec = 2 * DIGITS + len(str(self.low))
            return Decimal(2 * self.low + 1) / Decimal(2) ** (self.shift + 1)


def largest_roots(polynomial: list[int], wanted: int) -> list[Root]:
    """The largest roots above 0 of a polynomial with real roots, none below 0, until
    ``wanted`` are found, each to ``DIGITS`` digits of the largest one."""
    d = len(polynomial) - 1
    trace = -polynomial[d - 1]
    positive = roots_above(polynomial, 0, 0)
    if not positive:
        return []
    top = trace.bit_length()  # no root is above the trace
    finest = int(DIGITS * log2(10)) - top

    def refine(low: int, shift: int, times: int, above: int) -> Iterator[Root]:
        """Roots in (low, low + 1] / 2**shift, the largest first; ``above`` lie beyond."""
        while shift < finest:
            if above >= wanted:
                return
            low, shift = 2 * low, shift + 1
            upper = roots_of_half(low + 1, shift) - above
            if upper == times:
                low += 1
            elif upper:
                yield from refine(low + 1, shift, upper, above)
                above, times = above + upper, times - upper
        if above < wanted:
            yield Root(low, shift, times)

    def roots_of_half(at: int, shift: int) -> int:
        if shift >= 0:
            return roots_above(polynomial, at, shift)
        return roots_above(polynomial, at << -shift, 0)

    return list(refine(0, -top, positive, 0))


# -- components ------------------------------------------------------------------------------


def null_vectors(scatter: np.ndarray, root: Decimal, times: int, digits: int) -> list[list[Decimal]]:
    """Orthonormal vectors v with scatter v = root v, by inverse iteration in decimals."""
    d = len(scatter)
    with localcontext() as context:
        context.prec = digits
        size = max(abs(Decimal(int(v))) for v in scatter.ravel()) or Decimal(1)
        tiny = size * Decimal(10) ** -(digits - 5)
        lu = [[Decimal(int(scatter[i, j])) - (root if i == j else 0) for j in range(d)] for i in range(d)]
        rows = list(range(d))
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(lu[i][k]))
            lu[k], lu[best], rows[k], rows[best] = lu[best], lu[k], rows[best], rows[k]
            if abs(lu[k][k]) < tiny:
                lu[k][k] = tiny
            own = lu[k]
            for i in range(k + 1, d):
                if lu[i][k]:
                    f = lu[i][k] / own[k]
                    lu[i] = [*lu[i][:k], f, *[a - f * b for a, b in zip(lu[i][k + 1 :], own[k + 1 :])]]

        def solve(v: list[Decimal]) -> list[Decimal]:
            y = [v[r] for r in rows]
            for i in range(d):
                y[i] -= sum((lu[i][j] * y[j] for j in range(i)), Decimal(0))
            for i in range(d - 1, -1, -1):
                y[i] = (y[i] - sum((lu[i][j] * y[j] for j in range(i + 1, d)), Decimal(0))) / lu[i][i]
            return y

        def unit(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
            for _ in range(2):
                for o in others:
                    along = sum((a * b for a, b in zip(v, o)), Decimal(0))
                    v = [a - along * b for a, b in zip(v, o)]
            length = sum((a * a for a in v), Decimal(0)).sqrt()
            return [a / length for a in v]

        found: list[list[Decimal]] = []
        for k in range(times):
            v = unit([Decimal(1 + (i * (2 * k + 3) + k) % 7) / (1 + (i + k) % 5) for i in range(d)], found)
            for _ in range(3):
                v = unit(solve(v), found)
            found.append(v)
        return found


@dataclass
class Components:
    """What whitening needs: the fit list's size and sums, unit vectors and eigenvalues of x's covariance."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a row each, of variance above 0
    variances: np.ndarray
    explained: list[float | None]


def components_of(spark, n: int, sums: list[int], scatter: np.ndarray, wanted: int) -> Components:
    """The components of largest variance; x's covariance is scatter / n**2."""
    d = len(sums)
    wanted = min(wanted, d)
    trace = int(sum(scatter.diagonal()))
    roots = largest_roots(characteristic_polynomial(spark, scatter), wanted) if trace else []
    vectors, variances, explained = [], [], []
    with localcontext() as context:
        context.prec = 2 * DIGITS + len(str(trace))
        for r in roots:
            value = r.decimal()
            for v in null_vectors(scatter, value, r.times, context.prec)[: wanted - len(vectors)]:
                vectors.append([float(a) for a in v])
                variances.append(float(value / (Decimal(n) * Decimal(n))))
                explained.append(float(value / Decimal(trace)))
    explained += [0.0 if trace else None] * (wanted - len(vectors))
    return Components(n, sums, np.array(vectors).reshape(-1, d), np.array(variances), explained)


def _whitened(x: np.ndarray, c: Components) -> tuple[np.ndarray, np.ndarray]:
    """Whitened values of rows (per component of some variance), and n * x - S as whole numbers."""
    sums = np.array(c.sums, dtype=object)
    top = max(1, int(abs(x).max(initial=0))) * c.n + max((abs(s) for s in c.sums), default=0)
    if top < 1 << 62:
        apart = x * np.int64(c.n) - sums.astype(np.int64)
    else:
        apart = x.astype(object) * c.n - sums
    return (apart / c.n).astype(np.float64) @ c.vectors.T / np.sqrt(c.variances), apart


def _deviations(apart: np.ndarray) -> list[int | None]:
    """Sums of squares of rows, null beyond a long."""
    top = int(abs(apart).max(initial=0)) if apart.dtype != object else max((abs(int(v)) for v in apart.ravel()), default=0)
    if apart.dtype != object and top <= isqrt((1 << 63) // max(1, apart.shape[1])) - 1:
        return (apart * apart).sum(axis=1).tolist()
    sums = (apart.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in sums]


def identity_error(fit: DataFrame, c: Components) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity; null if nothing varies."""
    m = len(c.variances)
    if not m:
        return None

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m, m + 1))
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_matrix(batch.column(0)), c)[0]
                total += np.hstack([w.T @ w, w.sum(axis=0)[:, None]])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    parts = fit.select("_x").mapInArrow(partial, "i long, j long, v double")
    found = np.zeros((m, m + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r.i, r.j] = r.v / c.n
    means = found[:, m]
    return float(abs(found[:, :m] - np.outer(means, means) - np.eye(m)).max())


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """Per valid row of ``df`` and component: the id, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``."""
    spark = df.sparkSession
    rows = on_grid(df, vector, scale).select(F.col(f"`{id}`").alias("_id"), "_x")
    fit = stored(rows.select("_x").distinct(), "whitening-fit")
    n, sums, scatter = scatter_of(fit)
    kind = df.schema[id].dataType
    schema = StructType(
        [StructField(id, kind), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType())]
        + [StructField(name, DoubleType()) for name in ("whitened", "explained", "identity_error")]
    )
    if not n:
        return spark.createDataFrame([], schema)
    c = components_of(spark, n, sums, scatter, components)
    error = identity_error(fit, c)
    m, k = len(c.explained), len(c.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = [f.type for f in to_arrow_schema(schema)]
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.num_rows
            values, apart = _whitened(_matrix(batch.column(1)), c)
            deviations = _deviations(apart)
            white = np.zeros((size, m))
            white[:, :k] = values
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(size), m))),
                pa.array(np.tile(np.arange(1, m + 1), size), type=kinds[1]),
                pa.array(np.full(size * m, c.n), type=kinds[2]),
                pa.array([v for v in deviations for _ in range(m)], type=kinds[3]),
                pa.array(white.ravel(), mask=np.tile(np.arange(m) >= k, size), type=kinds[4]),
                pa.array(c.explained * size, type=kinds[5]),
                pa.array([error] * (size * m), type=kinds[6]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
