"""Whitening of vectors on the exact principal components of their integer form.

Every entry c becomes the long floor(SCALE * c) + SHIFT. The scatter matrix n * sum(x x') - S S'
is then a matrix of integers, n * n times the covariance. Its characteristic polynomial is found
exactly: the matrix is brought to Hessenberg form modulo many primes (Spark deals the primes out),
and the coefficients are joined by Chinese remaindering; their bound says how many primes are
needed. All roots are real, so sign changes of the shifted polynomial count the roots above a
point exactly, and bisection isolates the largest ones to ``BITS`` bits. Inverse iteration in
fixed-point integers gives the vector of the null space of M - root for each; vectors of roots that
coincide are made orthogonal to each other.

Sums over rows are taken in tasks as products of limbs that float64 holds exactly, and are added up
by Spark as longs. What reaches the driver is dims * dims numbers, whatever the number of rows.

Rows take part if their vector is not null, holds no null or non-finite entry, has the most
frequent length (of equally frequent ones the longest), and fits: |floor(SCALE * c)| < 2**52.
Rows that repeat count as often as they occur; a NULL id is kept. Components whose variance is 0
cannot be whitened and are left out, so equal rows, one row or an empty table give no rows.
"""

from __future__ import annotations

from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map
from tidemark.session import materialize

SCALE, SHIFT = 1024, 100_000
KEEP = 8
BITS = 160  # of a root, relative to the largest
LIMB = 20  # bits of a limb: products of two, summed over CHUNK rows, stay below 2**53
CHUNK = 4096
PRIMES_PER_TASK = 4


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of long) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("c"))
    rows = rows.where("c is not null and forall(c, v -> v is not null and not isnan(v) and abs(v) < double('inf'))")
    rows = rows.where(f"forall(c, v -> abs(v) < {2.0**52 / SCALE!r}D)")
    lengths = rows.groupBy(F.size("c").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1)
    dims = next((r.dims for r in lengths.collect()), 0)
    whole = F.expr(f"transform(c, v -> floor({SCALE} * v) + {SHIFT}L)").alias("x")
    return materialize(rows.where(F.size("c") == dims).select("vec_id", whole))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype("int64", copy=False).reshape(len(column), dims)


def _limbs(values: np.ndarray) -> list[np.ndarray]:
    """``values`` = sum of limb i << (LIMB * i); all limbs but the last lie in [0, 2**LIMB)."""
    out = []
    while True:
        if len(values) == 0 or np.abs(values).max() < 1 << LIMB:
            return [*out, values.astype("float64")]
        out.append((values & ((1 << LIMB) - 1)).astype("float64"))
        values = values >> LIMB


def moments(x: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S, and the scatter n * sum(x x') - S S', exactly."""
    centre = x.select([F.avg(F.col("x")[j]) for j in range(dims)]).first()
    if centre[0] is None:
        return 0, [0] * dims, [[0] * dims for _ in range(dims)]
    near = np.array([round(c) for c in centre], "int64")

    def run(batches):
        # Per power of 2**LIMB, the sum so far; a limb's product over CHUNK rows is below 2**53.
        first, total, count = {}, {}, 0
        for batch in batches:
            rows = _matrix(batch.column(0), dims) - near
            count += len(rows)
            for begin in range(0, len(rows), CHUNK):
                limbs = _limbs(rows[begin : begin + CHUNK])
                for i, a in enumerate(limbs):
                    first[i] = first.get(i, 0) + a.sum(0).astype("int64").astype(object)
                    for j, b in enumerate(limbs):
                        total[i + j] = total.get(i + j, 0) + (a.T @ b).astype("int64").astype(object)
        size = dims + dims * dims
        whole = np.zeros(size + 1, object)
        whole[size] = count
        for power, value in first.items():
            whole[:dims] += value * (1 << (LIMB * power))
        for power, value in total.items():
            whole[dims:size] += value.reshape(-1) * (1 << (LIMB * power))
        # Each sum as digits of 40 bits, which Spark can add up as longs; the last carries the sign.
        for power in range(6):
            digit = whole & ((1 << 40) - 1) if power < 5 else whole
            at = np.flatnonzero(digit)
            whole = whole >> 40
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype("int32")), pa.array(np.full(len(at), power, "int32")), pa.array([int(v) for v in digit[at]], pa.int64())],
                    names=["cell", "power", "value"],
                )

    parts = x.select("x").mapInArrow(run, "cell int, power int, value long")
    sums = [0] * (dims + dims * dims + 1)
    for cell, power, value in parts.groupBy("cell", "power").agg(F.sum("value")).collect():
        sums[cell] += value << (40 * power)
    n, d = sums[-1], sums[:dims]
    scatter = [[n * sums[dims + i * dims + j] - d[i] * d[j] for j in range(dims)] for i in range(dims)]
    return n, [d[j] + n * int(near[j]) for j in range(dims)], scatter


def _is_prime(n: int) -> bool:
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):  # decisive below 3,215,031,751
        if n % a == 0:
            return n == a
        v = pow(a, d, n)
        if v in (1, n - 1):
            continue
        for _ in range(s - 1):
            v = v * v % n
            if v == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes from below 2**31 downwards whose product has more than ``bits`` bits."""
    out, p, have = [], (1 << 31) - 1, 0.0
    while have <= bits + 1:
        if _is_prime(p):
            out.append(p)
            have += np.log2(p)
        p -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t - matrix) modulo the prime ``p``, constant first."""
    h = matrix % p
    d = len(h)
    for k in range(d - 2):
        at = np.flatnonzero(h[k + 1 :, k])
        if not len(at):
            continue
        pivot = k + 1 + at[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(1)) % p
    # Polynomials of the leading blocks, each from those before it.
    polys = np.zeros((d + 1, d + 1), "int64")
    polys[0, 0] = 1
    for k in range(1, d + 1):
        row = np.roll(polys[k - 1], 1) - h[k - 1, k - 1] * polys[k - 1] % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            row = row - (below * int(h[i - 1, k - 1]) % p) * polys[i - 1] % p
        polys[k] = row % p
    return polys[d]


def polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), constant first, exactly."""
    d = len(matrix)
    # Coefficients are at most those of the product of (t + length of a row).
    lengths = sum(np.log2(2.0) + 0.5 * _log2(1 + sum(v * v for v in row)) for row in matrix)
    moduli = primes(int(lengths) + 2)

    def run(batch: pa.RecordBatch):
        for p in batch.column(0).to_pylist():
            own = np.array([[v % p for v in row] for row in matrix], "int64").reshape(d, d)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int64()), pa.array([polynomial_mod(own, p).tolist()], pa.list_(pa.int64()))],
                names=["p", "c"],
            )

    tasks = max(1, len(moduli) // PRIMES_PER_TASK)
    dealt = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    found = {r.p: r.c for r in arrow_map(dealt, "p long, c array<long>", run).collect()}
    whole, product = [0] * (d + 1), 1
    for p in moduli:
        inverse = pow(product, -1, p)
        whole = [a + product * ((c - a) * inverse % p) for a, c in zip(whole, found[p], strict=True)]
        product *= p
    return [c - product if 2 * c > product else c for c in whole]


def _log2(value: int) -> float:
    shift = max(0, value.bit_length() - 60)
    return float(np.log2(float(value >> shift)) + shift)


def _above(poly: list[int], num: int, bits: int) -> int:
    """How many roots lie above num / 2**bits: sign changes of the polynomial shifted there."""
    d = len(poly) - 1
    c = [v << (bits * (d - i)) for i, v in enumerate(poly)]
    if num:
        for i in range(d):
            for j in range(d - 1, i - 1, -1):
                c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def roots(poly: list[int], keep: int, bits: int = BITS) -> list[Fraction]:
    """The ``keep`` largest positive roots, repeated ones repeatedly, to ``bits`` bits of the largest."""
    d = len(poly) - 1
    zeros = next(i for i, v in enumerate(poly) if v)
    poly = poly[zeros:]
    keep = min(keep, d - zeros)
    high = 1
    while keep and _above(poly, high, 0):
        high *= 2
    size = high.bit_length()
    shift = max(0, bits - size)  # roots are found as multiples of 2**-shift
    out = []
    for rank in range(1, keep + 1):
        lo, hi, scale = 0, high, 0
        # Halve the interval (lo, hi] / 2**scale until it is as narrow as asked for.
        while hi - lo > 1 or scale < shift:
            if hi - lo == 1:
                lo, hi, scale = 2 * lo, 2 * hi, scale + 1
            mid = (lo + hi) // 2
            if _above(poly, mid, scale) >= rank:
                lo = mid
            else:
                hi = mid
        out.append(Fraction(lo + hi, 2 << scale))
    return out


def null_vectors(matrix: list[list[int]], values: list[Fraction], bits: int = 2 * BITS) -> list[list[Fraction]]:
    """A unit vector of each value, by inverse iteration in fixed point."""
    d, one = len(matrix), 1 << bits
    size = max(1, max(abs(v) for row in matrix for v in row))
    near = Fraction(1, 1 << (BITS // 2))
    out: list[tuple[Fraction, np.ndarray]] = []
    rng = np.random.default_rng(0)
    for value in values:
        a = np.array([[(v << bits) // size for v in row] for row in matrix], object).reshape(d, d)
        for i in range(d):
            a[i, i] -= value.numerator * one // (value.denominator * size)
        alike = [w for v, w in out if abs(v - value) <= near * values[0]]
        order, steps = list(range(d)), []
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            a[[k, pivot]] = a[[pivot, k]]
            steps.append(pivot)
            if a[k, k] == 0:
                a[k, k] = 1  # exactly singular: the least step away from it
            f = np.array([v * one // a[k, k] for v in a[k + 1 :, k]], object)
            a[k + 1 :, k:] -= (f[:, None] * a[k, k:]) >> bits
            a[k + 1 :, k] = f
        v = np.array([int(x) << (bits - 20) for x in rng.integers(1 << 18, 1 << 20, len(order))], object)
        for _ in range(4):
            for k, pivot in enumerate(steps):
                v[[k, pivot]] = v[[pivot, k]]
                v[k + 1 :] -= (a[k + 1 :, k] * v[k]) >> bits
            for k in range(d - 1, -1, -1):
                v[k] = (v[k] - (int((a[k, k + 1 :] * v[k + 1 :]).sum()) >> bits)) * one // a[k, k]
                if abs(v[k]).bit_length() > 4 * bits:
                    v = v >> (2 * bits)
            v = _unit(v, bits)
            for w in alike:
                v = _unit(v - ((w * int((v * w).sum() >> bits)) >> bits), bits)
        out.append((value, v))
    return [[Fraction(int(x), one) for x in v] for _, v in out]


def _unit(v: np.ndarray, bits: int) -> np.ndarray:
    length = isqrt(int((v * v).sum()))
    return np.array([int(x) * (1 << bits) // length for x in v], object) if length else v


def components(spark, n: int, scatter: list[list[int]], keep: int = KEEP) -> list[tuple[Fraction, list[Fraction]]]:
    """(root of the scatter matrix, unit vector) of the first components whose variance is not 0."""
    if n == 0 or not any(any(row) for row in scatter):
        return []
    values = [v for v in roots(polynomial(spark, scatter), keep) if v > 0]
    return list(zip(values, null_vectors(scatter, values), strict=True))


def whiten(vectors: DataFrame, keep: int = KEEP) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is NULL where it takes more than 64 bits.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    x = integers(vectors)
    dims = next((len(r.x) for r in x.limit(1).collect()), 0)
    n, sums, scatter = moments(x, dims) if dims else (0, [], [])
    found = components(spark, n, scatter, keep)
    trace = sum(scatter[i][i] for i in range(dims))
    # x - S/n = (n x - S) / n and e = root / n**2, so whitened = (n x - S) . v / sqrt(root).
    axes = np.array([[float(c) for c in v] for _, v in found], "float64").reshape(len(found), dims).T
    scale = np.array([_root(value) for value, _ in found], "float64")
    total = [int(s) for s in sums]

    def run(batch: pa.RecordBatch):
        rows = _matrix(batch.column(1), dims)
        small = n * int(np.abs(rows).max(initial=0)) + max(map(abs, total)) < 1 << 62
        apart = rows * n - np.array(total) if small else rows.astype(object) * n - np.array(total, object)
        if small and int(np.abs(apart).max(initial=0)) ** 2 * dims < 1 << 62:
            far = (apart * apart).sum(1).tolist()
        else:
            far = [int(v) for v in (apart.astype(object) ** 2).sum(1)]
        far = [v if v < 1 << 63 else None for v in far]
        out = (apart.astype("float64") @ axes) / scale
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(far, pa.int64()), pa.array(list(out), pa.list_(pa.float64()))],
            names=["vec_id", "deviation", "w"],
        )

    if not found:
        x = x.limit(0)
    rows = materialize(arrow_map(x, f"vec_id {kind}, deviation long, w array<double>", run))
    error = _identity_error(rows, len(found))
    share = F.array(*[F.lit(float(value / trace)) for value, _ in found]) if found else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _root(value: Fraction) -> float:
    """Square root, to double precision."""
    shift = 2 * max(0, 60 + (value.denominator.bit_length() - value.numerator.bit_length()) // 2 + 1)
    return float(Fraction(isqrt((value.numerator << shift) // value.denominator), 1 << (shift // 2)))


def _identity_error(rows: DataFrame, count: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    if not count:
        return None
    mean = rows.select([F.avg(F.col("w")[i]) for i in range(count)]).first()
    off = [F.col("w")[i] - F.lit(mean[i]) for i in range(count)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = rows.select([F.avg(off[i] * off[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))
