"""Whitening of integer vectors by the exact characteristic polynomial of their scatter.

1. Tasks add up whole-number scatter matrices of their vectors; Spark adds those of all tasks.
   Nothing is rounded, whatever the number of vectors.
2. The characteristic polynomial of the centred scatter is found modulo many primes, by
   reduction to Hessenberg form, and put together by Chinese remainders. Tasks take a range
   of primes each.
3. All roots are real, so sign changes of the shifted polynomial count the roots above a
   number exactly. The largest roots are isolated that way and halved down to ``_BITS`` bits.
   A task takes a root each.
4. Components are null vectors of scatter - root, by inverse iteration in fixed-point numbers
   of far more digits than a double; a root of several is given as many orthogonal ones.

What reaches the driver are d * d numbers, d being the length of a vector.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITENED = (
    "component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)
SCALE, SHIFT = 1024, 100_000
_LIMIT = 1 << 62  # beyond this, scaled entries are cut off: they must be longs
_BITS = 160  # digits of a root
_SAME = 100  # roots that agree in so many digits are one
_FIXED = 384  # binary places in the inverse iteration
_PRIMES_PER_TASK = 1024  # length of the range below 2^31 whose primes a task takes


# -- scatter ---------------------------------------------------------------------------


def scaled(vectors: pa.Array, d: int) -> np.ndarray:
    """floor(1024 * c) of every entry; x without its shift, which no covariance sees."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        y = np.clip(np.floor(flat * SCALE), -_LIMIT, _LIMIT)
    return y.astype(np.int64).reshape(-1, d)


def products(y: np.ndarray) -> np.ndarray:
    """Exact y^T y as Python integers; matrix products of doubles that cannot round."""
    most = int(np.abs(y).max(initial=0))
    width = 20 if most >= 1 << 22 else max(1, most.bit_length())
    limbs, left = [], y
    for _ in range(max(1, -(-(most.bit_length() + 1) // width))):
        if most.bit_length() <= width:
            limbs, left = [y], None
            break
        limbs.append(left & ((1 << width) - 1))
        left = left >> width
    if left is not None:
        limbs.append(left)
    step = 1 << (52 - 2 * width)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    floats = [limb.astype(np.float64) for limb in limbs]
    for a in range(0, len(y), step):
        for i, u in enumerate(floats):
            for j, v in enumerate(floats):
                part = (u[a : a + step].T @ v[a : a + step]).astype(np.int64).astype(object)
                total = total + part * (1 << (width * (i + j)))
    return total


_LIMB = (1 << 40) - 1


def _scatter(d: int):
    """Per task: every cell of the scatter, every sum, and the number of vectors, in limbs."""
    upper = np.triu_indices(d)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sums, n = np.zeros((d, d), object), np.zeros(d, object), 0
        for batch in batches:
            y = scaled(batch.column(0), d)
            for a in range(0, len(y), 1 << 16):
                part = y[a : a + (1 << 16)]
                cells = cells + products(part)
                low, high = part & _LIMB, part >> 40
                sums = sums + low.sum(axis=0).astype(object)
                sums = sums + high.sum(axis=0).astype(object) * (1 << 40)
            n += len(y)
        if n:
            values = [*cells[upper].tolist(), *sums.tolist(), n]
            limbs = [[v & _LIMB, (v >> 40) & _LIMB, v >> 80] for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()),
                 *(pa.array([x[i] for x in limbs], pa.int64()) for i in range(3))],
                ["cell", "low", "middle", "high"],
            )

    return scatter


def scatter_of(vectors: DataFrame, column: str, d: int):
    """(n, sums, n * sum of products - sums * sums) in whole numbers; n is 0 without rows."""
    parts = vectors.select(column).mapInArrow(
        _scatter(d), "cell int, low long, middle long, high long"
    )
    whole = parts.groupBy("cell").agg(
        *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "middle", "high"))
    )
    values = {
        cell: int(low) + (int(middle) << 40) + (int(high) << 80)
        for cell, low, middle, high in whole.collect()
    }
    size = d * (d + 1) // 2
    n = values.get(size + d, 0)
    if not n:
        return 0, [], None
    sums = [values[size + i] for i in range(d)]
    cells = np.zeros((d, d), object)
    for cell, (i, j) in enumerate(zip(*np.triu_indices(d), strict=True)):
        cells[i, j] = cells[j, i] = n * values[cell] - sums[i] * sums[j]
    return n, sums, cells


# -- characteristic polynomial ---------------------------------------------------------


def primes_in(low: int, high: int) -> list[int]:
    """Primes of a range, by sieving it."""
    small = np.ones(math.isqrt(high) + 1, bool)
    small[:2] = False
    for p in range(2, math.isqrt(len(small)) + 1):
        if small[p]:
            small[p * p :: p] = False
    left = np.ones(high - low, bool)
    for p in np.flatnonzero(small).tolist():
        left[max(p * p, -(-low // p) * p) - low :: p] = False
    return (np.flatnonzero(left) + low).tolist()


def polynomials_modulo(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime, a row per prime, x^d first."""
    d = len(matrix)
    h = np.array([[[int(v) % p for v in row] for row in matrix] for p in primes], np.int64)
    h = h.reshape(len(primes), d, d)
    p = np.array(primes, np.int64)[:, None, None]
    every = np.arange(len(primes))
    for k in range(d - 2):
        # Row k + 1 gets the first entry of column k that is not zero; likewise its column.
        pivot = k + 1 + np.argmax(h[:, k + 1 :, k] != 0, axis=1)
        rows = h[every, pivot].copy()
        h[every, pivot], h[:, k + 1] = h[:, k + 1].copy(), rows
        columns = h[every, :, pivot].copy()
        h[every, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), columns
        inverse = [
            pow(a, -1, q) if a else 0 for a, q in zip(h[:, k + 1, k].tolist(), primes, strict=True)
        ]
        u = h[:, k + 2 :, k] * np.array(inverse, np.int64)[:, None] % p[:, 0]
        h[:, k + 2 :] = (h[:, k + 2 :] - u[:, :, None] * h[:, None, k + 1]) % p
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * u[:, None] % p).sum(axis=2)) % p[:, 0]
    # polys[k] is the polynomial of the leading k by k part, constant first.
    polys = np.zeros((d + 1, len(primes), d + 1), np.int64)
    polys[0, :, 0] = 1
    q = p[:, :, 0]
    for k in range(1, d + 1):
        polys[k, :, 1:] = polys[k - 1, :, :-1]
        polys[k] = (polys[k] - h[:, k - 1, k - 1, None] * polys[k - 1]) % q
        product = np.ones((len(primes), 1), np.int64)
        for i in range(k - 1, 0, -1):
            product = product * h[:, i, i - 1, None] % q
            polys[k] = (polys[k] - (product * h[:, i - 1, k - 1, None] % q) * polys[i - 1]) % q
    return polys[d][:, ::-1]


def _coefficient_bits(matrix: np.ndarray) -> int:
    """Bits that hold any coefficient: the roots are not negative and add up to the trace."""
    d, trace = len(matrix), int(np.trace(matrix))
    mean = Fraction(trace, d) + 1
    return max(
        (math.comb(d, k) * math.ceil(mean) ** k).bit_length() for k in range(d + 1)
    ) + 2


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - matrix), x^d first, of a matrix without negative roots."""
    bits = _coefficient_bits(matrix)
    # Among numbers near 2^31 about one in 22 is prime.
    tasks = 1 + bits * 26 // (30 * _PRIMES_PER_TASK)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                high = (1 << 31) - task * _PRIMES_PER_TASK
                primes = primes_in(high - _PRIMES_PER_TASK, high)
                found = polynomials_modulo(matrix, primes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(primes, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                    ["prime", "residues"],
                )

    rows = (
        spark.range(tasks, numPartitions=min(tasks, 1000))
        .mapInArrow(residues, "prime long, residues array<long>")
        .collect()
    )
    modulus = math.prod(row["prime"] for row in rows)
    assert modulus.bit_length() > bits, "too few primes"
    total = [0] * (len(matrix) + 1)
    for row in rows:
        rest = modulus // row["prime"]
        share = rest * pow(rest, -1, row["prime"])
        total = [t + share * r for t, r in zip(total, row["residues"], strict=True)]
    half = modulus >> 1
    return [(t + half) % modulus - half for t in total]


# -- roots -----------------------------------------------------------------------------


def roots_above(polynomial: list[int], a: int) -> int:
    """How many roots are larger than ``a``: sign changes of p(x + a), all roots being real."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for j in range(1, len(c) - i):
            c[j] += a * c[j - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def root(polynomial: list[int], which: int) -> Fraction | None:
    """The ``which``-th largest root to ``_BITS`` digits, from below; None if it is not positive.

    Bounds are whole numbers over a power of two; the power grows until the root has digits.
    """
    if roots_above(polynomial, 0) < which:
        return None
    places = 0
    scaled_to = list(polynomial)
    low, high = 0, 1 << (-polynomial[1]).bit_length()  # the sum of all roots bounds each
    single = False
    while True:
        while high - low > 1 and low.bit_length() <= _BITS:
            middle = (low + high) // 2
            if single:
                # One simple root in between: the sign at the middle tells the side.
                value = 0
                for c in scaled_to:
                    value = value * middle + c
                above = (value > 0) != positive_high
            else:
                here = roots_above(scaled_to, middle)
                above = here >= which
            if above:
                low = middle
            else:
                high = middle
            if not single and low:
                n_low, n_high = roots_above(scaled_to, low), roots_above(scaled_to, high)
                if n_low - n_high == 1 and n_low == which:
                    value = 0
                    for c in scaled_to:
                        value = value * high + c
                    if value:
                        single, positive_high = True, value > 0
        if low.bit_length() > _BITS:
            return Fraction(low, 1 << places)
        places += 64
        low, high = low << 64, high << 64
        scaled_to = [c << (64 * k) for k, c in enumerate(scaled_to)]


# -- components ------------------------------------------------------------------------


def null_vectors(matrix: np.ndarray, value: Fraction, many: int) -> np.ndarray:
    """``many`` orthonormal vectors v with (matrix - value) v = 0 as nearly as doubles can."""
    d = len(matrix)
    scale = 1 << max(1, max(abs(int(v)) for v in matrix.ravel()).bit_length())
    a = np.empty((d, d), object)
    for i in range(d):
        for j in range(d):
            a[i, j] = (int(matrix[i, j]) << _FIXED) // scale
        a[i, i] -= int(value * (1 << _FIXED) / scale)
    order = np.arange(d)
    for k in range(d):
        best = k + int(np.argmax(np.abs(a[k:, k])))
        a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            f = (a[k + 1 :, k] << _FIXED) // a[k, k]
            a[k + 1 :, k] = f
            a[k + 1 :, k + 1 :] -= (f[:, None] * a[None, k, k + 1 :]) >> _FIXED

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for k in range(d):
            x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> _FIXED
        for k in range(d - 1, -1, -1):
            x[k] = (int(x[k]) << _FIXED) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> _FIXED
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        most = max(abs(int(v)) for v in x)
        x = np.array([(int(v) << _FIXED) // most for v in x], object)
        length = math.isqrt(sum(int(v) * int(v) for v in x))
        return np.array([(int(v) << _FIXED) // length for v in x], object)

    def apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for v in others:
            x = x - ((v * (int((x * v).sum()) >> _FIXED)) >> _FIXED)
        return x

    pick = random.Random(7)
    found: list[np.ndarray] = []
    for _ in range(many):
        x = unit(np.array([pick.getrandbits(64) - (1 << 63) for _ in range(d)], object))
        for _ in range(3):
            x = unit(apart(unit(solve(apart(x, found))), found))
        found.append(x)
    out = np.array([[float(Fraction(int(v), 1 << _FIXED)) for v in x] for x in found])
    signs = np.sign(out[np.arange(many), np.argmax(np.abs(out), axis=1)])
    return out * signs[:, None]


def principal_components(
    spark: SparkSession, matrix: np.ndarray, most: int
) -> list[tuple[Fraction, np.ndarray]]:
    """(root, unit vector) of the largest positive roots, falling, at most ``most`` of them."""
    divisor = math.gcd(*(int(v) for v in matrix.ravel()))
    if not divisor:
        return []
    matrix = matrix // divisor
    polynomial = characteristic_polynomial(spark, matrix)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which = batch.column(0).to_pylist()
            values = [root(polynomial, k + 1) for k in which]
            texts = [None if v is None else f"{v.numerator}/{v.denominator}" for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int64()), pa.array(texts, pa.string())], ["which", "root"]
            )

    count = min(most, len(matrix))
    rows = spark.range(count, numPartitions=count).mapInArrow(find, "which long, root string")
    by_rank = {r["which"]: Fraction(r["root"]) for r in rows.collect() if r["root"]}
    roots = [by_rank[k] for k in sorted(by_rank)]
    groups: list[list[Fraction]] = []
    for value in roots:
        if groups and (groups[-1][0] - value) * (1 << _SAME) < groups[-1][0]:
            groups[-1].append(value)
        else:
            groups.append([value])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which = batch.column(0).to_pylist()
            found = [null_vectors(matrix, groups[g][0], len(groups[g])) for g in which]
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int64()),
                 pa.array([v.ravel().tolist() for v in found], pa.list_(pa.float64()))],
                ["which", "entries"],
            )

    if not groups:
        return []
    rows = spark.range(len(groups), numPartitions=len(groups)).mapInArrow(
        vectors, "which long, entries array<double>"
    )
    entries = {r["which"]: np.array(r["entries"]) for r in rows.collect()}
    return [
        (value * divisor, vector)
        for g, values in enumerate(groups)
        for value, vector in zip(values, entries[g].reshape(len(values), -1), strict=True)
    ]


# -- whitened vectors ------------------------------------------------------------------


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n * x - S)^2 of each row; NULL where it is no long."""
    reach = n * int(np.abs(y).max(initial=0)) + max(abs(s) for s in sums)
    if reach * reach * y.shape[1] < 1 << 63:
        apart = n * y - np.array(sums, np.int64)
        return pa.array((apart * apart).sum(axis=1))
    apart = y.astype(object) * n - np.array(sums, object)
    exact = (apart * apart).sum(axis=1)
    return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())


def whiten(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    most: int = 8,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries are dropped, and so
    are vectors of another length than the most frequent one (the larger on a tie). Entries
    times 1024 are cut off at 2^62. Ids may be NULL or repeated: every row counts and comes
    back. Only components with a variance above 0 are there, so equal vectors, a single one
    or none give no rows. ``deviation`` is NULL where it exceeds a long. Other columns are
    not looked at.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector")
    )
    odd = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where((F.size("vector") > 0) & ~odd)
    lengths = rows.groupBy(F.size("vector").alias("d")).count()
    longest = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {WHITENED}"
    if longest is None:
        return spark.createDataFrame([], schema)
    d = longest["d"]
    rows = rows.where(F.size("vector") == d)
    n, sums, matrix = scatter_of(rows, "vector", d)
    found = principal_components(spark, matrix, most)
    if not found:
        return spark.createDataFrame([], schema)
    trace = int(np.trace(matrix))
    explained = [float(value / trace) for value, _ in found]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    # The matrix is n * n times the covariance.
    axes = np.stack([v / math.sqrt(value / (n * n)) for value, v in found], axis=1)
    k = len(found)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = (scaled(batch.column(0), d) - mean) @ axes
            total, square = total + w.sum(axis=0), square + w.T @ w
        values = np.concatenate((total, square.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array(values)], ["cell", "value"]
        )

    cells = rows.select("vector").mapInArrow(spread, "cell int, value double")
    values = dict(cells.groupBy("cell").agg(F.sum("value")).collect())
    means = np.array([values[i] for i in range(k)]) / n
    square = np.array([values[k + i] for i in range(k * k)]).reshape(k, k) / n
    identity_error = float(np.abs(square - np.outer(means, means) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = scaled(batch.column(1), d)
            w = (y - mean) @ axes
            repeat = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(repeat),
                 pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                 pa.array(np.full(len(y) * k, n)), _deviations(y, n, sums).take(repeat),
                 pa.array(w.ravel()), pa.array(np.tile(explained, len(y))),
                 pa.array(np.full(len(y) * k, identity_error))],
                [c.split()[0] for c in schema.split(", ")],
            )

    return rows.select("vec_id", "vector").mapInArrow(project, schema)
