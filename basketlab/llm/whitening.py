"""Whitening of embeddings with eigenvalues from the exact characteristic polynomial.

Entries become integers, so the scatter matrix M = n * sum(x x') - S S' is exact: blocks of
rows are multiplied in limbs that doubles hold exactly, and partial sums are added in integers
over a tree of tasks. V, the covariance, is M / n^2.

1. The characteristic polynomial of M is computed modulo many primes, each in a Spark task:
   reduction to Hessenberg form, then its recurrence. Chinese remaindering gives the integer
   coefficients; as M is positive semidefinite they alternate in sign and are bounded by the
   trace, which tells how many primes are enough.
2. All roots are real, so by Descartes' rule the sign changes of the polynomial shifted by a
   are exactly the number of roots above a. Bisection in integers on a grid of 2^-256 of the
   trace isolates every root wanted, Newton steps between exact signs finish it. Roots that
   share a grid cell count as one root of that multiplicity.
3. For each root, in Spark tasks, inverse iteration on M - root with 120 digits gives the
   null space, orthonormal where a root is multiple.

The matrix, the residues and the components are bounded by the dimension alone (one partial
matrix per task goes through the tree), never by the number of rows.

Defined cases: rows whose vector is null or empty, or holds null or a value that is not finite, are dropped;
their ids may be null or repeated, and each repeated row is a row. Vectors of different
lengths, or entries of 2^40 and more, raise an error. No rows give no rows. A component without
variance has ``whitened`` null and ``explained`` 0 (null if no component has any), and is left
out of ``identity_error``. A deviation beyond the range of long is null. Other columns are not read.
"""

from __future__ import annotations

import decimal
from decimal import Decimal
from itertools import accumulate
from math import comb, gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.operators.staging import stage

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = 1 << 46
BLOCK_ROWS = 4096
ROOT_BITS = 256
DIGITS = 120
SOLVES = 3
_LIMB = 20


# Exact sums ------------------------------------------------------------------


def _matrices(column: pa.Array):
    """(row numbers, doubles) for the vectors of each length in an Arrow list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        yield rows, values[offsets[rows][:, None] + np.arange(size)]


def _integers(vectors: np.ndarray) -> np.ndarray:
    """Entries scaled and rounded down, before the shift that all of them share."""
    found = np.floor(SCALE * vectors)
    if np.abs(found).max(initial=0) >= LARGEST:
        raise ValueError("an entry of a vector is too large")
    return found.astype(np.int64)


def scatter(y: np.ndarray) -> np.ndarray:
    """y'y of a block of integers, exact, as Python integers."""
    half, mask = 1 << (_LIMB - 1), (1 << _LIMB) - 1
    limbs, rest = [], y
    while rest.any():
        low = ((rest + half) & mask) - half
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> _LIMB
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            # 2^38 for a product of limbs times 2^12 rows: below 2^53, exact in doubles.
            total += (left.T @ right).astype(np.int64).astype(object) * (1 << _LIMB * (a + b))
    return total


def _split(values: np.ndarray) -> bytes:
    """Python integers as three limbs of 31 bits, the last one signed."""
    mask = (1 << 31) - 1
    limbs = [values & mask, (values >> 31) & mask, values >> 62]
    return np.array(limbs).astype("<i8").tobytes()


def _joined(payload: bytes) -> np.ndarray:
    low, middle, high = np.frombuffer(payload, "<i8").reshape(3, -1).astype(object)
    return low + (middle << 31) + (high << 62)


def _exact_parts(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, vectors in _matrices(batch.column(0)):
            size = vectors.shape[1]
            upper = np.triu_indices(size)
            for start in range(0, len(vectors), BLOCK_ROWS):
                y = _integers(vectors[start:start + BLOCK_ROWS])
                found = np.concatenate([[len(y)], y.sum(axis=0).astype(object), scatter(y)[upper]])
                sums[size] = sums[size] + found if size in sums else found
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(list(map(_split, sums.values())), pa.binary())], names=["size", "payload"])


def _add(kind: str):
    """Adds payloads of one size: exact integers or doubles."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _joined(payload.as_py()) if kind == "exact" else np.frombuffer(payload.as_py(), "<f8")
                sums[size] = sums[size] + found if size in sums else found
        if sums:
            packed = [_split(v) if kind == "exact" else v.tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["size", "payload"])

    return run


def _tree_sum(partials: DataFrame, kind: str, name: str) -> list:
    """(size, payload) summed per size, through about as many tasks as the square root of their number."""
    kept = stage(partials, name)
    groups = isqrt(kept.count()) + 1
    layer = kept.repartition(groups).mapInArrow(_add(kind), kept.schema)
    return layer.repartition(1).mapInArrow(_add(kind), kept.schema).collect()


# Characteristic polynomial ---------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers of 32 bits."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, from the largest down, with a product above ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo p, from the highest power down."""
    h = (matrix % p).astype(np.int64)
    size = len(h)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[pivot, k + 1]] = h[[k + 1, pivot]]
            h[:, [pivot, k + 1]] = h[:, [k + 1, pivot]]
        factors = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factors % p).sum(axis=1)) % p
    # Row k: the polynomial of the leading k by k block, from the lowest power up.
    rows = np.zeros((size + 1, size + 1), np.int64)
    rows[0, 0] = 1
    for k in range(size):
        weights = np.zeros(k, np.int64)
        product = 1
        for i in range(k - 1, -1, -1):
            product = product * int(h[i + 1, i]) % p
            weights[i] = product * int(h[i, k]) % p
        rows[k + 1, 1:] = rows[k, :-1]
        rows[k + 1] -= rows[k] * h[k, k] % p
        rows[k + 1] -= (weights[:, None] * rows[:k] % p).sum(axis=0)
        rows[k + 1] %= p
    return rows[size, ::-1]


def _residues(matrix: np.ndarray):
    def run(batches):
        for batch in batches:
            found = [polynomial_mod(matrix, p).tolist() for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["prime", "residues"])

    return run


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The numbers from 0 up to the product of the primes with these residues."""
    product = 1
    for p in residues:
        product *= p
    units = {p: (product // p) * pow(product // p, -1, p) for p in residues}
    return [sum(u * r[k] for u, r in zip(units.values(), residues.values())) % product for k in range(len(next(iter(residues.values()))))]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients of det(x - matrix) for a positive semidefinite integer matrix, highest power first."""
    size, trace = len(matrix), int(matrix.trace())
    # The k-th elementary symmetric function of roots with this sum is largest when all are equal.
    bound = max(comb(size, k) * (-(-trace // size)) ** k for k in range(size + 1))
    primes = spark.createDataFrame([(p,) for p in primes_beyond(bound)], "prime long")
    slots = max(1, min(primes.count(), spark.sparkContext.defaultParallelism))
    rows = primes.repartition(slots).mapInArrow(_residues(matrix), "prime long, residues array<bigint>").collect()
    signed = {r["prime"]: [(-c if k % 2 else c) % r["prime"] for k, c in enumerate(r["residues"])] for r in rows}
    return [-c if k % 2 else c for k, c in enumerate(remaindered(signed))]


# Roots -----------------------------------------------------------------------


def roots_above(coefficients: list[int], a: int) -> int:
    """Number of roots above a > 0 of a polynomial with real roots only, each as often as it counts."""
    power, shifted = 1, []
    for c in reversed(coefficients):
        shifted.append(c * power)
        power *= a
    shifted.reverse()
    for stop in range(len(shifted), 1, -1):
        shifted[:stop] = accumulate(shifted[:stop])
    signs = [c > 0 for c in shifted if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(coefficients: list[int], x: int) -> tuple[int, int]:
    value = slope = 0
    for c in coefficients:
        slope = slope * x + value
        value = value * x + c
    return value, slope


def _refined(coefficients: list[int], low: int, high: int) -> int:
    """The grid point at or just above the only root in (low, high], a simple one."""
    top = _value(coefficients, high)[0]
    if top == 0:
        return high
    x, turn = (low + high) // 2, 0
    while high - low > 1:
        turn += 1
        value, slope = _value(coefficients, x)
        if value == 0:
            return x
        if (value > 0) == (top > 0):
            high = x
        else:
            low = x
        middle = (low + high) // 2
        new = x - value // slope if slope and turn % 4 else middle
        if abs(new - x) <= 2:
            # Newton has arrived: close the other side as well, if the signs there allow it.
            for y in (x - 3, x + 3):
                if low < y < high:
                    side = _value(coefficients, y)[0]
                    if side == 0:
                        return y
                    low, high = (low, y) if (side > 0) == (top > 0) else (y, high)
            middle = new = (low + high) // 2
        x = new if low < new < high else middle
    return high


def largest_roots(coefficients: list[int], wanted: int, bits: int = ROOT_BITS) -> tuple[list[tuple[int, int]], int]:
    """The positive roots by falling size, as (numerator, multiplicity) over 2^scale, and scale.

    ``coefficients`` are those of a positive semidefinite matrix. The last root may reach beyond
    ``wanted`` roots where it is multiple.
    """
    while coefficients and coefficients[-1] == 0:
        coefficients = coefficients[:-1]
    if len(coefficients) <= 1:
        return [], 0
    trace = -coefficients[1]
    scale = max(0, bits - trace.bit_length())
    grid = [c << scale * k for k, c in enumerate(coefficients)]
    found: list[tuple[int, int]] = []
    # Intervals (low, high] with the number of roots above each end; the largest one is on top.
    open_ones = [(0, len(grid) - 1, (trace << scale) + 1, 0)]
    while open_ones and sum(m for _, m in found) < wanted:
        low, above_low, high, above_high = open_ones.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1:
            found.append((_refined(grid, low, high), 1))
        elif high - low == 1:
            found.append((high, inside))
        else:
            middle = (low + high) // 2
            above = roots_above(grid, middle)
            open_ones += [(low, above_low, middle, above), (middle, above, high, above_high)]
    return found, scale


# Components ------------------------------------------------------------------


def _factored(matrix: np.ndarray, least: Decimal) -> tuple[np.ndarray, list[int]]:
    """LU of a matrix of decimals with row exchanges; a vanishing pivot becomes ``least``."""
    lu, order = matrix.copy(), []
    for k in range(len(lu)):
        pivot = max(range(k, len(lu)), key=lambda i: abs(lu[i, k]))
        order.append(pivot)
        if pivot != k:
            lu[[k, pivot]] = lu[[pivot, k]]
        if abs(lu[k, k]) < least:
            lu[k, k] = least
        lu[k + 1:, k] /= lu[k, k]
        lu[k + 1:, k + 1:] -= np.multiply.outer(lu[k + 1:, k], lu[k, k + 1:])
    return lu, order


def _solved(lu: np.ndarray, order: list[int], right: np.ndarray) -> np.ndarray:
    x = right.copy()
    for k, pivot in enumerate(order):
        x[[k, pivot]] = x[[pivot, k]]
        x[k + 1:] -= lu[k + 1:, k] * x[k]
    for k in range(len(lu) - 1, -1, -1):
        x[k] /= lu[k, k]
        x[:k] -= lu[:k, k] * x[k]
    return x


def null_vectors(matrix: np.ndarray, numerator: int, scale: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors that the matrix only stretches, by the root numerator / 2^scale."""
    with decimal.localcontext() as context:
        context.prec = DIGITS
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        size = len(matrix)
        root = Decimal(numerator) / (Decimal(2) ** scale)
        shifted = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        for i in range(size):
            shifted[i, i] -= root
        lu, order = _factored(shifted, (root + 1) * Decimal(10) ** (10 - DIGITS))
        draw = np.random.default_rng(numerator % (1 << 63))
        found = [np.array([Decimal(int(v)) for v in draw.integers(1, 1 << 40, size)], object) for _ in range(count)]
        for _ in range(SOLVES):
            for j in range(count):
                v = _solved(lu, order, found[j])
                v /= max(map(abs, v))
                for _ in range(2):
                    for other in found[:j]:
                        v = v - other * (v * other).sum()
                found[j] = v / (v * v).sum().sqrt()
        rows = []
        for v in found:
            lead = max(v, key=abs)
            rows.append([float(e if lead > 0 else -e) for e in v])
        return rows


def _components(matrix: np.ndarray, scale: int):
    def run(batches):
        for batch in batches:
            for first, numerator, count in zip(*(c.to_pylist() for c in batch.columns)):
                vectors = null_vectors(matrix, int(numerator), scale, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, first + count), pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], names=["component", "vector"])

    return run


def components_of(spark: SparkSession, matrix: np.ndarray, wanted: int) -> list[tuple[float, float, list[float]]]:
    """(root, share of the trace, unit vector) for up to ``wanted`` positive roots of the matrix, by falling root."""
    trace = int(matrix.trace())
    if not trace:
        return []
    factor = gcd(*map(int, matrix.ravel()))
    reduced = matrix // factor
    roots, scale = largest_roots(characteristic_polynomial(spark, reduced), wanted)
    firsts = accumulate([0, *(m for _, m in roots)])
    jobs = spark.createDataFrame([(f, str(y), m) for f, (y, m) in zip(firsts, roots)], "first int, numerator string, count int")
    slots = max(1, min(len(roots), spark.sparkContext.defaultParallelism))
    rows = jobs.repartition(slots).mapInArrow(_components(reduced, scale), "component int, vector array<double>").collect()
    vectors = {r["component"]: r["vector"] for r in rows}
    every = [y for y, m in roots for _ in range(m)][:wanted]
    with decimal.localcontext() as context:
        context.prec = DIGITS
        exact = [Decimal(y) * factor / (Decimal(2) ** scale) for y in every]
        return [(float(e), float(e / trace), vectors[k]) for k, e in enumerate(exact)]


# Whitened rows ---------------------------------------------------------------


class Basis:
    """What every task needs: the number of rows, the sums and the components."""

    def __init__(self, n: int, sums: np.ndarray, found: list[tuple[float, float, list[float]]], wanted: int):
        self.n, self.sums, self.wanted = n, sums, wanted
        self.roots = np.array([r for r, _, _ in found])
        self.shares = [s for _, s, _ in found]
        self.vectors = np.array([v for _, _, v in found]).reshape(len(found), len(sums)).T

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        """n * x - S, exact; the shift cancels."""
        y = _integers(vectors)
        largest = int(np.abs(y).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if largest < 1 << 62:
            return self.n * y - self.sums.astype(np.int64)
        return self.n * y.astype(object) - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        # n * sqrt(e) is the square root of the scatter's root.
        return centred.astype(np.float64) @ self.vectors / np.sqrt(self.roots)

    @staticmethod
    def deviations(centred: np.ndarray) -> list[int | None]:
        largest = max(map(abs, (centred.min(initial=0), centred.max(initial=0))))
        if centred.shape[1] * int(largest) ** 2 < 1 << 63:
            return (centred * centred).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in (centred.astype(object) ** 2).sum(axis=1).tolist()]


def _moments(basis: Basis):
    def run(batches):
        total = None
        for batch in batches:
            for _, vectors in _matrices(batch.column(0)):
                for start in range(0, len(vectors), BLOCK_ROWS):
                    w = basis.whitened(basis.centred(vectors[start:start + BLOCK_ROWS]))
                    total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([len(total)], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["size", "payload"])

    return run


def _rows(basis: Basis, identity_error: float):
    """Each row once per component."""
    k, wanted, whole = len(basis.roots), basis.wanted, bool(len(basis.roots))

    def run(batches):
        for batch in batches:
            for rows, vectors in _matrices(batch.column(1)):
                for start in range(0, len(vectors), BLOCK_ROWS):
                    some = rows[start:start + BLOCK_ROWS]
                    centred = basis.centred(vectors[start:start + BLOCK_ROWS])
                    whitened = np.zeros((len(some), wanted))
                    whitened[:, :k] = basis.whitened(centred)
                    missing = np.tile(np.arange(wanted) >= k, len(some))
                    shares = [*basis.shares, *([0.0 if whole else None] * (wanted - k))]
                    count = len(some) * wanted
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(np.repeat(some, wanted))),
                        pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), len(some))),
                        pa.array(np.full(count, basis.n, np.int64)),
                        pa.array(basis.deviations(centred), pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), wanted))),
                        pa.array(whitened.ravel(), mask=missing), pa.array(shares * len(some), pa.float64()),
                        pa.array(np.full(count, identity_error)),
                    ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    values = F.col(vector).cast("array<double>")
    given = vectors.select(F.col(vec_id).alias("vec_id"), values.alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = given.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    id_type = given.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    sums = _tree_sum(rows.select("vector").mapInArrow(_exact_parts, "size int, payload binary"), "exact", "scatter")
    if not sums:
        return spark.createDataFrame([], schema)
    if len(sums) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(r['size'] for r in sums)}")
    size, total = sums[0]["size"], _joined(sums[0]["payload"])
    n, s = int(total[0]), total[1:size + 1]
    matrix = np.zeros((size, size), object)
    matrix[np.triu_indices(size)] = total[size + 1:]
    matrix = n * (matrix + np.triu(matrix, 1).T) - np.multiply.outer(s, s)

    wanted = min(components, size)
    basis = Basis(n, s, components_of(spark, matrix, wanted), wanted)
    error = 0.0
    if len(basis.roots):
        moments = _tree_sum(rows.select("vector").mapInArrow(_moments(basis), "size int, payload binary"), "double", "whitened_moments")
        product = np.frombuffer(moments[0]["payload"], "<f8").reshape(len(basis.roots), -1) / n
        error = float(np.abs(product - np.eye(len(product))).max())
    return rows.mapInArrow(_rows(basis, error), schema)


def query(spark, folder: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
