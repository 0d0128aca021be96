"""Whitening of embeddings by an exact characteristic polynomial.

Entries become integers, so the scatter matrix of the distinct vectors is exact:
tasks multiply blocks in double precision only as far as whole numbers are
exact there. The scatter's characteristic polynomial is computed modulo many
primes, each by reduction to Hessenberg form, a task for a batch of primes, and
put together by Chinese remainders. All its roots are real, so the sign changes
of a shifted polynomial count the roots above a point exactly; the largest are
isolated and bisected on a grid of 2**-64. Components are null vectors found by
inverse iteration at these roots. What passes through the driver is a model: its
size depends on the vectors' length alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import settle
from .columns import free_name

#: An entry c is the integer floor(SCALE * c); offsets don't change a covariance.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond are taken as this bound.
LARGEST = float(1 << 50)
#: Components that are computed, and primes that a task reduces together.
COMPONENTS, PRIMES_A_TASK = 16, 16
#: Bits of a limb, and rows of a block: products of a block's limbs add up to
#: less than 2**53.
_LIMB, _BLOCK = 17, 1 << 16
#: Roots are on a grid of 2**-_GRID.
_GRID = 64


@dataclass(frozen=True)
class Model:
    """Whitening of vectors of one length: ``rows`` distinct vectors with the
    sums ``sums``, unit ``components`` as columns, their eigenvalues and the
    share of the trace."""

    rows: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def whole_entries(vector: Column) -> Column:
    """The vector's integers, or null where the vector or an entry is null or
    not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c) < float("inf")))
    entries = F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(
        F.lit(LARGEST), c * SCALE))).cast("long"))
    return F.when(finite, entries)


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer matrix for each length in a batch of vectors."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten())
    first = np.concatenate(([0], np.cumsum(lengths)))
    for d in np.unique(lengths):
        which = np.flatnonzero(lengths == d)
        yield which, flat[first[which][:, None] + np.arange(d)].reshape(len(which), int(d))


class _Scatter:
    """Exact sums and products of the integer vectors of one length."""

    def __init__(self, d: int):
        self.rows, self.sums = 0, [0] * d
        #: By power of 2**_LIMB: products as high and low part.
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.d = d

    def add(self, y: np.ndarray) -> None:
        for at in range(0, len(y), _BLOCK):
            block = y[at:at + _BLOCK]
            self.rows += len(block)
            for i, s in enumerate(block.sum(axis=0).tolist()):
                self.sums[i] += s
            limbs, rest = [], block
            while True:
                if np.abs(rest).max(initial=0) < 1 << _LIMB:
                    limbs.append(rest.astype(np.float64))
                    break
                limbs.append((rest & ((1 << _LIMB) - 1)).astype(np.float64))
                rest = rest >> _LIMB
            for i, a in enumerate(limbs):
                for j, b in enumerate(limbs):
                    product = (a.T @ b).astype(np.int64)
                    high, low = self.parts.setdefault(
                        i + j, tuple(np.zeros((self.d, self.d), np.int64) for _ in range(2)))
                    high += product >> 32
                    low += product & 0xFFFFFFFF

    def products(self, row: int) -> list[int]:
        """Products of entry ``row`` with the entries up to it."""
        out = [0] * (row + 1)
        for power, (high, low) in self.parts.items():
            for j, (h, b) in enumerate(zip(high[row, :row + 1].tolist(),
                                           low[row, :row + 1].tolist(), strict=True)):
                out[j] += ((h << 32) + b) << (_LIMB * power)
        return out


def _scatter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, _Scatter] = {}
    for batch in batches:
        for _, y in _matrices(batch.column(0)):
            held.setdefault(y.shape[1], _Scatter(y.shape[1])).add(y)
    for d, found in held.items():
        yield pa.RecordBatch.from_pydict({
            "length": pa.array([d] * d, pa.int32()), "entry": pa.array(range(d), pa.int32()),
            "rows": pa.array([found.rows] * d, pa.int64()),
            "sum": pa.array([str(s) for s in found.sums], pa.string()),
            "products": pa.array([[str(p) for p in found.products(i)] for i in range(d)],
                                 pa.list_(pa.string()))})


_SCATTER = "length int, entry int, rows bigint, sum string, products array<string>"


def _summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One entry's partial sums, a row for each task that had vectors."""
    total = None
    for products in table.column("products").to_pylist():
        numbers = [int(p) for p in products]
        total = numbers if total is None else [a + b for a, b in zip(total, numbers, strict=True)]
    return pa.table({
        "length": pa.array([key[0].as_py()], pa.int32()),
        "entry": pa.array([key[1].as_py()], pa.int32()),
        "rows": pa.array([sum(table.column("rows").to_pylist())], pa.int64()),
        "sum": pa.array([str(sum(int(s) for s in table.column("sum").to_pylist()))]),
        "products": pa.array([[str(t) for t in total]])})


def scatter(fit: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """For each length of the distinct integer vectors ``fit``: their number n,
    their sums S, and n times the sum of the products less the product of the
    sums, which is n squared times the covariance. A vector's length rows of
    numbers come to the driver, whatever the number of vectors."""
    found: dict[int, dict[int, tuple]] = {}
    for r in fit.mapInArrow(_scatter_rows, _SCATTER).groupBy("length", "entry").applyInArrow(
            _summed, _SCATTER).collect():
        found.setdefault(r["length"], {})[r["entry"]] = (r["rows"], int(r["sum"]), r["products"])
    out = {}
    for d, rows in found.items():
        n, sums = rows[0][0], [rows[i][1] for i in range(d)]
        a = np.zeros((d, d), object)
        for i in range(d):
            for j, p in enumerate(rows[i][2]):
                a[i, j] = a[j, i] = n * int(p) - sums[i] * sums[j]
        out[d] = (n, sums, a)
    return out


# characteristic polynomial

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 2**32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_over(bits: int) -> list[int]:
    """The largest 31-bit primes whose product has more than ``bits`` bits."""
    out, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Modular inverses (0 of 0) by Fermat, all primes at once."""
    out, power, left = np.ones_like(x), x.copy(), p - 2
    while left.any():
        out = np.where(left & 1, out * power % p, out)
        power, left = power * power % p, left >> 1
    return out


def _hessenberg(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Reduce each matrix h[k] modulo p[k] to Hessenberg form, in place."""
    many, d = h.shape[:2]
    every, q = np.arange(many), p[:, None]
    for k in range(d - 2):
        # A pivot that isn't zero, moved to the row and column below k.
        pivot = k + 1 + np.argmax(h[:, k + 1:, k] != 0, axis=1)
        rows = h[every, pivot].copy()
        h[every, pivot], h[:, k + 1] = h[:, k + 1].copy(), rows
        columns = h[every, :, pivot].copy()
        h[every, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), columns
        factor = h[:, k + 2:, k] * _inverse(h[:, k + 1, k], p)[:, None] % q
        h[:, k + 2:] = (h[:, k + 2:] - factor[:, :, None] * h[:, None, k + 1] % q[:, :, None]) \
            % q[:, :, None]
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2:] * factor[:, None, :]
                                            % q[:, :, None]).sum(axis=2)) % q
    return h


def polynomials(matrices: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients of det(x - matrices[k]) modulo primes[k], constant first."""
    h, p = _hessenberg(matrices % primes[:, None, None], primes), primes[:, None]
    many, d = h.shape[:2]
    # By columns of the Hessenberg form: each leading minor from those before.
    minors = [np.zeros((many, d + 1), np.int64)]
    minors[0][:, 0] = 1
    for k in range(d):
        now = np.zeros_like(minors[0])
        now[:, 1:] = minors[k][:, :-1]
        now = (now - h[:, k, k, None] * minors[k]) % p
        below = np.ones(many, np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % primes
            now = (now - (h[:, i, k] * below % primes)[:, None] * minors[i]) % p
        minors.append(now)
    return minors[d]


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Coefficients of det(x - a), constant first, of a symmetric integer matrix
    without negative eigenvalues."""
    d = len(a)
    # By the inequality of means, no coefficient exceeds (1 + trace / d) ** d.
    mean = 1 + -(-int(np.trace(a)) // d)
    primes = primes_over(d * mean.bit_length() + 2)
    tasks = -(-len(primes) // PRIMES_A_TASK)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                some = np.array(primes[at * PRIMES_A_TASK:(at + 1) * PRIMES_A_TASK], np.int64)
                each = np.stack([(a % int(p)).astype(np.int64) for p in some])
                found = polynomials(each, some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(found.tolist(), pa.list_(pa.int64()))],
                    ["prime", "coefficients"])

    rows = spark.range(0, tasks, 1, tasks).mapInArrow(
        reduced, "prime bigint, coefficients array<bigint>").collect()
    modulus = 1
    for p in primes:
        modulus *= p
    out = [0] * (d + 1)
    for r in rows:
        others = modulus // r["prime"]
        unit = others * pow(others, -1, r["prime"])
        for k, c in enumerate(r["coefficients"]):
            out[k] += c * unit
    out = [c % modulus for c in out]
    return [c - modulus if 2 * c > modulus else c for c in out]


# roots

def roots_above(polynomial: list[int], point: int) -> int:
    """Roots greater than ``point``, with multiplicity, of a polynomial that has
    real roots only: the sign changes of the polynomial shifted there."""
    c = polynomial[::-1]
    d = len(c) - 1
    for last in range(d, 0, -1):
        for i in range(1, last + 1):
            c[i] += point * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(polynomial: list[int], point: int) -> int:
    out = 0
    for c in reversed(polynomial):
        out = out * point + c
    return out


def largest_roots(polynomial: list[int], most: int) -> list[tuple[int, int]]:
    """The largest positive roots, falling, as (root times 2**_GRID, roots that
    can't be told apart from it), up to ``most`` roots with multiplicity."""
    zeros = next(i for i, c in enumerate(polynomial) if c)
    rest = polynomial[zeros:]
    d = len(rest) - 1
    if not d:
        return []
    scaled = [c << (_GRID * (d - i)) for i, c in enumerate(rest)]
    top = 1 << (-scaled[d - 1]).bit_length()      # the sum of the roots
    wanted = min(most, d)
    # Intervals (low, high] and the roots above either end, the largest first.
    open_, found, have = [(0, top, d, 0)], [], 0
    while open_ and have < wanted:
        low, high, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1 or high - low <= max(1, high >> 60):
            found.append((_bisected(scaled, low, high) if inside == 1 else high, inside))
            have += inside
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        open_.append((low, middle, above_low, above))
        open_.append((middle, high, above, above_high))
    return found


def _bisected(polynomial: list[int], low: int, high: int) -> int:
    """The one root in (low, high], to 70 bits or a step of the grid."""
    at_high = _value(polynomial, high)
    if at_high == 0:
        return high
    while high - low > max(1, high >> 70):
        middle = (low + high) // 2
        at = _value(polynomial, middle)
        if at == 0:
            return middle
        if (at > 0) == (at_high > 0):
            high = middle
        else:
            low = middle
    return high


# components

def _extended(x: int) -> np.longdouble:
    high = float(x)
    return np.longdouble(high) + np.longdouble(float(x - int(high)))


def null_vectors(a: np.ndarray, roots: list[tuple[int, int]], most: int) -> np.ndarray:
    """Unit eigenvectors as columns: inverse iteration at each root, then
    corrections by residuals in extended precision. The largest entry of each is
    positive. Equal roots give an orthonormal basis of their space."""
    d = len(a)
    scale = max(int(np.trace(a)), 1)
    shift = max(scale.bit_length() - 1, 0)
    exact = np.array([[_extended(int(v)) for v in row] for row in a]) / np.longdouble(2) ** shift
    plain = exact.astype(np.float64)
    found: list[np.ndarray] = []
    generator = np.random.default_rng(7)
    unit = np.eye(d)
    for root, many in roots:
        whole = _extended(root) / np.longdouble(2) ** (_GRID + shift)
        value = float(whole)
        for k in range(many):
            if len(found) == most:
                break
            v = generator.standard_normal(d)
            off = value * (1 + 2.0 ** -52 * (k + 1))
            for _ in range(4):
                for u in found:
                    v = v - u * (u @ v)
                v = np.linalg.solve(plain - off * unit, v / np.linalg.norm(v))
            v /= np.linalg.norm(v)
            if many == 1:
                for _ in range(3):
                    # One Newton step on (a - value) v = 0, |v| = 1.
                    wide = v.astype(np.longdouble)
                    residual = (exact @ wide - whole * wide).astype(np.float64)
                    system = np.block([[plain - value * unit, -v[:, None]],
                                       [v[None, :], np.zeros((1, 1))]])
                    v = v + np.linalg.solve(system, np.append(-residual, 0.0))[:d]
                    v /= np.linalg.norm(v)
            else:
                for u in found[len(found) - k:]:
                    v -= u * (u @ v)
                v /= np.linalg.norm(v)
            found.append(v if v[np.argmax(np.abs(v))] > 0 else -v)
    return np.array(found).T if found else np.zeros((d, 0))


def fit_whitening(fit: DataFrame, most: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of the distinct integer vectors ``fit``."""
    models = {}
    for d, (n, sums, a) in scatter(fit).items():
        if d == 0:
            continue
        trace = int(np.trace(a))
        roots = largest_roots(characteristic_polynomial(fit.sparkSession, a), most) \
            if trace else []
        each = [root for root, many in roots for _ in range(many)][:most]
        models[d] = Model(
            n, tuple(sums), null_vectors(a, roots, most),
            np.array([root / (n * n << _GRID) for root in each]),
            np.array([root / (trace << _GRID) for root in each]))
    return models


# rows

def _whitened(y: np.ndarray, model: Model) -> tuple[np.ndarray, pa.Array]:
    """Whitened rows, and the exact sums of squared deviations times n squared."""
    sums = np.array(model.sums, object)
    largest = max(int(np.abs(y).max(initial=0)) * model.rows + max(map(abs, model.sums)), 1)
    if largest < 1 << 62:
        away = y * np.int64(model.rows) - sums.astype(np.int64)
    else:
        away = y.astype(object) * model.rows - sums
    if largest ** 2 * y.shape[1] < 1 << 63:
        deviation = pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
    else:
        wide = away.astype(object)
        # A number of more digits than the type has is null.
        exact = [int(s) if s < 10 ** 38 else None for s in (wide * wide).sum(axis=1)]
        deviation = pa.array(exact, pa.decimal128(38, 0))
    z = (away.astype(np.float64) / model.rows) @ model.components
    return z / np.sqrt(model.eigenvalues), deviation


def _second_moments(models: dict[int, Model]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in _matrices(batch.column(0)):
                if y.shape[1] and models[y.shape[1]].components.size:
                    z, _ = _whitened(y, models[y.shape[1]])
                    z = np.column_stack([np.ones(len(z)), z])
                    held[y.shape[1]] = held.get(y.shape[1], 0.0) + z.T @ z
        for d, m in held.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_pydict({
                "length": pa.array(np.full(m.size, d, np.int32)),
                "i": pa.array(i.ravel().astype(np.int32)),
                "j": pa.array(j.ravel().astype(np.int32)), "moment": pa.array(m.ravel())})
    return rows


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """How far the covariance of the whitened distinct vectors is from the
    identity, as its largest entry, for each length."""
    moments: dict[int, dict] = {}
    for r in fit.mapInArrow(_second_moments(models),
                            "length int, i int, j int, moment double").groupBy(
            "length", "i", "j").agg(F.sum("moment").alias("moment")).collect():
        moments.setdefault(r["length"], {})[r["i"], r["j"]] = r["moment"]
    out = {}
    for d, found in moments.items():
        k = models[d].components.shape[1]
        m = np.array([[found[i, j] for j in range(k + 1)] for i in range(k + 1)]) / models[d].rows
        covariance = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])
        out[d] = float(np.abs(covariance - np.eye(k)).max())
    return out


def whiten(vectors: DataFrame, vector_col: str = "embedding",
           most: int = COMPONENTS) -> DataFrame:
    """All rows with a vector of finite entries, and all columns, with ``n`` (the
    distinct vectors), ``deviation`` (decimal: the exact sum over dimensions of
    (n * x - S) ** 2), ``whitened`` and ``explained`` (arrays over the components by
    falling eigenvalue) and ``identity_error``. Input columns of these names are
    replaced.

    Every distinct integer vector counts once in the fit, however often it is
    repeated. Vectors of different lengths are fitted and whitened apart from each
    other. Only positive eigenvalues have components, so there are fewer than
    ``most`` where the vectors span less, and none for a single vector or for
    vectors without entries. Rows whose vector is null or has entries that are null
    or not finite are left out; entries beyond 2**44 count as that bound; a
    deviation above 38 digits is null. An empty table gives no rows.
    """
    added = ["n", "deviation", "whitened", "explained", "identity_error"]
    names = [c for c in vectors.columns if c.lower() not in added]
    mine = free_name(vectors.columns, "entries")
    whole = vectors.select(*[F.col(f"`{c}`") for c in names], whole_entries(
        F.col(f"`{vector_col}`").cast("array<double>")).alias(mine)).where(
        F.col(mine).isNotNull())
    fit = settle(whole.select(F.col(mine).alias("entries")).distinct(), "fit-vectors")
    models = fit_whitening(fit, most)
    errors = identity_errors(fit, models)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            n, whitened, explained = [None] * size, [[] for _ in range(size)], [[]] * size
            deviation, error = [None] * size, [None] * size
            for which, y in _matrices(batch.column(mine)):
                d = y.shape[1]
                if d == 0:
                    continue
                z, away = _whitened(y, models[d])
                share = models[d].explained.tolist()
                for i, row, far in zip(which.tolist(), z.tolist(), away.to_pylist(), strict=True):
                    n[i], whitened[i], explained[i] = models[d].rows, row, share
                    deviation[i], error[i] = far, errors.get(d)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(n, pa.int64()),
                 pa.array(deviation, pa.decimal128(38, 0)),
                 pa.array(whitened, pa.list_(pa.float64())),
                 pa.array(explained, pa.list_(pa.float64())), pa.array(error, pa.float64())],
                [*names, *added])

    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([whole.schema[c] for c in names])
    for name, kind in zip(added, (T.LongType(), T.DecimalType(38, 0), doubles, doubles,
                                  T.DoubleType()), strict=True):
        schema = schema.add(name, kind)
    return whole.mapInArrow(rows, schema)


def whitened_components(whitened: DataFrame, *keep: str) -> DataFrame:
    """One row for each row and component, numbered from 1, with the ``keep``
    columns."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")
    return whitened.select(*keep, "n", "deviation", "identity_error", pairs).select(
        *keep, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"),
        "identity_error")
