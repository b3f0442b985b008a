"""Whitened projections of embeddings onto the leading components of their covariance.

Entries are first made whole numbers, 256 to the unit, so that sums are exact and
copies are recognised. The covariance is that of the distinct vectors: each counts
once, however many copies it has.

1. The distinct vectors are stored. Partitions sum them, in whole numbers.
2. With the mean known, each partition centres its vectors and sums their products; the
   rows of these sums are added up where a shuffle by row has put them.
3. The driver has one matrix, as wide as a vector is long. Householder reflections make it
   tridiagonal; Sturm counts and bisection give the leading eigenvalues, and inverse
   iteration their vectors, made orthogonal to each other where eigenvalues are close.
4. The components travel to all tasks, which project every row. The covariance of what
   the distinct vectors become is measured against the identity.

Rows whose vector is null or empty, or holds null or non-finite entries, are left out, as
are entries beyond 2^62 / 256, which have no whole number. Vectors of different length have
no common covariance: each length is treated by itself. Repeated rows and rows without
an id give rows like any other. A component without variance (of a table with few
distinct vectors) explains 0 and has a null whitened value; identity_error is over the
other components. A deviation beyond a long is null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import stored

SCALE = 256
LARGEST = 2.0**62
COMPONENTS = 4
ROWS = 4096  # vectors that a task has as doubles at once
CLUSTER = 1e-3  # eigenvalues nearer than this share of the largest are one cluster
EPSILON = np.finfo(float).eps
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: np.ndarray  # whole numbers of any size
    projection: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # a row for each component
    explained: list = field(default_factory=list)
    identity_error: float | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: as longs where they suffice."""
        most = max(int(np.abs(x).max(initial=0)), 1)
        if self.n * most + max(map(abs, self.sums), default=0) < 2**62:
            return x * np.int64(self.n) - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        away = self.scaled(x)
        if away.dtype == object or int(np.abs(away).max(initial=0)) ** 2 * away.shape[1] >= 2**63:
            totals = (away.astype(object) ** 2).sum(axis=1)
            return [t if t < 2**63 else None for t in totals]
        return (away * away).sum(axis=1).tolist()


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal, and the Householder vectors, of which the k-th acts from place k + 1."""
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        x[0] += np.copysign(size, x[0])
        length = np.linalg.norm(x)
        v = x / length if length > 0 else x
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
        if length > 0:
            a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
            a[k + 2 :, k] = a[k, k + 2 :] = 0
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each place."""
    least = EPSILON * max(np.abs(e).max(initial=0), np.abs(d).max(initial=0), np.finfo(float).tiny / EPSILON)
    q, count = np.ones(len(at)), np.zeros(len(at), int)
    for own, beside in zip(d, np.insert(e, 0, 0)):
        q = own - at - beside**2 / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def largest_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each between two places that bisection brings together."""
    reach = np.abs(np.append(e, 0)) + np.abs(np.insert(e, 0, 0))
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    wanted = len(d) - np.arange(1, k + 1)  # eigenvalues below the sought one
    while True:
        middle = (low + high) / 2
        inside = (low < middle) & (middle < high)
        if not inside.any():
            return middle
        up = below(d, e, middle) <= wanted
        low, high = np.where(inside & up, middle, low), np.where(inside & ~up, middle, high)


def _solved(d: np.ndarray, e: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """The solution of a tridiagonal system, by elimination with row exchanges."""
    n = len(d)
    u, v, w = d.copy(), np.append(e, 0.0), np.zeros(n)  # the diagonal and two above it
    x = b.copy()
    for i in range(n - 1):
        down, own, right = e[i], d[i + 1], v[i + 1]
        if abs(down) > abs(u[i]):
            factor = u[i] / down
            u[i], u[i + 1], v[i + 1], w[i] = down, v[i] - factor * own, -factor * right, right
            v[i] = own
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            u[i] = u[i] if abs(u[i]) > least else least
            factor = down / u[i]
            u[i + 1], v[i + 1] = own - factor * v[i], right
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        pivot = u[i] if abs(u[i]) > least else least
        x[i] -= (v[i] * x[i + 1] if i + 1 < n else 0) + (w[i] * x[i + 2] if i + 2 < n else 0)
        x[i] /= pivot
    return x


def vectors_of(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as rows, by inverse iteration; those of a cluster are kept orthogonal."""
    size = max(np.abs(d).max(initial=0) + 2 * np.abs(e).max(initial=0), np.finfo(float).tiny)
    rng = np.random.default_rng(12)
    found: list[np.ndarray] = []
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            first = k
        x = rng.normal(size=len(d))
        for _ in range(8):
            x = _solved(d - value, e, x / np.linalg.norm(x), EPSILON * size)
            if not np.isfinite(x).all():
                x = rng.normal(size=len(d))
            x /= np.abs(x).max()
            for _ in range(2):  # twice, as the first leaves rounding errors
                for other in found[first:]:
                    x -= (x @ other) * other
        found.append(x / np.linalg.norm(x))
    return np.array(found)


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    k = min(k, len(matrix))
    size = np.abs(matrix).max(initial=0)
    if not size > 0:
        return np.zeros(k), np.eye(len(matrix))[:k]
    d, e, reflections = tridiagonal(matrix / size)
    rows = vectors_of(d, e, largest_values(d, e, k))
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        rows[:, i + 1 :] -= 2 * np.outer(rows[:, i + 1 :] @ v, v)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    values = np.einsum("ij,jk,ik->i", rows, matrix, rows)
    order = np.argsort(-values, kind="stable")
    return values[order], rows[order]


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors, by length, some thousand at once."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths):
        places = np.flatnonzero(lengths == size)
        for start in range(0, len(places), ROWS):
            at = places[start : start + ROWS]
            whole = column if len(at) == len(column) else column.take(pa.array(at))
            yield at, whole.flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the entries as whole numbers, of the rows that have a sound vector."""
    entry = lambda c: c.cast("double") * SCALE
    sound = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(entry(c)) < LARGEST))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return rows.where(sound & (F.size("embedding") > 0)).select("vec_id", F.transform("embedding", lambda c: F.floor(entry(c))).alias("x"))


def _totals(points: DataFrame) -> dict[int, Fit]:
    """Number and sums of the distinct vectors of each length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, x in _blocks(batch.column(0)):
                size = x.shape[1]
                exact = x if int(np.abs(x).max()) * len(x) < 2**62 else x.astype(object)
                n[size] = n.get(size, 0) + len(at)
                sums[size] = sums.get(size, 0) + exact.sum(axis=0).astype(object)
        for size, total in sums.items():
            columns = {"size": pa.array([size] * size, pa.int32()), "i": pa.array(range(size), pa.int32()), "n": pa.array([n[size]] * size, pa.int64())}
            yield pa.RecordBatch.from_pydict({**columns, "total": pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))})

    parts = points.select("x").mapInArrow(add, "size int, i int, n bigint, total decimal(38,0)")
    found = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # as many as a vector has entries
    fits: dict[int, Fit] = {}
    for r in found:
        fits.setdefault(r.size, Fit(r.n, np.zeros(r.size, object))).sums[r.i] = int(r.total)
    return fits


def _covariances(points: DataFrame, fits: dict[int, Fit]) -> dict[int, np.ndarray]:
    """Of each length: products of centred vectors that partitions sum, row by row, and a shuffle brings together."""
    known = points.sparkSession.sparkContext.broadcast(fits)  # two numbers for each entry of a vector
    schema = "size int, i int, products array<double>"

    def emitted(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        size, i = (pa.array([key[part] for key in sums], pa.int32()) for part in (0, 1))
        return pa.RecordBatch.from_pydict({"size": size, "i": i, "products": pa.array(list(sums.values()), pa.list_(pa.float64()))})

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _blocks(batch.column(0)):
                y = known.value[x.shape[1]].centred(x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + y.T @ y
        for size, total in sums.items():
            yield emitted({(size, i): row for i, row in enumerate(total)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                values = row.values.to_numpy(zero_copy_only=False)
                sums[size, i] = sums[size, i] + values if (size, i) in sums else values
        if sums:
            yield emitted(sums)

    rows = points.select("x").mapInArrow(multiply, schema).repartition("size", "i").mapInArrow(add, schema).collect()
    made = {size: np.zeros((size, size)) for size in fits}
    for r in rows:
        made[r.size][r.i] = r.products
    return {size: (m + m.T) / (2 * fits[size].n) for size, m in made.items()}


def _identity_errors(points: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Of each length the largest entry of the whitened covariance less the identity.

    Blocks are centred on their own means before they are multiplied, and merged by the means' distance.
    """
    known = points.sparkSession.sparkContext.broadcast(fits)
    schema = "size int, n bigint, mean array<double>, products array<double>"

    def merged(a: tuple | None, n: int, mean: np.ndarray, products: np.ndarray) -> tuple:
        if a is None:
            return n, mean, products
        apart, total = mean - a[1], a[0] + n
        return total, a[1] + apart * (n / total), a[2] + products + np.outer(apart, apart) * (a[0] * (n / total))

    def emitted(sums: dict[int, tuple]) -> pa.RecordBatch:
        lists = pa.list_(pa.float64())
        return pa.RecordBatch.from_pydict({
            "size": pa.array(list(sums), pa.int32()), "n": pa.array([s[0] for s in sums.values()], pa.int64()),
            "mean": pa.array([s[1] for s in sums.values()], lists), "products": pa.array([s[2].ravel() for s in sums.values()], lists),
        })

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple] = {}
        for batch in batches:
            for at, x in _blocks(batch.column(0)):
                fit = known.value[x.shape[1]]
                z = fit.centred(x) @ fit.projection.T
                mean = z.mean(axis=0)
                sums[x.shape[1]] = merged(sums.get(x.shape[1]), len(at), mean, (z - mean).T @ (z - mean))
        if sums:
            yield emitted(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple] = {}
        for batch in batches:
            for size, n, mean, products in zip(*(c.to_pylist() for c in batch.columns)):
                sums[size] = merged(sums.get(size), n, np.array(mean), np.array(products).reshape(len(mean), len(mean)))
        if sums:
            yield emitted(sums)

    rows = points.select("x").mapInArrow(measure, schema).repartition("size").mapInArrow(add, schema).collect()
    return {r.size: float(np.abs(np.array(r.products).reshape(len(r.mean), len(r.mean)) / r.n - np.eye(len(r.mean))).max(initial=0)) for r in rows}


def fit(points: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """By length, the components of the vectors `x` of `points`, each row counting once."""
    fits = _totals(points)
    for size, covariance in (_covariances(points, fits) if fits else {}).items():
        values, rows = leading(covariance, components)
        trace = np.trace(covariance)
        varied = values > size * EPSILON * trace
        fits[size].projection = rows[varied] / np.sqrt(values[varied])[:, None]
        fits[size].explained = [float(v / trace) if ok else 0.0 for v, ok in zip(values, varied)]
    for size, error in (_identity_errors(points, fits) if fits else {}).items():
        fits[size].identity_error = error
    return fits


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of the sound rows of `vectors` (vec_id, embedding)."""
    rows = whole_numbers(vectors)
    fits = fit(stored(rows.select("x").distinct(), "whitening-points"), components)
    known = vectors.sparkSession.sparkContext.broadcast(fits)  # `components` numbers and two for each entry of a vector
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _blocks(batch.column(1)):
                fit = known.value[x.shape[1]]
                k, varied = len(fit.explained), len(fit.projection)
                values = np.zeros((len(at), k))
                values[:, :varied] = fit.centred(x) @ fit.projection.T
                unknown = np.tile(np.arange(k) >= varied, len(at))
                each = np.repeat(np.arange(len(at)), k)
                arrays = [
                    batch.column(0).take(pa.array(at[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(each), fit.n)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(values.ravel(), mask=unknown),
                    pa.array(np.tile(np.array(fit.explained, float), len(at))),
                    pa.array([fit.identity_error] * len(each), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(project, SCHEMA)
