"""Near-duplicate vectors by cosine: tiles in the order of principal components.

Unit vectors are turned so that their components come in the order of the energy that
they carry over the whole table. The vectors are dealt into strips by the leading
component. Two vectors within the threshold differ in it by a known distance at most,
so only strips that are so near are compared, each pair of strips as one task.
Within a pair of strips, tiles are multiplied over the leading components first; the
products of the rest are bounded by the norms of the rest, and what cannot reach the
threshold is given up. What remains to the end is decided by the cosine of the given
components in double precision.

Equal vectors are one class before any comparison. A task returns how many vectors
each one is linked to, and the links of a spanning forest: as many rows as it has
vectors, however many links it found.

Vectors that are null, zero, or hold null or non-finite components link with nothing,
nor do rows without an id or vectors of different length. Ids are taken as unique;
rows that are equal in both are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import stored
from termloom.llm.components import connected_components

THRESHOLD = 0.9
STRIP_ROWS = 8_192
TILE_ROWS = 1_024
LEADING = (16, 32)  # components multiplied before bounds are looked at
DENSE = 0.05  # share of survivors above which a whole tile is multiplied further
SLACK = 1e-9
JITTER = 1e-9  # spreads vectors of equal leading component over strips


def _unit(column: pa.Array, size: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Axes as columns, by falling energy, from products that each partition sums."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                x = _unit(batch.column(0).slice(start, 4096), size)
                total += x.T @ x
        yield pa.RecordBatch.from_pydict({"sums": [total.ravel()]})

    parts = vectors.select("embedding").mapInArrow(products, "sums array<double>")
    sums = parts.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    total = np.zeros(size * size)
    for r in sums:
        total[r.i] = r.x
    return np.linalg.eigh(total.reshape(size, size))[1][:, ::-1]


def _survivors(a: np.ndarray, b: np.ndarray, rest_a: dict, rest_b: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs that the leading components do not rule out."""
    steps = [m for m in LEADING if m < a.shape[1]]
    if not steps:
        return np.nonzero(a @ b.T >= threshold - SLACK)
    part, done = a[:, : steps[0]] @ b[:, : steps[0]].T, steps[0]
    i = j = None
    for m, following in zip(steps, [*steps[1:], a.shape[1]]):
        if i is None:
            i, j = np.nonzero(part + np.outer(rest_a[m], rest_b[m]) >= threshold - SLACK)
            if len(i) > DENSE * part.size:
                part += a[:, m:following] @ b[:, m:following].T
                i = j = None
                continue
            value = part[i, j]
        else:
            keep = value + rest_a[m][i] * rest_b[m][j] >= threshold - SLACK
            i, j, value = i[keep], j[keep], value[keep]
        value = value + np.einsum("ij,ij->i", a[i, m:following], b[j, m:following])
    if i is None:
        return np.nonzero(part >= threshold - SLACK)
    keep = value >= threshold - SLACK
    return i[keep], j[keep]


class Forest:
    """Least node of each part, kept while links are added by many at once."""

    def __init__(self, n: int):
        self.least = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.least[a], self.least[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.least, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.least[self.least]
                if np.array_equal(up, self.least):
                    break
                self.least = up


def _compare(table: pa.Table, axes: np.ndarray, first: int, second: int, threshold: float) -> pa.Table:
    """Counts and forest links of two strips, or of one with itself."""
    table = table.sort_by("id")
    size = len(axes)
    ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
    strip = table["strip"].to_numpy()
    unit = _unit(table["embedding"].combine_chunks(), size)
    turned = unit @ axes
    rest = {m: np.sqrt(np.maximum(1 - (turned[:, :m] ** 2).sum(axis=1), 0)) for m in LEADING}
    left, right = np.flatnonzero(strip == first), np.flatnonzero(strip == second)
    counts, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
    for x in range(0, len(left), TILE_ROWS):
        rows = left[x : x + TILE_ROWS]
        for y in range(x if first == second else 0, len(right), TILE_ROWS):
            columns = right[y : y + TILE_ROWS]
            i, j = _survivors(turned[rows], turned[columns], {m: r[rows] for m, r in rest.items()}, {m: r[columns] for m, r in rest.items()}, threshold)
            a, b = rows[i], columns[j]
            if first == second:
                a, b = a[a < b], b[a < b]
            keep = np.concatenate([np.einsum("ij,ij->i", unit[a[k : k + 65536]], unit[b[k : k + 65536]]) >= threshold for k in range(0, len(a), 65536)] or [np.zeros(0, bool)])
            a, b = a[keep], b[keep]
            counts += np.bincount(a, copies[b], len(ids)).astype(np.int64) + np.bincount(b, copies[a], len(ids)).astype(np.int64)
            forest.link(a, b)
    some = np.flatnonzero(counts)
    return pa.table({"id": ids[some], "n": counts[some], "root": ids[forest.least[some]]})


def _links(classes: DataFrame, size: int, threshold: float, strip_rows: int) -> DataFrame:
    """id, n, root: partial counts of links, and links of forests, of vectors of one length."""
    spark = classes.sparkSession
    axes = principal_axes(classes, size)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            noise = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) / 2.0**24
            made = _unit(batch.column(2), size) @ axes[:, 0] + JITTER * noise if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=["id", "copies", "embedding", "lead"])

    placed = classes.select("id", "copies", "embedding").mapInArrow(lead, "id bigint, copies bigint, embedding array<double>, lead double")
    strips = -(-placed.count() // strip_rows)
    edges = sorted(placed.approxQuantile("lead", [k / strips for k in range(1, strips)], 1 / (8 * strips))) if strips > 1 else []
    lows, highs = np.array([-np.inf, *edges]), np.array([*edges, np.inf])
    reach = np.sqrt(max(2 - 2 * threshold, 0)) + SLACK + 2 * JITTER
    shared = spark.sparkContext.broadcast((lows, highs))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs = shared.value
        for batch in batches:
            strip = np.searchsorted(lows, batch.column(3).to_numpy(zero_copy_only=False), side="right") - 1
            near = np.searchsorted(highs, lows[strip] - reach), np.searchsorted(lows, highs[strip] + reach, side="right") - 1
            arrays = [*batch.columns[:3], *(pa.array(x.astype(np.int32)) for x in (strip, *near))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "copies", "embedding", "strip", "a", "b"])

    dealt = placed.mapInArrow(deal, "id bigint, copies bigint, embedding array<double>, strip int, a int, b int")
    sent = dealt.select("id", "copies", "embedding", "strip", F.explode(F.sequence("a", "b")).alias("other")).select(
        "id", "copies", "embedding", "strip", F.least("strip", "other").alias("first"), F.greatest("strip", "other").alias("second")
    )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        return _compare(table, axes, key[0].as_py(), key[1].as_py(), threshold)

    return sent.groupBy("first", "second").applyInArrow(compare, "id bigint, n bigint, root bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(sound, F.lit(False)).alias("sound"))
    classes = stored(
        rows.where("sound").groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vector-classes"
    )
    sizes = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        part = _links(classes.where(F.size("embedding") == size), size, threshold, strip_rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = classes.select("id", F.col("copies").alias("n"), F.col("id").alias("root")).limit(0)
    found = stored(found, "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    components = connected_components(found.select("id", "root")).toDF("id", "component")
    classed = classes.join(counts, "id", "left").join(components, "id", "left")
    of = classed.select(
        F.col("embedding").alias("__vector"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    joined = rows.join(of, rows.sound & (rows.embedding == of["__vector"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
