"""A quality score of texts: a kernel classifier over document statistics.

Statistics of each text are standardized and sent through random Fourier features,
whose inner products approximate a Gaussian kernel. Ridge regression is fitted from
normal equations that each partition sums and Spark adds up. They are kept by fold:
the sums of all folds but one give the scores of that fold's rows, and isotonic
regression of the labels on these out-of-fold scores makes them probabilities.

The fit takes at most about `train_rows` labelled rows, by a digest of doc_id; the
statistics and scores are of all rows. With no labelled row every score is 0.5.
Null and empty texts have statistics of zero and a score like any other; rows with a
null doc_id are scored and never learnt from; a document with several labels counts
by their mean. Repeated rows give repeated results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import map_texts, schema_of, stored, unused

FEATURES = 192
FOLDS = 3
RIDGE = 1e-3
TRAIN_ROWS = 200_000
TRAIN_PARTITIONS = 12
GRID = 2048  # cells of the calibration for each unit of the raw score
STATISTICS = 20
SEED = 20_061


def statistics(text: str) -> list[float]:
    """Shares, means and logarithms that say how a text is made, not what it says."""
    if not text:
        return [0.0] * STATISTICS
    data = text.encode("utf-8", "surrogatepass")
    n = len(data)
    of = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    upper, lower = of[65:91].sum(), of[97:123].sum() + of[128:].sum()
    digits, spaces = of[48:58].sum(), of[9:14].sum() + of[32]
    other = n - upper - lower - digits - spaces
    share = of[of > 0] / n
    words = text.split()
    counts = Counter(words)
    m = max(len(words), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    distinct_lines = len(set(lines))
    repeats = sum(map(str.__eq__, words, words[1:]))
    plain = sum(map(str.isalpha, words))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        upper / n,
        digits / n,
        spaces / n,
        other / n,
        (of[44] + of[46] + of[59] + of[58]) / n,
        of[33] / m,
        of[124] / m,
        (of[35] + of[36] + of[37] + of[38] + of[42]) / m,
        float(-(share * np.log2(share)).sum()),
        n / m,
        len(counts) / m,
        max(counts.values(), default=0) / m,
        repeats / m,
        plain / m,
        sum(1 for w in words if w[-1] in ".?!") / m,
        np.log1p(len(lines)),
        distinct_lines / max(len(lines), 1),
        upper / max(upper + lower, 1),
    ]


class Model:
    """Standardization, random features, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        rng = np.random.default_rng(SEED)
        self.frequencies = rng.normal(size=(STATISTICS, FEATURES)) * np.sqrt(2 / STATISTICS)
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps = (np.array([0.0]), np.array([0.5]))

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6) @ self.frequencies + self.phases
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z), np.ones((len(stats), 1))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, *self.steps), 0, 1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    at = rows.select(F.posexplode("stats").alias("i", "x")).groupBy("i")
    found = {r.i: r for r in at.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std")).collect()}
    mean = np.array([found[i]["mean"] for i in range(STATISTICS)])
    std = np.array([found[i]["std"] for i in range(STATISTICS)])
    return mean, np.where(std > 1e-9, std, 1.0)


def _normal_equations(rows: DataFrame, model: Model) -> dict[int, np.ndarray]:
    """By fold, the sums of products of features, the label as the last of them."""
    width = FEATURES + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.hstack([model.features(_matrix(batch.column(2), STATISTICS)), batch.column(1).to_numpy(zero_copy_only=False)[:, None]])
            for f in np.unique(fold):
                sums[f] = sums.get(f, 0) + x[fold == f].T @ x[fold == f]
        for f, total in sums.items():
            yield pa.RecordBatch.from_pydict({"fold": pa.array([f] * width, pa.int32()), "i": pa.array(range(width), pa.int32()), "row": list(total)})

    def add(table: pa.Table) -> pa.Table:
        total = _matrix(table["row"].combine_chunks(), width).sum(axis=0)
        return pa.table({"fold": table["fold"][:1], "i": table["i"][:1], "row": [total]})

    schema = "fold int, i int, row array<double>"
    parts = rows.select("fold", "label", "stats").mapInArrow(partial, schema)
    sums: dict[int, np.ndarray] = {}
    for r in parts.groupBy("fold", "i").applyInArrow(add, schema).collect():
        sums.setdefault(r.fold, np.zeros((width, width)))[r.i] = r.row
    return sums


def _solve(total: np.ndarray) -> np.ndarray:
    x, y = total[:-1, :-1], total[:-1, -1]
    ridge = RIDGE * max(x[-1, -1], 1.0) * np.eye(len(x))
    ridge[-1, -1] = 0  # the constant is free
    return np.linalg.solve(x + ridge + 1e-9 * np.eye(len(x)), y)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of neighbouring points, pooled until they do not fall; x ascends."""
    blocks: list[list[float]] = []  # weight, weighted x, weighted y
    for xi, yi, wi in zip(x, y, weight):
        blocks.append([wi, xi * wi, yi * wi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    made = np.array(blocks)
    return made[:, 1] / made[:, 0], made[:, 2] / made[:, 0]


def fit(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """`stats` has doc_id and stats, `labels` doc_id and label; their join is learnt."""
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    size = max(known.count(), 1)
    digest = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    sampled = known.where(digest < train_rows / size)
    rows = (
        stats.join(sampled, "doc_id")
        .select(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold"), "label", "stats")
        .repartition(TRAIN_PARTITIONS)
    )
    rows = stored(rows, "quality-train")
    if rows.isEmpty():
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS))
    model = Model(*_moments(rows))
    sums = _normal_equations(rows, model)
    total = sum(sums.values())
    model.weights = _solve(total)
    others = {f: _solve(total - s) if len(sums) > 1 else model.weights for f, s in sums.items()}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            x = model.features(_matrix(batch.column(2), STATISTICS))
            raw = np.array([x[i] @ others[f] for i, f in enumerate(fold)])
            cell = np.round(np.clip(raw, -1, 2) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(1)], names=["cell", "label"])

    grid = rows.mapInArrow(cells, "cell bigint, label double").groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("y"))
    found = np.array(sorted((r.cell, r.n, r.y) for r in grid.collect()), dtype=float)  # 3 * GRID rows at most
    model.steps = isotonic(found[:, 0] / GRID, found[:, 2] / found[:, 1], found[:, 1])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of `stats`, and the score."""
    names = [c for c in stats.columns if c != "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for start in range(0, batch.num_rows, 4096):
                x = model.features(_matrix(batch.column(len(names)).slice(start, 4096), STATISTICS))
                made.append(model.calibrated(x @ model.weights))
            values = pa.array(np.concatenate(made) if made else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*names, "score"])

    return stats.select(*names, "stats").mapInArrow(run, schema_of(stats, names, {"score": "double"}))


def document_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    width = pa.list_(pa.float64())
    return map_texts(docs, columns, {"stats": "array<double>"}, lambda texts: {"stats": pa.array([statistics(t) for t in texts], width)})


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and score of every row of `docs`, learnt from `labels` (doc_id, label)."""
    stats = stored(document_statistics(docs, ["doc_id"]), "quality-statistics")
    return score(stats, fit(stats, labels, train_rows))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of `docs`, all columns, that score `least` or more."""
    stats = stored(document_statistics(docs, ["doc_id"]), "quality-statistics")
    model = fit(stats, labels, train_rows)

    def work(texts: list[str]) -> dict:
        stats = np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)
        return {score: model.calibrated(model.features(stats) @ model.weights)}

    score = unused(docs.columns, "score")
    return map_texts(docs, docs.columns, {score: "double"}, work).where(F.col(score) >= least).drop(score)
