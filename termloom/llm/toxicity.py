"""A toxicity score of texts: a linear classifier of character n-grams.

Grams of 3 to 5 bytes of the lower-cased text are hashed into buckets, and a bucket
counts once in a text. Documents with and without the label are counted by bucket,
which gives naive Bayes log-count ratios. Buckets whose ratio is far beyond its
standard error are features, scaled by the ratio; logistic regression weighs them.

The fit takes at most about `train_rows` labelled rows, by a digest of doc_id; every
whole text is scored. With no labelled row, or labels of one kind, every score is
the share of that label (0.5 without rows). Null and empty texts have no grams and
score by the constant; rows with a null doc_id are scored and never learnt from; a
document with several labels counts as their mean's nearer label. Repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import map_texts, stored

GRAMS = (3, 4, 5)
BUCKET_BITS = 18
TRAIN_ROWS = 20_000
TRAIN_PARTITIONS = 12
LEAST_DEVIATION = 5.0
SMOOTHING = 1.0
PENALTY = 1e-3
STEPS = 400


def grams(text: str) -> np.ndarray:
    """Buckets of the grams at all places, with repeats."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint64)
    made, packed = [], data
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        packed = (packed[:-1] << np.uint64(8)) | data[n - 1 :]
        if n in GRAMS:
            mixed = (packed + np.uint64(n << 48)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            made.append((mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    return np.concatenate(made) if made else np.zeros(0, np.int32)


class Model:
    """Weights of the buckets, the ratio included, and a constant."""

    def __init__(self, share: float = 0.5):
        self.ratios = np.zeros(1 << BUCKET_BITS, np.float32)
        self.weights = np.zeros(1 << BUCKET_BITS, np.float64)
        self.constant = float(np.log(share / (1 - share))) if 0 < share < 1 else (20.0 if share >= 1 else -20.0)

    def found(self, text: str) -> np.ndarray:
        """The feature buckets that a text has."""
        at = grams(text)
        return np.unique(at[self.ratios[at] != 0])

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.constant + self.weights[self.found(text)].sum(), -30, 30))))


def _counts(rows: DataFrame) -> list:
    """Texts with and without the label, by bucket: as many rows as buckets at most."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for label, text in zip(labels, texts):
                counts[label, np.unique(grams(text))] += 1
        bucket = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict({"bucket": bucket, "without": counts[0, bucket], "with": counts[1, bucket]})

    parts = rows.mapInArrow(partial, "bucket bigint, without bigint, with bigint")
    return parts.groupBy("bucket").agg(F.sum("without").alias("q"), F.sum("with").alias("p")).collect()


def _logistic(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, constant: float) -> tuple[np.ndarray, float]:
    """Penalized weights by accelerated gradient steps over all rows."""
    used = np.flatnonzero(ratios)
    place = np.zeros(len(ratios), np.int64)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    column = place[np.concatenate(features)] if len(row) else np.zeros(0, np.int64)
    value = ratios[used][column].astype(np.float64)
    n = len(labels)
    # The largest curvature, by power iteration, sets the length of a step.
    v = np.ones(len(used) + 1)
    for _ in range(20):
        v /= np.linalg.norm(v)
        s = np.bincount(row, value * v[column], n) + v[-1]
        v = np.append(np.bincount(column, value * s[row], len(used)), s.sum()) / n
    step = 1 / (0.25 * np.linalg.norm(v) * 1.1 + PENALTY)
    weights, ahead = np.append(np.zeros(len(used)), constant), np.append(np.zeros(len(used)), constant)
    for k in range(STEPS):
        s = np.bincount(row, value * ahead[column], n) + ahead[-1]
        error = 1 / (1 + np.exp(-np.clip(s, -30, 30))) - labels
        gradient = np.append(np.bincount(column, value * error[row], len(used)), error.sum()) / n
        gradient[:-1] += PENALTY * ahead[:-1]
        following = ahead - step * gradient
        ahead = following + k / (k + 3) * (following - weights)
        weights = following
    whole = np.zeros(len(ratios))
    whole[used] = weights[:-1] * ratios[used]
    return whole, float(weights[-1])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    size = max(known.count(), 1)
    digest = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    sampled = known.where(digest < train_rows / size)  # bounded, so it may be sent to all tasks
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sampled), "doc_id").select("label", "text")
    rows = stored(rows.repartition(TRAIN_PARTITIONS), "toxicity-train")
    total = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(total.values())
    model = Model(total.get(1, 0) / n if n else 0.5)
    if len(total) < 2:
        return model
    found = _counts(rows)
    bucket = np.array([r.bucket for r in found], np.int64)
    p = np.array([r.p for r in found], float) + SMOOTHING
    q = np.array([r.q for r in found], float) + SMOOTHING
    ratio = np.log(p / (total[1] + 2 * SMOOTHING)) - np.log(q / (total[0] + 2 * SMOOTHING))
    firm = np.abs(ratio) >= LEAST_DEVIATION * np.sqrt(1 / p + 1 / q)
    model.ratios[bucket[firm]] = ratio[firm]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.found(t).astype("<i4").tobytes() for t in texts], pa.binary())], names=["label", "found"])

    seen = rows.mapInArrow(features, "label int, found binary").collect()  # about train_rows at most
    model.weights, model.constant = _logistic(
        [np.frombuffer(r.found, "<i4") for r in seen], np.array([r.label for r in seen], float), model.ratios.astype(np.float64), model.constant
    )
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and score of every row of `docs`, learnt from `labels` (doc_id, label)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_rows))  # 3 MB, by the number of buckets

    def work(texts: list[str]) -> dict:
        return {"score": [model.value.score(t) for t in texts]}

    return map_texts(docs, ["doc_id"], {"score": "double"}, work)


