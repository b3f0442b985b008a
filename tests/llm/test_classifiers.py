import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import quality, toxicity
from termloom.llm.queries import QUERIES, remainder

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "query, label, modulus, kept, accuracy", [("op1_quality", "quality", 3, 1, 0.97), ("op5_toxicity", "toxic", 5, 0, 0.9)]
)
def test_held_out_accuracy(spark, query, label, modulus, kept, accuracy):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES[query](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == kept)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    hits = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(hits) >= accuracy and len(hits) > 50


def test_held_out_labels_are_never_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    turned = labels.withColumn("label", F.when(remainder(5) == 0, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = (toxicity.fit(docs, x.where(remainder(5) != 0)) for x in (labels, turned))
    assert np.allclose(a.weights, b.weights) and a.constant == pytest.approx(b.constant)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_edges(spark, score):
    docs = spark.createDataFrame(
        [(1, None, 0.1, 1), (2, "", 0.1, 1), (2, "", 0.1, 1), (None, "some words", 0.1, 1), (3, "x" * 100_000, 0.1, 1), (4, "🙂 fine", 0.1, 1)],
        "doc_id bigint, text string, score double, label int",
    )
    schema = "doc_id bigint, label int, text string, stats int"
    for known in ([], [(1, 1, "x", 1)], [(2, 1, "x", 1), (3, 0, "x", 1), (3, None, "x", 1), (None, 1, "x", 1), (9, 1, "x", 1), (2, 0, "y", 1)]):
        rows = score(docs, spark.createDataFrame(known, schema)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 2}) == 1
        if not known:
            assert {r.score for r in rows} == {0.5}
    assert score(docs.limit(0), spark.createDataFrame([(1, 1, "x", 1)], schema)).count() == 0


def test_isotonic_pools_neighbours():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 0.4, 0.2, 0.9, 0.8]), np.ones(5))
    assert y == pytest.approx([0.0, 0.3, 0.85]) and x == pytest.approx([0.0, 1.5, 3.5])


def test_features_approximate_a_gaussian_kernel():
    model = quality.Model(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, quality.STATISTICS))
    made = model.features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / quality.STATISTICS)
    assert np.abs(made @ made.T - kernel).mean() < 0.08
