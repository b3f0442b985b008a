import numpy as np
import pytest

from termloom.llm import embeddings
from termloom.llm.queries import QUERIES
from tests.llm import plain

SCHEMA = "vec_id bigint, embedding array<float>, id bigint, copies string"


def expected(rows):
    """(vec_id, links, component, kept) by comparing all pairs."""
    units = []
    for vec_id, vector in rows:
        ok = vec_id is not None and vector is not None and None not in vector
        x = np.array(vector if ok else [], np.float32).astype(float)
        units.append(x / np.linalg.norm(x) if len(x) and np.isfinite(x).all() and x.any() else None)
    links = [
        (i, j)
        for i, a in enumerate(units)
        for j, b in enumerate(units[:i])
        if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9
    ]
    least = plain.components([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in links])
    counts = np.bincount(np.array(links, int).ravel(), minlength=len(rows))
    return sorted(((r[0], int(n), least[r[0]], r[0] == least[r[0]] if r[0] is not None else False) for r, n in zip(rows, counts)), key=str)


def found(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)
    return sorted(map(tuple, embeddings.near_duplicates(docs, **more).collect()), key=str)


def test_query_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op3_embeddings"](spark, sf).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("size", [2, 17, 40])
def test_clusters_over_several_strips(spark, size):
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(12, size))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=size) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist()) for i in range(300)]
    assert found(spark, rows, strip_rows=40) == expected(rows)


def test_edges(spark):
    big = 3e38
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [float("nan"), 1.0]),
        (9, [float("inf"), 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [big, big]), (12, [1e-30, 1e-30]), (13, [-1.0, 0.0]),
    ]
    assert found(spark, rows) == expected(rows)
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_doubles_beyond_floats_and_the_threshold_itself(spark):
    rows = [(1, [1e-50, 0.0]), (2, [1e300, 1.0]), (3, [1.0, 0.0]), (4, [1.0, 1e-3]), (5, [0.0, 1e-310]), (5, [0.0, 1e-310]), (6, [0.0, -1.0]), (3, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, embeddings.near_duplicates(frame).collect()))
    near = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (3, 4, 1, False), (4, 4, 1, False)]
    assert got == sorted([*near, (5, 1, 5, True), (5, 1, 5, True), (6, 0, 6, True)])
    # The cosine of these is 0.8 with threshold 0.8: linked; a little less is not.
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [4.0, 3.0]), (3, [4.0, -3.0000001])], "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, embeddings.near_duplicates(frame, threshold=0.8).collect()))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
