from fractions import Fraction
from math import floor

import numpy as np
import pytest

from termloom.llm import whitening
from termloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, x string, n int"


def expected(rows):
    """The result by whole numbers of any size and a library's eigenvectors, for vectors of one length."""
    sound = [(i, [floor(Fraction(float(c)) * 256) for c in v]) for i, v in rows]
    points = sorted({tuple(x) for _, x in sound})
    n, sums = len(points), [sum(c) for c in zip(*points)]
    away = lambda x: [n * a - s for a, s in zip(x, sums)]
    y = np.array([away(p) for p in points], float) / n
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors.T[::-1][:4]
    whole = {}
    for i, x in sound:
        d = np.array(away(x), float) / n
        for c in range(len(values)):
            whole.setdefault((i, c + 1), []).append((sum(a * a for a in away(x)), d @ vectors[c] / np.sqrt(values[c])))
    return n, whole, values / np.trace(covariance)


def agree(got, rows):
    n, want, explained = expected(rows)
    signs = {}
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        assert r.n == n and r.deviation in [d for d, _ in want[r.vec_id, r.component]]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
        value = next(w for d, w in want[r.vec_id, r.component] if d == r.deviation)
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - value) <= abs(r.whitened + value) else -1)
        assert sign * r.whitened == pytest.approx(value, abs=1e-7)
    assert len({r.identity_error for r in got}) == 1


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agree(QUERIES["op12_whitening"](spark, SF).collect(), rows)


def test_copies_count_once_and_keep_their_rows(spark):
    rng = np.random.default_rng(1)
    some = (rng.normal(size=(60, 7)) * [9, 7, 5, 3, 2, 1, 0.5]).tolist()
    rows = [(i % 50, some[i if i < 60 else 0]) for i in range(200)]
    frame = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whitened(frame).collect()
    assert len(got) == 800 and {r.n for r in got} == {60}
    agree(got, rows)


def test_unsound_rows_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 3.0]), (3, [0.5, 0.5]), (None, [0.5, 0.5]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [1e300, 1.0]), (10, [1e17, 1.0]), (11, [7.0]), (12, [9.0, 9.0, 9.0]), (12, [9.0, 9.0, 9.0]), (13, [-0.0, -0.001]),
    ]
    found = whitening.whitened(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)).collect()
    two = [r for r in found if r.vec_id in (1, 2, 3, None, 13)]
    assert sorted((str(r.vec_id), r.component) for r in two) == sorted((i, c) for i in ("1", "2", "3", "13", "None") for c in (1, 2))
    agree(two, [(i, v) for i, v in rows if i in (1, 2, 3, None, 13)])
    # Without any variance there is nothing to whiten.
    rest = [tuple(r) for r in found if r not in two]
    assert sorted(rest) == sorted([(11, 1, 1, 0, None, 0.0, 0.0)] + [(12, c, 1, 0, None, 0.0, 0.0) for c in (1, 2, 3)] * 2)
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []


def test_deviations_are_exact_or_null(spark):
    big = 2.0**40
    rows = [(1, [big, 1.0]), (2, [-big, 2.0]), (3, [0.0, 3.0]), (4, [2.0**20, 0.0])]
    got = whitening.whitened(spark.createDataFrame([(*r, "", 1) for r in rows], SCHEMA)).collect()
    _, want, _ = expected(rows)
    for r in got:
        exact = want[r.vec_id, r.component][0][0]
        assert r.deviation == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("case", ["random", "repeated", "diagonal", "ones", "low rank", "graded", "one", "two"])
def test_leading_components_of_symmetric_matrices(case):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    matrix = {
        "random": lambda: turn @ np.diag(rng.uniform(0, 5, 30)) @ turn.T,
        "repeated": lambda: turn @ np.diag([4.0] * 3 + [2.0] * 7 + [1.0] * 20) @ turn.T,
        "diagonal": lambda: np.diag([1.0, 3.0, 3.0, 2.0, 3.0]),
        "ones": lambda: np.ones((6, 6)),
        "low rank": lambda: turn[:, :2] @ np.diag([5.0, 1.0]) @ turn[:, :2].T,
        "graded": lambda: turn @ np.diag(10.0 ** -np.arange(30)) @ turn.T,
        "one": lambda: np.array([[2.0]]),
        "two": lambda: np.array([[2.0, 1.0], [1.0, 2.0]]),
    }[case]()
    matrix = (matrix + matrix.T) / 2
    k = min(5, len(matrix))
    values, rows = whitening.leading(matrix, 5)
    size = np.abs(matrix).max()
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * size, rtol=0)
    assert np.abs(rows @ rows.T - np.eye(k)).max() < 1e-12
    assert np.abs(rows @ matrix - values[:, None] * rows).max() < 1e-12 * size


def test_sturm_counts():
    rng = np.random.default_rng(4)
    d, e = rng.normal(size=20), rng.normal(size=19)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-6, 6, 50)
    assert whitening.below(d, e, at).tolist() == [(values < a).sum() for a in at]
