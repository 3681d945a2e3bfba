"""Whitening against a dense eigendecomposition of the same integers."""

import math

import numpy as np
import pytest

from tillmark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n long, component string"


def brute(vectors):
    """By length: n, sums, eigenvalues and eigenvectors of the distinct integer vectors."""
    distinct = {}
    for v in vectors:
        if v and all(c is not None and math.isfinite(c) for c in v):
            distinct.setdefault(len(v), set()).add(tuple(math.floor(64 * c) + 1000000 for c in v))
    found = {}
    for d, xs in distinct.items():
        n, sums = len(xs), [sum(column) for column in zip(*xs)]
        y = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in xs])
        values, turn = np.linalg.eigh(y.T @ y / n)
        found[d] = n, sums, values[::-1], turn[:, ::-1]
    return found


def check(rows, result):
    fits = brute([v for _, v, *_ in rows])
    expected = {}
    for vec_id, v, *_ in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            n, sums, values, turn = fits[len(v)]
            x = [math.floor(64 * c) + 1000000 for c in v]
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            y = np.array([(n * a - s) / n for a, s in zip(x, sums)])
            for k in range(min(16, len(v))):
                if values[k] > 1e-9 * values[0] and values[0] > 0:
                    expected.setdefault((vec_id, k + 1, n, deviation), []).append((abs(y @ turn[:, k]) / math.sqrt(values[k]), values[k] / values.sum()))
    got = {}
    for r in result:
        got.setdefault((r.vec_id, r.component, r.n, r.deviation), []).append((abs(r.whitened), r.explained))
        assert r.identity_error <= 1e-6
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in expected.items()}
    for key, pairs in expected.items():
        np.testing.assert_allclose(sorted(got[key]), sorted(pairs), rtol=1e-5, atol=1e-6)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("spectrum", ["falling", "flat"])
def test_matches_dense_decomposition(spark, spectrum):
    rng = np.random.default_rng(1)
    scale = 0.93 ** np.arange(70) if spectrum == "falling" else np.ones(70)
    x = rng.standard_normal((900, 70)) * scale @ np.linalg.qr(rng.standard_normal((70, 70)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(1000 + i, [float(c) for c in x[0]]) for i in range(300)]
    check(rows, whitening.whitened(table(spark, rows)).collect())


def test_unusable_vectors_lengths_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(3 + i % 2)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 1.0, 2.0]), (104, [math.inf, 1.0, 2.0])]
    rows += [(None, rows[0][1]), (0, rows[0][1]), (0, rows[0][1]), (105, [1.0, 2.0]), (106, [0.0, 0.0, 0.0])]
    check(rows, whitening.whitened(table(spark, rows)).collect())


def test_vectors_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0001, 2.0])]
    assert whitening.whitened(table(spark, rows)).collect() == []
    rows += [(4, [3.0, 2.0]), (5, [4.0, 2.0])]
    found = whitening.whitened(table(spark, rows)).collect()
    assert {(r.vec_id, r.component, r.n) for r in found} == {(i, 1, 3) for i in range(1, 6)}
    check(rows, found)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(c)]) for i, c in enumerate([1e9, -1e9, 3e8, 7.0])]
    n, sums, _, _ = brute([v for _, v in rows])[1]
    found = {r.vec_id: r.deviation for r in whitening.whitened(table(spark, rows)).collect()}
    for i, v in rows:
        exact = (n * (math.floor(64 * v[0]) + 1000000) - sums[0]) ** 2
        assert found[i] == (exact if exact < 2**63 else None)
    huge = whitening.whitened(table(spark, [(1, [1e300]), (2, [-1e300]), (3, [0.0])])).collect()
    assert [r.deviation for r in huge if r.vec_id == 1] == [None] and len(huge) == 3


def test_empty_table(spark):
    assert whitening.whitened(table(spark, [])).collect() == []


def test_query(spark, sf_dir):
    vectors = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(vectors, whitening.op11_embedding_whitening(spark, sf_dir).collect())
