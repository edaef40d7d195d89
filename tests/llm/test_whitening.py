import math
from fractions import Fraction

import numpy as np
import pytest

from streamweave.llm import queries
from streamweave.llm.whitening import bidiagonalised, deviations, whitened


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)


def grid(v):
    return [math.floor(64 * float(np.float64(c))) + 1_000_000 for c in v]


def check(rows, out, components=16):
    """Holds a result against a dense eigendecomposition of the fit list's covariance."""
    x = {i: grid(v) for i, v in rows if usable(v)}
    if not x:
        assert not out
        return 0
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), [sum(c) for c in fit.T.tolist()]
    centred = (fit - 1_000_000) - np.array([float(Fraction(s, n) - 1_000_000) for s in sums])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, np.linalg.matrix_rank(centred, tol=1e-9 * np.linalg.norm(centred))) if centred.any() else 0
    got = {}
    for r in out:
        got.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
    assert set(got) == (set(x) if k else set()) and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    ids = sorted(got)
    own = np.array([[c - 1_000_000 for c in x[i]] for i in ids]) - np.array([float(Fraction(s, n) - 1_000_000) for s in sums]) if ids else None
    for j in range(k):
        want = own @ vectors[:, j] / math.sqrt(e[j])
        have = np.array([got[i][j + 1].whitened for i in ids])
        gap = min(abs(e[j] - e[i]) for i in (j - 1, j + 1) if 0 <= i < len(e)) / e[0] if len(e) > 1 else 1
        if gap > 1e-6:
            assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9 / gap * max(1, np.abs(want).max())
    return k


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_query_equals_a_dense_decomposition(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = queries.op12_embedding_whitening(spark, sf_dir)
    assert df.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                         ("explained", "double"), ("identity_error", "double")]
    assert check(rows, df.collect()) == 16


def test_unusable_vectors_repeats_ties_null_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    rows = good + [(50, good[3][1]), (51, good[3][1]), (52, None), (53, []), (54, [1.0, None, 1.0, 1.0, 1.0]),
                   (55, [1.0, float("nan"), 0.0, 0.0, 0.0]), (56, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, good[4][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, whitened string")
    out = whitened(df).collect()
    assert check([r for r in rows if r[0] is not None], [r for r in out if r.vec_id is not None]) == 5
    assert sorted(r.component for r in out if r.vec_id is None) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("rows,k", [
    ([], 0), ([(1, [0.5, 0.5])], 0), ([(i, [0.5, 0.25]) for i in range(30)], 0),
    ([(1, [0.0, 1.0]), (2, [1.0, 0.0])], 1),                                           # rank one
    ([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], 1),
    ([(i, np.eye(6)[i].tolist()) for i in range(6)], 5),                               # all eigenvalues equal
    ([(i, (np.eye(20)[i // 2] * (1 if i % 2 else -1)).tolist()) for i in range(40)], 16),
    ([(i, [float(i)]) for i in range(4)], 1)])
def test_poor_ranks_and_equal_eigenvalues(spark, rows, k):
    assert check(rows, whitened(frame(spark, rows)).collect()) == k


def test_vectors_of_other_lengths_are_whitened_among_themselves(spark):
    rng = np.random.default_rng(2)
    short, long = ([(100 * d + i, rng.standard_normal(d).tolist()) for i in range(30)] for d in (3, 4))
    out = whitened(frame(spark, short + long)).collect()
    assert check(short, [r for r in out if r.vec_id < 400]) == 3 and check(long, [r for r in out if r.vec_id >= 400]) == 4


def dense(x):
    return lambda w: (x.T @ (x @ w), (x @ w) @ (x @ w))


@pytest.mark.parametrize("spread", [1.0, 1e2, 1e4])
def test_bidiagonalisation_to_double_precision(spread):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 48)) @ np.diag(np.geomspace(spread, 1, 48)) @ np.linalg.qr(rng.standard_normal((48, 48)))[0]
    s, v = bidiagonalised(dense(x), 48, 48)
    _, want, rows = np.linalg.svd(x, full_matrices=False)
    assert np.abs(s / want - 1)[:16].max() < 1e-10 and np.abs(v @ v.T - np.eye(48)).max() < 1e-12
    assert np.abs(np.abs((v * rows).sum(1)) - 1)[:16].max() < 1e-9


def test_fewer_steps_find_leading_components_of_wide_vectors():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((900, 300)) * np.r_[np.geomspace(90, 9, 16), np.full(284, 1.0)]
    s, _ = bidiagonalised(dense(x), 300, 64)
    assert len(s) == 64 and np.abs(s[:16] / np.linalg.svd(x)[1][:16] - 1).max() < 1e-10


def test_deviations_are_exact_or_null_beyond_a_long():
    x = np.array([[10 ** 6, -3], [0, 0]])
    assert deviations(x, 7, [5, -4]) == [(7 * 10 ** 6 - 5) ** 2 + (-21 + 4) ** 2, 25 + 16]
    assert deviations(x, 3000, [5, -4]) == [(3 * 10 ** 9 - 5) ** 2 + (-9000 + 4) ** 2, 25 + 16]
    assert deviations(x, 10 ** 4, [5, -4]) == [None, 25 + 16]


def test_far_entries_stay_defined(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 2.0])]
    out = whitened(frame(spark, rows)).collect()
    assert {r.component for r in out} >= {1} and all(math.isfinite(r.whitened) for r in out)
    assert all(r.deviation is None for r in out if r.vec_id != 2)
