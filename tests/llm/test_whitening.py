import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelkit.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, component int, n bigint, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x")
                                  for i, v in vectors], SCHEMA)


def expected(vectors, count=4):
    """The contract by numpy's eigenvalues and Python's whole numbers."""
    good = [(i, [int(np.floor(float(np.float32(c)) * 256)) for c in v]) for i, v in vectors
            if v and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), object)
    n, s = len(fit), fit.sum(0)
    c = (fit - s / n).astype(float)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:count], v[:, ::-1][:, :count]
    share = e / np.trace(c.T @ c / n)
    return n, {i: (int(sum((n * np.array(x, object) - s) ** 2)), (np.array(x, float) - (s / n).astype(float)) @ v / np.sqrt(e))
               for i, x in good}, share


def check(df, vectors, count=4):
    n, want, share = expected(vectors, count)
    rows = df.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, k) for i in want for k in range(1, count + 1))
    signs = {}
    for r in rows:
        deviation, white = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
        k = r.component - 1
        if abs(white[k]) > 1e-6:
            signs.setdefault(k, set()).add(bool(np.sign(white[k]) == np.sign(r.whitened)))
        assert abs(abs(r.whitened) - abs(white[k])) < 1e-7 * max(1, abs(white[k]))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=12) * np.linspace(3, .4, 12)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(200)]                            # copies count once
    check(w.whiten(frame(spark, rows).repartition(7)), rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    odd = [(50, None), (51, []), (52, [None] + [1.] * 5), (53, [float("nan")] + [1.] * 5), (54, [float("inf")] * 6), (55, [0.] * 6), (55, [-0.] * 6)]
    got = w.whiten(frame(spark, rows + odd + [(56, [1., 2.]), (None, rows[0][1])]))
    ids = {r.vec_id for r in got.collect()}
    assert ids == {*range(40), 55, None} and got.count() == 4 * 43
    zero = {r.whitened for r in got.where("vec_id = 55 and component = 1").collect()}
    assert len(zero) == 1


@pytest.mark.parametrize("rows, k", [([], 0), ([(1, [1., 2.])], 0), ([(1, [1., 2.]), (2, [1., 2.])], 0),
                                     ([(1, [1., 2.]), (2, [3., 2.])], 1), ([(1, [5.]), (2, [7.]), (3, [7.5])], 1)])
def test_few_vectors_have_few_components(spark, rows, k):
    got = w.whiten(frame(spark, rows)).collect()
    assert len(got) == k * len(rows)
    assert all(abs(r.identity_error) < 1e-9 for r in got)


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [3e38, 1.]), (2, [-3e38, 5.]), (3, [1e6, 2.]), (4, [1e5, 9.])]
    got = w.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got if r.deviation is None} and len({r.vec_id for r in got}) == 4
    far = [(i, [4e6 * (i % 3), 7e6 - i]) for i in range(2000)]
    n, want, _ = expected(far, 2)
    got = {r.vec_id: r.deviation for r in w.whiten(frame(spark, far)).where(F.col("component") == 1).collect()}
    assert got == {i: d if d < 2 ** 63 else None for i, (d, _) in want.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24])
def test_divide_and_conquer_against_eigh(n):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    for e in (rng.random(n), np.logspace(0, 9, n), np.ones(n), np.r_[np.full(n // 2, 5.), np.full(n - n // 2, 2.)], np.r_[1., np.zeros(n - 1)]):
        a = (q * e) @ q.T
        got, v = w.components(a, min(4, n))
        assert np.allclose(got, np.sort(e)[::-1][:4], rtol=1e-9, atol=1e-12 * e.max())
        assert np.abs(a @ v - v * got).max() < 1e-11 * e.max() and np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-12


def test_polar_factor():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(9, 9))
    u, _, v = np.linalg.svd(a)
    assert np.abs(w.qdwh(a) - u @ v).max() < 1e-11
