"""Whitening against numpy's own covariance, and exact sums against fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest

from filmgrain.llm import queries, whitening


def frame(spark, vectors, extra=False):
    rows = [(i, v, *([7] if extra else [])) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>" + (", x long" if extra else ""))


def by_hand(vectors):
    """(x, n, S, eigenvalues, components, trace) with every vector once in the fit."""
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    once = np.unique(x, axis=0)
    cov = np.cov(once.T.astype(float), bias=True)
    e, v = np.linalg.eigh(np.atleast_2d(cov))
    return x, len(once), once.sum(axis=0), e[::-1], v[:, ::-1], float(np.trace(np.atleast_2d(cov)))


def check(rows, ids, vectors, most=4):
    x, n, s, e, v, trace = by_hand(vectors)
    rows = {(r.vec_id, r.component): r for r in rows}
    assert set(rows) == {(i, c + 1) for i in ids for c in range(min(most, x.shape[1]))}
    for c in range(min(most, x.shape[1])):
        want = (x - s / n) @ v[:, c] / math.sqrt(e[c])
        got = np.array([rows[i, c + 1].whitened for i in ids])
        assert min(abs(got - want).max(), abs(got + want).max()) < 1e-6
    for k, i in enumerate(ids):
        for c in range(min(most, x.shape[1])):
            r = rows[i, c + 1]
            assert (r.n, r.deviation) == (n, sum(int(n * a - b) ** 2 for a, b in zip(x[k].tolist(), s.tolist())))
            assert abs(r.explained - e[c] / trace) < 1e-9 and r.identity_error < 1e-9


def test_query(spark, folder):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    check(queries.op13_polarised_whitening(spark, folder).collect(), list(vectors), list(vectors.values()))


def test_bad_rows_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(60, 6)) * [4, 3, 2, 1, .5, .2]
    vectors = [*good.tolist(), *good[:25].tolist(), None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [math.nan] * 6, [math.inf] * 6, [1e300] * 6]
    rows = whitening.whiten(frame(spark, vectors, extra=True)).collect()
    check(rows, list(range(85)), vectors[:85])
    assert len({r.n for r in rows}) == 1 and rows[0].n == len(np.unique(np.floor(256 * good), axis=0))
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [None, []])).collect() == []


def test_widths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(2)
    wide, slim = rng.normal(size=(40, 5)).tolist(), rng.normal(size=(30, 2)).tolist()
    rows = whitening.whiten(frame(spark, wide + slim)).collect()
    check([r for r in rows if r.vec_id < 40], range(40), wide)
    check([r for r in rows if r.vec_id >= 40], range(40, 70), slim)


def test_components_without_variance_do_not_exist(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []
    line = [[float(i), 2.0 * i, 5.0] for i in range(9)]
    rows = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 9 and abs(rows[0].explained - 1) < 1e-12


def test_far_from_the_origin_sums_stay_exact(spark):
    """Entries whose squares no double and no long holds."""
    rng = np.random.default_rng(3)
    x = (rng.integers(0, 1000, size=(50, 3)) + [2**40, -2**44, 2**50])
    spaces = whitening.fit(frame(spark, (x / 256).tolist()))
    once = np.unique(x, axis=0).astype(object)
    n, s = len(once), once.sum(axis=0)
    want = [[Fraction(int(sum((n * a - s[i]) * (n * b - s[j]) for a, b in zip(once[:, i], once[:, j]))), n**3)
             for j in range(3)] for i in range(3)]
    values = np.linalg.eigh(np.array(want, dtype=float))[0][::-1]
    assert spaces[3].sums == tuple(s) and spaces[3].eigenvalues == pytest.approx(values, rel=1e-12)


def test_matrix_from_variances():
    x = np.random.default_rng(4).integers(-300, 300, size=(37, 4))
    n, s = len(x), x.sum(axis=0).tolist()
    q = whitening._squares(x, [n, *s])
    left = [v - n * whitening._near(v, n) for v in s]
    left += [left[a] + left[b] for a in range(4) for b in range(a + 1, 4)]
    exact = [n * int(a) - b * b for a, b in zip(q, left)]
    assert whitening.covariance(4, n, exact) == pytest.approx(np.cov(x.T, bias=True), rel=1e-12)
