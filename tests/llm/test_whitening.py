"""Whitening against numpy's symmetric eigensolver and plain integers."""

import math

import numpy as np
import pytest

from turnloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, component string, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "c", "x") for i, v in vectors], SCHEMA)


def plain(vectors, top):
    """The rows by Python integers and ``eigh``."""
    rows = []
    for i, v in vectors:
        if v is not None and v and all(c is not None and math.isfinite(c) for c in v):
            rows.append((i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)))
    fit = sorted({x for _, x in rows})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    y = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:top], u[:, ::-1][:, :top]
    out = []
    for i, x in rows:
        c = [n * a - b for a, b in zip(x, s)]
        z = (np.array([v / n for v in c]) @ u) / np.sqrt(np.maximum(e, 1e-300))
        out.append((i, n, sum(v * v for v in c), z))
    return out, e, e / np.trace(y.T @ y / n)


def check(spark, vectors, top=16):
    df = frame(spark, vectors)
    got = W.whiten(df, W.fit(df, components=top)).collect()
    want, e, share = plain(vectors, top)
    assert len(got) == len(want) * len(e)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
        assert r.identity_error < 1e-9
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
    for k, rows in by.items():
        a = sorted(((str(r.vec_id), r.n, r.deviation, r.whitened) for r in rows), key=lambda r: (r[0], r[2]))
        b = sorted(((str(i), n, dev, z[k - 1]) for i, n, dev, z in want), key=lambda r: (r[0], r[2]))
        assert [r[:3] for r in a] == [r[:3] for r in b]
        u, v = np.array([r[3] for r in a]), np.array([r[3] for r in b])
        assert np.abs(u - np.sign(u @ v) * v).max() < 1e-6
    return got


def random_vectors(seed=1, n=300, d=24):
    rng = np.random.default_rng(seed)
    return [(i, v) for i, v in enumerate((rng.standard_normal((n, d)) * np.linspace(3, 0.5, d)).tolist())]


def test_against_eigh(spark):
    v = random_vectors()
    v += [v[3], v[3], (900, v[5][1]), (None, v[6][1])]  # repeats count once in the fit
    bad = [(901, None), (902, [None] + v[0][1][1:]), (903, [float("nan")] + v[0][1][1:]), (904, [float("inf")] + v[0][1][1:]), (905, [])]
    check(spark, v + bad)


def test_fewer_dimensions_than_components(spark):
    got = check(spark, random_vectors(2, 60, 5))
    assert {r.component for r in got} == {1, 2, 3, 4, 5}


def test_low_rank_one_vector_and_no_rows(spark):
    line = [(i, [i * 1.0, i * 2.0, -i * 1.0]) for i in range(20)]
    assert {r.component for r in W.whiten(frame(spark, line), W.fit(frame(spark, line))).collect()} == {1}
    for v in ([(1, [1.0, 2.0])] * 3, [(1, None)], []):
        df = frame(spark, v)
        assert W.whiten(df, W.fit(df)).collect() == []


def test_lengths_are_spaces_of_their_own(spark):
    a, b = random_vectors(3, 50, 4), random_vectors(4, 40, 7)
    df = frame(spark, a + [(1000 + i, v) for i, v in b])
    got = W.whiten(df, W.fit(df)).collect()
    assert {(r.component, r.n) for r in got if r.vec_id < 1000} == {(k, 50) for k in range(1, 5)}
    assert {(r.component, r.n) for r in got if r.vec_id >= 1000} == {(k, 40) for k in range(1, 8)}


def test_large_entries_stay_exact(spark):
    v = random_vectors(5, 30, 4) + [(500, [1e10, -1e9, 3.0, 0.0]), (501, [1e30, 0.0, 0.0, 0.0])]
    df = frame(spark, v)
    got = W.whiten(df, W.fit(df)).collect()
    assert {r.vec_id for r in got} == {*range(30), 500}
    want = {i: dev for i, _, dev, _ in plain([x for x in v if x[0] != 501], 4)[0]}
    assert all(int(r.deviation_wide) == want[r.vec_id] for r in got)
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_counts_and_pairs(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 40))
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = np.sort(rng.choice([rng.random(d) * 10, np.repeat(rng.random(d // 4 + 1), 4)[:d], 10.0 ** -np.arange(d)][seed % 3], d, replace=False))[::-1]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    true = np.linalg.eigvalsh(v)
    for s in rng.random(20) * e[0]:
        if np.abs(true - s).min() > 1e-10 * e[0]:
            assert W.count_above(v, s) == (true > s).sum()
    values, vectors = W.leading_eigenpairs(v, 16)
    assert np.abs(values - true[::-1][: len(values)]).max() < 1e-12 * e[0] * d
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12 * d
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * e[0] * d


def test_indefinite_blocks():
    """A zero diagonal needs pivots of two rows."""
    v = np.array([[0.0, 1, 2], [1, 0, 3], [2, 3, 0]])
    true = np.linalg.eigvalsh(v)
    assert [W.count_above(v, s) for s in (-5, -2.5, 0, 3, 6)] == [int((true > s).sum()) for s in (-5, -2.5, 0, 3, 6)]


def axes(far, near, d):
    """Both ways along each axis: the covariance is diagonal, its entries are the squares of ``far, near, near + 1, ...``, halved twice by ``d``."""
    return [[s * (far if j == 0 else near + j) / 64 if i == j else 0.0 for i in range(d)] for j in range(d) for s in (1, -1)]


@pytest.mark.parametrize("d, bits", [(8, 27), (12, 25)])
def test_eigenvalues_as_near_as_the_error_of_a_count(spark, d, bits):
    """One far vector makes the others' eigenvalues as near as counts can tell: "not found" and "not confirmed" before."""
    v = list(enumerate(axes(1 << bits, 1000, d)))
    got = W.whiten(frame(spark, v), W.fit(frame(spark, v))).collect()
    assert len(got) == 2 * d * d and {r.component for r in got} == set(range(1, d + 1))
    assert max(r.identity_error for r in got) < 1e-2
    want = [((1 << bits) ** 2) / d] + [(1000 + j) ** 2 / d for j in range(d - 1, 0, -1)]
    seen = {r.component: r.eigenvalue for r in got}
    assert max(abs(seen[k + 1] - e) for k, e in enumerate(want)) < 64 * d * 2.3e-16 * want[0]


@pytest.mark.parametrize("far", [1 << 20, 1 << 24, 1 << 27])
def test_chains_of_near_eigenvalues(far):
    """Orthogonal, whole and in order, however the eigenvalues fall between the counts."""
    for d, near, step in ((4, 300, 1), (8, 1000, 1), (12, 17, 2), (20, 1000, 2)):
        true = np.array([far**2] + [(near + step * j) ** 2 for j in range(d, 1, -1)]) / d
        values, vectors = W.leading_eigenpairs(np.diag(true[::-1]), 16)
        gap = 32 * d * np.finfo(float).eps * true[0]
        assert len(values) == min(16, (true > 4 * gap).sum())
        assert np.abs(values - true[: len(values)]).max() <= gap
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(np.diag(true[::-1]) @ vectors - vectors * values).max() <= 2 * gap


def test_deviations_of_many_vectors_need_no_python_integers():
    """2.3 million fit vectors: sums times n are beyond 64 bits, deviations are not."""
    rng = np.random.default_rng(8)
    for n, spread in ((2_300_000, 40), (2_300_000, 3_000_000), (1 << 50, 40)):
        x = 1_000_000 + rng.integers(-spread, spread, (50, 6))
        sums = [n * 1_000_003 - 7 * k - 1 for k in range(6)]
        y = x.astype(object) * n - np.array(sums, object)
        flat, dev = W.Fit(n, sums, np.ones(1), np.ones((6, 1)), 1.0).centred(x)
        assert dev == [sum(int(v) ** 2 for v in r) for r in y]
        assert (flat == np.array([float(v) / n for v in y.ravel()]).reshape(y.shape)).all()
    assert W._row_squares(np.full((2, 3), (1 << 50) + 1)) == [3 * ((1 << 50) + 1) ** 2] * 2
    assert W._row_squares(np.array([[-(1 << 49) + 3, (1 << 49) - 1]])) == [((1 << 49) - 3) ** 2 + ((1 << 49) - 1) ** 2]
    assert W._column_sums(np.full((70_000, 2), 1 << 46)).tolist() == [70_000 << 46] * 2
