"""FEAST against numpy's eigensolver, the query against a plain version."""

import math
import os

import numpy as np
import pytest

from orderlens.llm import queries, whitening

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")


def plain(rows, k=4):
    """{(position, component): (n, deviation, |whitened|, explained)} by numpy and exact integers."""
    good = [(i, v) for i, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    size = max((len(v) for _, v in good), default=0)
    x = [tuple(math.floor(256 * float(np.float32(e))) for e in v) + (0,) * (size - len(v)) for _, v in good]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    out = []
    if not n or not size:
        return out
    centred = (np.array(fit) * n - np.array(sums)) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    for (i, _), row in zip(good, x):
        exact = [n * a - s for a, s in zip(row, sums)]
        for j in range(min(k, size)):
            if values[j] > 1e-9 * max(values[0], 1e-300) and values[0] > 1e-12:
                white = (np.array(exact) / n) @ vectors[:, j] / math.sqrt(values[j])
                out.append((i, j + 1, n, sum(e * e for e in exact), abs(white), values[j] / values.sum()))
    return out


def same(got, want):
    tidy = lambda rows: sorted(((r[0] is None, r[0] or 0, *r[1:4], round(abs(r[4]), 7), round(r[5], 7)) for r in rows))
    a, b = tidy(got), tidy(want)
    assert len(a) == len(b)
    for p, q in zip(a, b):
        assert p[:5] == q[:5] and p[5:] == pytest.approx(q[5:], abs=1e-6)


def test_query(spark):
    got = [tuple(r) for r in queries.QUERIES["op13_whitening"](spark, FOLDER).collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert len(got) == 4 * len(rows)
    same(got, plain(rows))
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9
    signs = {}  # one sign a component for all rows
    values = {(r[0], r[1]): r[4] for r in got}
    for i, j, _, _, white, _ in [(r[0], r[1], *r[2:6]) for r in got]:
        signs.setdefault(j, []).append(white)
    w = np.array([[values[i, j] for j in range(1, 5)] for i, _ in rows])
    assert np.abs(w.T @ w / len(rows) - np.eye(4)).max() < 1e-9  # here all vectors are distinct


def test_odd_rows(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(e) for e in r.standard_normal(5)]) for i in range(40)]
    rows += [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, [1.0, 2.0]), (55, [])]
    rows += [(60 + i, rows[0][1]) for i in range(30)] + [(None, rows[1][1]), (None, rows[1][1]), (None, None), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, x string, n int, Component int").repartition(3)
    model = whitening.fit(df)
    got = whitening.whiten(df, model)
    assert got.columns == ["vec_id", "x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same([tuple(r)[:1] + tuple(r)[2:] for r in got.collect()], plain(rows))
    assert model.identity_error < 1e-9


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [0.0, 0.0, 0.0])],
    [(i, [float(i)]) for i in range(5)],
])
def test_few_vectors_and_low_rank(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    same([tuple(r) for r in whitening.whiten(df, whitening.fit(df)).collect()], plain(rows))


def test_deviation_is_exact_or_null(spark):
    rows = [(1, [3e9, 0.0]), (2, [0.0, 1.0]), (3, [3e9, 1.0]), (4, [3.0e9, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.deviation) for r in whitening.whiten(df, whitening.fit(df)).collect()}
    assert got == {(i, None) for i in range(1, 5)}  # (4 * 256 * 3e9 ...) ** 2 is beyond a long
    x = np.array([[2**40, 5], [-(2**40), 1]])
    assert whitening.deviations(x, 2, [0, 6]) == [None, None]
    assert whitening.deviations(np.array([[2**29, 5], [-(2**29), 1]]), 2, [0, 6]) == [2**60 + 16, 2**60 + 16]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 30, 64])
def test_feast_finds_every_eigenvalue(size):
    r = np.random.default_rng(size)
    spectra = [r.random(size) * 10, np.floor(r.random(size) * 3), np.exp(5 * r.standard_normal(size)), (np.arange(size) < size // 2) * 1.0, np.ones(size), np.zeros(size)]
    spectra.append(1 + 1e-7 * np.arange(size))
    for e in spectra:
        q = np.linalg.qr(r.standard_normal((size, size)))[0]
        v = q * e @ q.T
        v = (v + v.T) / 2
        for shift in (-0.5, 0.313, 4.21, 1e3):
            assert whitening.Inertia(v).above(shift) == (np.linalg.eigvalsh(v) > shift).sum()
        k = min(4, size)
        found = whitening.feast(v, k)
        assert np.abs(found.values[:k] - np.sort(e)[::-1][:k]).max() <= 1e-12 * max(1.0, e.max())
        assert np.abs(found.vectors.T @ found.vectors - np.eye(found.vectors.shape[1])).max() < 1e-12
        assert np.abs(v @ found.vectors - found.vectors * found.values).max() <= 1e-12 * max(1.0, e.max())


def test_a_block_that_is_too_small_grows():
    """A first block as wide as the interval's count may miss eigenvalues; the inertia count shows it."""
    e = np.r_[np.full(20, 5.0), np.arange(20) / 10]
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((40, 40)))[0]
    found = whitening.feast(q * e @ q.T, 4)
    assert found.inside == 20 and np.allclose(found.values, 5.0)
