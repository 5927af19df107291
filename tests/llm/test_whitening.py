"""Whitening against numpy on the whole matrix, its sums against Python integers."""

import math
import random

import numpy as np
import pytest

from weekloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def rotation(d, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    return q


@pytest.mark.parametrize("d", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["spread", "equal", "close", "steep", "low rank"])
def test_eigenvectors_to_double_precision(d, kind):
    rng = np.random.default_rng(d)
    values = {
        "spread": rng.uniform(0, 1e6, d),
        "equal": np.repeat(rng.uniform(1, 9, d), 3)[:d],
        "close": 5 + 1e-9 * rng.uniform(size=d),
        "steep": 10.0 ** rng.uniform(-9, 6, d),
        "low rank": np.where(np.arange(d) % 2, 0, rng.uniform(1, 2, d)),
    }[kind]
    q = rotation(d, d)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.eigen(a)
    exact = vectors.astype(np.longdouble)
    top = np.abs(a).max()
    assert np.abs(a @ exact - exact * found).max() < 1e-15 * top
    assert np.abs(exact.T @ exact - np.eye(d)).max() < 1e-15
    assert np.abs(np.sort(values)[::-1] - found).max() < 1e-15 * max(values.max(), 1e-300)


def test_float32_alone_would_not_do():
    """A cluster that float32 cannot see is resolved."""
    d = 12
    q = rotation(d, 1)
    values = np.concatenate([1 + 1e-8 * np.arange(6), np.arange(2, 8)])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    off = rough.T @ a @ rough
    assert np.abs(off - np.diag(np.diag(off))).max() > 1e-9
    _, vectors = whitening.eigen(a)
    order = np.argsort(-values)
    agree = np.abs((vectors.astype(np.longdouble) * q[:, order]).sum(axis=0))
    # A gap of 1e-8 lets double matrices tell vectors to about 1e-8.
    assert (1 - agree < 1e-12).all()


def brute(rows, components=8):
    usable = [
        (i, v) for i, v in rows
        if v and all(c is not None and math.isfinite(c) and abs(c) < 2**43 for c in v)
    ]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in usable]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    deviation = [sum(c * c for c in r) for r in centred]
    cov = np.array(
        [[float(sum(r[i] * r[j] for r in centred)) / n**3 for j in range(d)] for i in range(d)]
    )
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = np.array([[c / n for c in r] for r in centred], float) @ vectors / np.sqrt(values)
    return usable, n, deviation, white[:, :components], values / values.sum()


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r.vec_id is None, r.vec_id, r.component))


@pytest.mark.parametrize("parts", [1, 6])
def test_against_numpy(spark, parts):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(j, 1 + j) for j in range(11)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]
    bad = [(2000, None), (2001, [None] + [1.0] * 10), (2002, [math.nan] * 11), (2003, [])]
    bad += [(2004, [math.inf] * 11), (2005, [-math.inf] * 11), (2006, [1e30] * 11)]
    bad += [(2007, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(parts)
    usable, n, deviation, white, shares = brute(rows)
    got = rows_of(whitening.whiten(df))
    assert len(got) == 8 * len(rows)
    signs = [np.sign(got[k].whitened * white[0, k]) for k in range(8)]
    for p, r in enumerate(got):
        i, k = divmod(p, 8)
        assert (r.vec_id, r.component, r.n) == (usable[i][0], k + 1, n)
        assert int(r.deviation) == deviation[i]
        assert r.whitened * signs[k] == pytest.approx(white[i, k], abs=1e-9)
        assert r.explained == pytest.approx(shares[k], rel=1e-12)
        assert 0 <= r.identity_error < 1e-12


def test_large_entries_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-(2**42), 2**42) for _ in range(3)]) for i in range(40)]
    got = rows_of(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    _, _, deviation, _, _ = brute(rows)
    assert [int(r.deviation) for r in got[::3]] == deviation
    assert got[0].identity_error < 1e-12


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, [0.0, 5.0])]
    df = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, VEC_ID string, n int"
    )
    got = rows_of(whitening.whiten(df))
    assert [r.vec_id for r in got] == [1, 1, 1, 1, 2, 2, None, None]
    assert {r.component for r in got} == {1, 2} and {r.n for r in got} == {4}


def test_no_variance_and_low_rank(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], SCHEMA)
    got = rows_of(whitening.whiten(same))
    assert len(got) == 15
    assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in got} == {
        (None, None, 0.0, 0)
    }
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], SCHEMA)
    got = rows_of(whitening.whiten(line))
    assert got[0].explained == pytest.approx(1) and got[0].identity_error < 1e-12
    assert [r.whitened is None for r in got[:3]] == [False, True, True]


def test_empty(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert whitening.whiten(nothing).collect() == []
