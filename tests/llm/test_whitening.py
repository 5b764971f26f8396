"""Whitening against numpy's eigenvectors and exact integers."""

import numpy as np
import pytest

from tests.llm.helpers import SF, rows as table_rows
from tickroll.llm import whitening
from tickroll.llm.catalog import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def plain(vectors, count=8):
    """(ids, whitened, deviation, explained) of usable vectors of one length."""
    ids, x = [d for d, _ in vectors], np.floor(np.array([v for _, v in vectors], float) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    centred = x - np.array(sums) / n
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:count], basis[:, ::-1][:, :count]
    return ids, centred @ (basis / np.sqrt(values)), [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x], values / np.trace(v)


def compare(found, vectors, count=8):
    ids, whitened, deviation, explained = plain(vectors, count)
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(by) == sorted(ids) and len(found) == len(ids) * count
    got = np.array([[by[d][c + 1]["whitened"] for c in range(count)] for d in ids])
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * sign - whitened).max() < 1e-8
    for i, d in enumerate(ids):
        for c in range(count):
            r = by[d][c + 1]
            assert r["deviation"] == deviation[i] and r["n"] == len(ids)
            assert abs(r["explained"] - explained[c]) < 1e-10 and r["identity_error"] < 1e-9


def test_query_equals_numpy(spark):
    compare(QUERIES["op12_whitening"](spark, SF).collect(), table_rows("embeddings", "vec_id", "embedding"))


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, (rng.normal(size=4) * [5, 3, 2, 1]).tolist()) for i in range(50)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [float("nan")] * 4), (94, [float("inf"), 0.0, 0.0, 0.0]),
           (95, [1e300] * 4), (96, [1.0, 2.0]), (97, [2.0, 2.5])]
    df = spark.createDataFrame([(d, v, 7) for d, v in good + odd], SCHEMA + ", n long")
    compare(whitening.whiten(df, count=4).collect(), good, 4)
    repeated = spark.createDataFrame([*good, *good[:3], (None, good[0][1])], SCHEMA)
    found = whitening.whiten(repeated, count=2).collect()
    assert len(found) == 2 * 54 and sum(r["vec_id"] is None for r in found) == 2 and {r["n"] for r in found} == {54}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_scale(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_fewer_components_than_asked_for(spark):
    rows = [(i, [float(i), 0.5, float(-i)]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in found)


def test_deviations_of_large_numbers_are_exact():
    x = np.array([[2**40, -5], [3, 2**41], [7, 9]], np.int64)
    sums, n = [int(s) for s in x.sum(axis=0)], 10**9
    y = x - np.array([s // n for s in sums])
    assert whitening.deviations(y, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]


def matrices():
    rng = np.random.default_rng(1)
    turn = lambda n: np.linalg.qr(rng.normal(size=(n, n)))[0]
    q = turn(40)
    yield np.cov(rng.normal(size=(300, 64)).T)
    yield np.diag([-1.0, 0, 1])
    yield np.diag([1.0, 1, 1, 2, 2, 0, 0])
    yield np.ones((6, 6))
    yield np.eye(5)
    yield np.zeros((3, 3))
    yield (q * np.r_[1, 1 + 1e-9, 1 - 1e-9, np.zeros(37)]) @ q.T
    yield (q * np.logspace(0, -14, 40)) @ q.T


@pytest.mark.parametrize("v", list(matrices()))
def test_spectrum(v):
    values, basis = whitening.spectrum(v, 8)
    if not v.any():
        assert not len(values)
        return
    size = np.linalg.norm(v)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:8]).max() < 1e-13 * size
    assert np.linalg.norm(v @ basis - basis * values) < 1e-12 * size
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-13
