"""Links of vectors against all pairs in double precision."""

import math

import numpy as np
import pytest

from tests.llm.helpers import collected
from tickroll.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold):
    def vector(v):
        good = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        return np.array(v, float) / np.abs(v).max() if good else None

    vectors, n = [vector(v) for _, v in rows], len(rows)
    near = [[False] * n for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and len(a) == len(b):
                near[i][j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(near[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((d, sum(near[i]), least, d is None or d == least))
    return sorted(out, key=repr)


def clusters(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(i, (centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0, .05, .2, .3])).tolist()) for i in range(n)]


ODD = [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] + [1.0] * 15), (304, [None] + [1.0] * 15), (305, [1.0, 2.0]),
       (306, [1e300, 2e300]), (307, [1e-300, 2e-300]), (None, [1.0, 2.0]), (308, [3.0, 4.0]), (308, [3.0, 4.0]), (309, [float("inf"), 1.0]),
       (None, [7.0]), (310, [-1.0]), (-4, [2.0]), (None, None)]


@pytest.mark.parametrize("cell, block", [(4096, 4096), (16, 8)])
def test_links_equal_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = clusters(200, 16) + ODD
    assert collected(embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows, .95)


def test_no_rows_and_clashing_columns(spark):
    assert collected(embedding_dedup.link_vectors(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, [1.0, 0.0], 1, 2.0), (2, [2.0, 0.0], None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell long, scale double")
    assert collected(embedding_dedup.link_vectors(df)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    u = rng.normal(size=(400, 24)) * rng.choice([1, 1, 30], size=(400, 24))
    u /= np.linalg.norm(u, axis=1)[:, None]
    coded = embedding_dedup.quantise(u)
    for threshold in (-.2, 0.0, .3, .9):
        found = {(int(a), int(b)) for i, j in embedding_dedup.possible(coded, coded, threshold) for a, b in zip(i, j)}
        real = {(int(a), int(b)) for a, b in zip(*np.nonzero(u @ u.T >= threshold))}
        assert real <= found
    assert len(found) < 40_000                          # and a high threshold does sieve


def test_long_vectors_multiply_exactly():
    rng = np.random.default_rng(4)
    q = rng.integers(-127, 128, (5, 5000)).astype(np.int8)
    assert (embedding_dedup.product(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()
