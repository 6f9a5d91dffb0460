"""Nearest neighbours against a full distance matrix."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import neighbours
from tidemark.llm.neighbours import Block, bounds, distances, nearest


def brute(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault((i, tuple(v)), np.array(v, dtype=float))
    out = []
    for (q, qt), qv in good.items():
        if q not in queries:
            continue
        found = [
            (float(distances(qv[None, :], cv[None, :])[0]), c)
            for (c, ct), cv in good.items()
            if c != q and len(cv) == len(qv)
        ]
        out += [(q, rank + 1, c, d) for rank, (d, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows_of_block", [7, 4096])
def test_equals_brute_force(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(neighbours, "QUERY_ROWS", rows_of_block)
    monkeypatch.setattr(neighbours, "CANDIDATE_ROWS", rows_of_block)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).astype("f4").tolist()) for i in range(60)]
    rows += [(60 + i, rows[5][1]) for i in range(15)]  # ties
    rows += [(90, [0.0] * 6), (91, None), (92, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (93, [float("nan")] * 6), (94, [float("inf")] + [0.0] * 5)]
    rows += [(95, [1.0, 2.0]), (100, [1.0, 2.5]), (None, rows[0][1]), rows[3], (96, [1e-320] * 6), (97, [1e30] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int")
    got = nearest(df, df.where("vec_id % 10 = 0"), 4)
    assert sorted(map(tuple, got.collect())) == brute(rows, set(range(0, 200, 10)), 4)


def test_empty_sides(spark):
    some = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    none = some.limit(0)
    assert nearest(some, none, 3).count() == 0
    assert nearest(none, some, 3).count() == 0
    assert [tuple(r) for r in nearest(some, some.where("vec_id = 1"), 3).collect()] == [(1, 1, 2, 1.0)]


def test_bounds_hold():
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(30, 16)) * 10.0 ** rng.integers(-3, 4, size=(30, 1)), rng.normal(size=(40, 16))
    low, high = bounds(Block(np.arange(30), a), Block(np.arange(40), b))
    exact = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    assert (low <= exact).all() and (exact <= high).all()
