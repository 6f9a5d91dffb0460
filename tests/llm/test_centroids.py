"""Centroid clusters against a plain k-means over integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import centroids


def plain(rows, k, rounds, width=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    matrix = centroids.walsh(width)
    order = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), (matrix @ np.array(r[1])).tolist()),
    )
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups: dict = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, own in groups.items():
            centres[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia: dict = {}
    for _, d, n in found:
        inertia[n] = inertia.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in found), key=str)


NAMES = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_equals_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(centroids, "_ROWS", 50)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(64)]) for i in range(260)]
    rows += [rows[4], rows[4], (900, rows[8][1]), (None, rows[9][1]), (901, [0.0] * 64), (902, [-0.001] * 64), (903, None), (904, [1.0] * 63), (905, [])]
    rows += [(906, [None] + [1.0] * 63), (907, [float("nan")] * 64), (908, [float("inf")] + [0.0] * 63), (909, [30_000.0] * 64)]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string")
    for k in (7, 40):
        got = centroids.cluster(df, k, 3).select(*NAMES)
        assert sorted(map(tuple, got.repartition(3).collect()), key=str) == plain(rows, k, 3)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, centroids.cluster(df).select(*NAMES).collect()), key=str) == plain(rows, 40, 5)
    assert centroids.cluster(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>"))


def test_progressive_search_equals_all_distances():
    rng = np.random.default_rng(3)
    for width in (1, 2, 8, 64):
        matrix = centroids.walsh(width)
        assert (matrix @ matrix.T == width * np.eye(width)).all()
        changes = (np.diff(matrix, axis=1) != 0).sum(axis=1)
        assert changes.tolist() == list(range(width))
        rows, centres = rng.integers(-40, 40, (300, width)), rng.integers(-40, 40, (17, width))
        centres[5] = centres[3]  # ties go to the smaller number
        number, total = centroids.nearest_centroids(rows @ matrix.T, centres @ matrix.T)
        plain = ((rows[:, None] - centres[None]) ** 2).sum(axis=2)
        assert (number == plain.argmin(axis=1)).all() and (total == width * plain.min(axis=1)).all()
    with pytest.raises(ValueError):
        centroids.walsh(48)
