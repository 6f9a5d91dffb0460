"""The density tree against a plain implementation on points of the plane with copies."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import clustering, dtw, near, tree


def plain_tree(points, copies, core):
    """Kruskal's tree of mutual reachability: ((w, lo, hi), left, right, size) nodes over the numbers of points."""
    n = len(points)
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    reach = np.maximum(np.maximum(apart, core[:, None]), core[None, :])
    edges = sorted((reach[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    of, top, taken = list(range(n)), list(range(n)), []
    sizes = list(copies)
    nodes = [None] * n

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    for w, i, j in edges:
        a, b = root(i), root(j)
        if a != b:
            taken.append((i, j, w))
            nodes.append((w, top[a], top[b]))
            sizes.append(sizes[top[a]] + sizes[top[b]])
            of[b] = a
            top[a] = len(nodes) - 1
    return taken, nodes, sizes


def plain_labels(nodes, sizes, core, least):
    n = len(core)
    density = lambda d: 1 / max(d, tree.LEAST)

    def below(node):
        return [node] if node < n else below(nodes[node][1]) + below(nodes[node][2])

    def judged(node, born):
        """(stability, chosen nodes with their best sums) of the cluster that begins at a node."""
        mass, start, inside = 0.0, node, []
        while True:
            if node < n:
                mass += sizes[node] * density(core[node])
                break
            w, *sides = nodes[node]
            large = [s for s in sides if sizes[s] >= least]
            if len(large) != 1:
                mass += sizes[node] * density(w)
                inside = [judged(s, density(w)) for s in large]
                break
            mass += (sizes[node] - sizes[large[0]]) * density(w)
            node = large[0]
        stability, best = mass - sizes[start] * born, sum(s for s, _ in inside)
        if start != len(nodes) - 1 and stability >= best:
            return stability, [start]
        return best, [c for _, chosen in inside for c in chosen]

    labels = [-1] * n
    for start in judged(len(nodes) - 1, 0.0)[1]:
        members = below(start)
        for i in members:
            labels[i] = min(members)
    return labels


def clusters_of(points, copies, k, least):
    spread = np.repeat(points, copies, axis=0)
    owner = np.repeat(np.arange(len(points)), copies)
    apart = np.sqrt(((points[:, None] - spread[None]) ** 2).sum(axis=2))
    core = np.array([np.sort(np.delete(apart[i], np.flatnonzero(owner == i)[0]))[k - 1] for i in range(len(points))])
    taken, nodes, sizes = plain_tree(points, copies, core)
    return taken, core, plain_labels(nodes, sizes, core, least)


def made(seed):
    rng = np.random.default_rng(seed)
    groups = [rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 1.0, 60), ((9, 0), 0.5, 50), ((9, 3), 0.5, 40), ((0, 14), 2.0, 70))]
    points = np.round(np.concatenate([*groups, rng.uniform(-10, 25, (60, 2))]), 2)
    points = points[np.sort(np.unique(points, axis=0, return_index=True)[1])]
    return points, np.where(np.arange(len(points)) % 13 == 0, 3, 1) + np.where(np.arange(len(points)) == 40, 6, 0)


@pytest.mark.parametrize("seed, block", [(1, 16), (7, 128)])
def test_density_tree_equals_the_plain_one(spark, monkeypatch, seed, block):
    monkeypatch.setattr(near, "BLOCK_ROWS", block)
    points, copies = made(seed)
    taken, core, want = clusters_of(points, copies, 4, 5)
    data = [(i, [float(x) for x in p], int(c)) for i, (p, c) in enumerate(zip(points, copies))]
    nodes = spark.createDataFrame(data, "seq_id long, values array<double>, copies long").cache()
    nearest = dtw.nearest_sequences(nodes, 4, radius=0).cache()
    cores = clustering.core_distances(nodes, nearest).cache()
    assert {r.i: r.core for r in cores.collect()} == pytest.approx(dict(enumerate(core.tolist())))
    edges = tree.spanning_tree(nodes, cores, nearest.select("i", "j", "dist"), radius=0)
    found = sorted((r.lo, r.hi, r.w) for r in edges.collect())
    assert [e[:2] for e in found] == [e[:2] for e in sorted(taken)]
    assert [e[2] for e in found] == pytest.approx([e[2] for e in sorted(taken)])
    vertices = nodes.join(cores.withColumnRenamed("i", "seq_id"), "seq_id").select("seq_id", "copies", "core")
    got = dict(rows(tree.density_tree(vertices, edges, 5)))
    assert [got[i] for i in range(len(points))] == want
    assert len(set(want)) >= 4 and want.count(-1) > 5


def test_a_chain_and_too_few_points(spark):
    """Edges in ascending order along a chain, and tables without clusters or edges."""
    n = 40
    edges = spark.createDataFrame([(i, i + 1, 1.0 + i / 100) for i in range(n)], "lo long, hi long, w double")
    vertices = spark.createDataFrame([(i, 1, 0.5) for i in range(n + 1)], "seq_id long, copies long, core double")
    chained, _, first = tree.dendrogram(edges, vertices)
    sizes = sorted((r.e.w, r["size"]) for r in chained.collect())
    assert [s for _, s in sizes] == list(range(2, n + 2)) and first.count() == n + 1
    assert rows(tree.density_tree(vertices, edges), "label") == [(-1,)] * (n + 1)
    none = tree.density_tree(vertices.limit(1), edges.limit(0))
    assert rows(none, "label") == [(-1,)]
    apart = edges.withColumn("w", F.when(F.col("lo") == 20, 9.0).otherwise(F.col("w")))
    got = dict(rows(tree.density_tree(vertices, apart)))
    assert {got[i] for i in range(21)} == {0} and {got[i] for i in range(21, n + 1)} == {21}
