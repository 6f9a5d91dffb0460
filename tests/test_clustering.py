from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import clustering, dtw
from tidemark.operators import near as near_


def slow_dtw(a, b, radius):
    if len(a) > len(b):
        a, b = b, a
    table = np.full((len(a) + 1, len(b) + 1), np.inf)
    table[0, 0] = 0
    for i in range(len(a)):
        for j in range(max(0, i - radius), min(len(b), i + len(b) - len(a) + radius + 1)):
            table[i + 1, j + 1] = (a[i] - b[j]) ** 2 + min(table[i, j], table[i, j + 1], table[i + 1, j])
    return float(np.sqrt(table[-1, -1]))


def frame(spark, arrays):
    return spark.createDataFrame([(i, [float(x) for x in a]) for i, a in enumerate(arrays)], "id long, v array<double>")


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(11)
    out = [np.round(rng.gamma(1.0, 10.0, size=rng.integers(28, 32)), 2) for _ in range(70)]
    return out + [out[0].copy(), out[0].copy(), np.zeros(31), np.zeros(28)]


@pytest.fixture(scope="module")
def distances(arrays):
    distinct = {}
    for i, a in enumerate(arrays):
        distinct.setdefault(tuple(a), i)
    ids = sorted(distinct.values())
    return ids, {(i, j): slow_dtw(arrays[i], arrays[j], 3) for i in ids for j in ids if i != j}


def test_hand_worked_distances():
    one = np.array([[0.0, 0, 1]]), np.array([[0.0, 1, 1]])
    assert dtw.dtw_rows(*one, 1)[0] == 0
    for radius in (0, 1):
        assert dtw.dtw_rows(np.array([[0.0, 0]]), np.array([[1.0, 2]]), radius)[0] == pytest.approx(2.236068, abs=1e-6)


def test_distance_properties():
    rng = np.random.default_rng(2)
    a, b = rng.random((40, 29)), rng.random((40, 31))
    d = dtw.dtw_rows(a, b, 3)
    np.testing.assert_allclose(d, dtw.dtw_rows(b, a, 3))
    np.testing.assert_allclose(d, [slow_dtw(x, y, 3) for x, y in zip(a, b)])
    assert (np.diag(dtw.lower_bounds(a, b, 3)) <= d + 1e-12).all()
    c = rng.random((40, 29))
    np.testing.assert_allclose(dtw.dtw_rows(a, c, 0), np.sqrt(((a - c) ** 2).sum(axis=1)))
    assert (dtw.dtw_rows(a, a, 3) == 0).all()


@pytest.mark.parametrize("block", [4, 128])
def test_pairs_equal_brute_force(spark, arrays, distances, monkeypatch, block):
    monkeypatch.setattr(near_, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_, "TOP", block)  # small blocks have levels above them
    ids, table = distances
    distinct = dtw.distinct_sequences(frame(spark, arrays), "id", "v")
    assert sorted(r.seq_id for r in distinct.collect()) == ids
    found = {(r.i, r.j): r.dist for r in dtw.pairs_within(distinct, 45.0).collect()}
    expected = {p: d for p, d in table.items() if p[0] < p[1] and d <= 45.0}
    assert found.keys() == expected.keys() and len(found) > 20
    assert max(abs(found[p] - expected[p]) for p in found) < 1e-9


@pytest.mark.parametrize("k, block", [(3, 4), (3, 128), (100, 8)])
def test_nearest_equal_brute_force(spark, arrays, distances, monkeypatch, k, block):
    monkeypatch.setattr(near_, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_, "TOP", block)
    ids, table = distances
    distinct = dtw.distinct_sequences(frame(spark, arrays), "id", "v")
    got = {}
    for r in dtw.nearest_sequences(distinct, k).collect():
        got.setdefault(r.i, []).append((r.pos, r.j))
    for i in ids:
        expected = [j for _, j in sorted((table[i, j], j) for j in ids if j != i)[:k]]
        assert [j for _, j in sorted(got[i])] == expected


def test_copies_keep_their_members(spark, arrays):
    df = frame(spark, arrays)
    distinct = dtw.distinct_sequences(df, "id", "v")
    assert distinct.where("seq_id = 0").first()["copies"] == 3
    assert rows(dtw.members(df, "id", "v", distinct).where("seq_id = 0"), "id") == [(0,), (70,), (71,)]


def test_pairs_stay_inside_their_group(spark):
    df = spark.createDataFrame(
        [("a", 1, [1.0]), ("a", 2, [1.5]), ("b", 3, [1.2]), ("b", 4, [9.0])], "g string, id long, v array<double>"
    )
    distinct = dtw.distinct_sequences(df, "id", "v", ["g"])
    assert rows(dtw.pairs_within(distinct, 1.0, groups=["g"]), "g", "i", "j") == [("a", 1, 2)]


def test_landmark_scaling_keeps_euclidean_distances(spark):
    rng = np.random.default_rng(4)
    points = rng.random((30, 3)) * 10
    seqs = frame(spark, points).select(F.col("id").alias("seq_id"), F.col("v").alias("values"))
    placed = {r.seq_id: np.array(r.position) for r in clustering.landmark_scaling(seqs, 3, 12, radius=0).collect()}
    for i in range(0, 30, 3):
        for j in range(30):
            assert np.linalg.norm(placed[i] - placed[j]) == pytest.approx(np.linalg.norm(points[i] - points[j]), abs=1e-6)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 21), (21, 20), (4, 1)] + [(30 + i, 31 + i) for i in range(20)]
    got = dict(rows(clustering.connected_components(spark.createDataFrame(edges, "i long, j long"))))
    assert {got[n] for n in (1, 2, 3, 4)} == {1} and {got[n] for n in (10, 11, 12)} == {10}
    assert got[21] == 20 and got[50] == 30


def test_components_without_edges(spark):
    assert clustering.connected_components(spark.createDataFrame([], "i long, j long")).count() == 0


@pytest.mark.parametrize("block", [4, 128])
def test_dbscan_equals_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(near_, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_, "TOP", block)
    rng = np.random.default_rng(9)
    values = [round(float(v), 2) for v in np.concatenate([rng.normal(0, 1, 25), rng.normal(20, 1, 25), rng.uniform(-40, 60, 12)])]
    values += [77.0] * 5  # a group of copies is dense by itself
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, v array<double>")
    nodes = dtw.distinct_sequences(df, "id", "v")
    got = {r.seq_id: (r.label, r.is_core) for r in clustering.dbscan(nodes, 0.5, 5).collect()}
    near = {i: [j for j, w in enumerate(values) if abs(w - v) <= 0.5] for i, v in enumerate(values)}
    core = {i for i in near if len(near[i]) >= 5}
    label: dict[int, int] = {}
    for i in sorted(core):
        if i in label:
            continue
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in label:
                label[x] = i
                stack += [y for y in near[x] if y in core and y not in label]
    for i in got:
        expected = label.get(i, min((label[j] for j in near[i] if j in core), default=-1))
        assert got[i] == (expected, i in core)


def test_silhouette_of_four_points(spark):
    nodes = spark.createDataFrame([(i, [v], 1) for i, v in enumerate([0.0, 1.0, 10.0, 11.0])], "seq_id long, values array<double>, copies long")
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 1)], "seq_id long, label int")
    assert clustering.warping_silhouettes(nodes, {"x": labels}).first()["silhouette"] == pytest.approx(0.899749, abs=1e-6)


def test_scores_equal_their_definitions(spark):
    rng = np.random.default_rng(1)
    x = rng.random((60, 4)) + np.repeat(np.arange(3), 20)[:, None]
    label = np.repeat([0, 1, 2], 20)
    df = spark.createDataFrame([(int(c), [float(v) for v in r]) for c, r in zip(label, x)], "label int, f array<double>")
    squared = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(60):
        means = [squared[i, (label == c) & (np.arange(60) != i)].mean() for c in range(3)]
        a, b = means[label[i]], min(m for c, m in enumerate(means) if c != label[i])
        scores.append((b - a) / max(a, b))
    assert clustering.silhouette(df, "f", "label").first()[0] == pytest.approx(np.mean(scores), abs=1e-9)
    centres = np.array([x[label == c].mean(axis=0) for c in range(3)])
    between = sum(20 * ((m - x.mean(axis=0)) ** 2).sum() for m in centres)
    within = sum(((x[label == c] - centres[c]) ** 2).sum() for c in range(3))
    assert clustering.calinski_harabasz(df, "f", "label").first()[0] == pytest.approx((between / 2) / (within / 57))
    spread = [np.linalg.norm(x[label == c] - centres[c], axis=1).mean() for c in range(3)]
    worst = [max((spread[a] + spread[b]) / np.linalg.norm(centres[a] - centres[b]) for b in range(3) if b != a) for a in range(3)]
    assert clustering.davies_bouldin(df, "f", "label").first()[0] == pytest.approx(np.mean(worst))


def test_no_scores_with_noise_or_one_cluster(spark):
    df = spark.createDataFrame([(-1, [0.0]), (0, [1.0]), (0, [2.0])], "label int, f array<double>")
    alone = df.withColumn("label", F.lit(0))
    for r in clustering.evaluate_clusterings({"noise": df, "alone": alone}, "f").collect():
        assert np.isnan([r.silhouette, r.calinski_harabasz, r.davies_bouldin]).all()


def test_density_cut_drops_small_groups(spark):
    values = [0.0, 0.1, 0.2, 0.3, 0.4, 9.0, 9.1, 50.0]
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, v array<double>")
    nodes = dtw.distinct_sequences(df, "id", "v")
    nearest = dtw.nearest_sequences(nodes, 2)
    got = dict(rows(clustering.density_cut(nodes, dtw.pairs_within(nodes, 1.0), nearest, 1.0, 3)))
    assert [got[i] for i in range(8)] == [0, 0, 0, 0, 0, -1, -1, -1]


def test_far_sequences_are_neighbours_too(spark):
    """Two sequences 5e12 apart, and more neighbours asked for than landmarks or sequences exist."""
    df = spark.createDataFrame([(1, [0.0]), (2, [5e12])], "id long, v array<double>")
    found = dtw.nearest_sequences(dtw.distinct_sequences(df, "id", "v"), 2)
    assert rows(found, "i", "j", "dist") == [(1, 2, 5e12), (2, 1, 5e12)]
    many = spark.createDataFrame([(i, [float(i)]) for i in range(40)], "id long, v array<double>")
    assert dtw.nearest_sequences(dtw.distinct_sequences(many, "id", "v"), 600).count() == 40 * 39
    assert len(dtw.pick_landmarks(dtw.distinct_sequences(many, "id", "v"), 1000)) == 40


def test_copies_are_neighbours_of_every_key(spark):
    values = [0.0] * 5 + [3.0, 3.0, 4.0, 10.0, 11.5]
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, v array<double>")
    nodes = dtw.distinct_sequences(df, "id", "v")
    belongs = dtw.members(df, "id", "v", nodes)
    for k in (1, 3, 7):
        found = dtw.nearest_members(dtw.nearest_sequences(nodes, k), belongs, "id", k)
        want = []
        for i, v in enumerate(values):
            near = sorted((abs(v - w), j) for j, w in enumerate(values) if j != i)[:k]
            want += [(i, j, d, p + 1) for p, (d, j) in enumerate(near)]
        assert sorted(map(tuple, found.select("i", "j", "dist", "pos").collect())) == sorted(want)


def test_density_cut_counts_copies(spark):
    """Copies are neighbours at distance 0, so both nodes reach each other at 3."""
    df = spark.createDataFrame([(i, [v]) for i, v in enumerate([0.0] * 5 + [3.0])], "id long, v array<double>")
    nodes = dtw.distinct_sequences(df, "id", "v")
    nearest = dtw.nearest_sequences(nodes, 2)
    assert rows(clustering.core_distances(nodes, nearest), "i", "core") == [(0, 0.0), (5, 3.0)]
    labels = clustering.density_cut(nodes, dtw.pairs_within(nodes, 5.0), nearest, 5.0, 6)
    assert rows(dtw.label_members(labels, dtw.members(df, "id", "v", nodes), "id")) == [(i, 0) for i in range(6)]


def test_every_node_has_an_affinity_label(spark):
    pairs = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (5, 6, 1.0)], "i long, j long, dist double")
    nodes = spark.createDataFrame([(i, 1) for i in (0, 1, 2, 5, 6, 9)], "seq_id long, copies long")
    got = dict(rows(clustering.affinity_clusters(pairs, 2, nodes=nodes)))
    assert sorted(got) == [0, 1, 2, 5, 6, 9] and got[9] == -1 and min(got[i] for i in (0, 1, 2, 5, 6)) >= 0


def test_weights_move_the_centres(spark):
    df = spark.createDataFrame([(0, [0.0], 1), (1, [1.0], 9), (2, [50.0], 1)], "seq_id long, f array<double>, copies long")
    labelled = clustering.kmeans(df, "f", 2, weight="copies")
    assert len({r.label for r in labelled.collect()}) == 2
    assert clustering.bisecting_kmeans(df, "f", 2, weight="copies").count() == 3


def test_bounds_keep_far_blocks_apart(spark, monkeypatch):
    """Sequences around 20 shapes of two lengths: at most a tenth of the pairs of blocks is formed, and no pair is lost."""
    monkeypatch.setattr(near_, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_, "TOP", 8)
    rng = np.random.default_rng(3)
    shapes = [np.repeat(rng.uniform(0, 100, 8), 4)[: 28 + i % 2] for i in range(20)]
    arrays = [np.round(s + rng.normal(0, 0.5, len(s)), 3) for s in shapes for _ in range(60)]
    nodes = dtw.distinct_sequences(frame(spark, arrays), "id", "v")
    blocks = near_.Blocks(nodes, 3)
    every, formed = blocks.rows.count(), blocks.pairs(F.lit(6.0)).count()
    assert every >= 90 and formed <= every * (every + 1) / 2 / 10
    found = rows(dtw.pairs_within(nodes, 6.0), "i", "j")
    chosen = [(i, j) for i in range(0, 1200, 59) for j in range(1200) if i < j]
    near = [(i, j) for i, j in chosen if slow_dtw(arrays[i], arrays[j], 3) <= 6.0]
    assert len(near) > 50 and set(near) == {p for p in found if p[0] % 59 == 0}


def test_density_clusters_of_texts_and_gaps(spark):
    """Ids that are strings, no core at all, and no rows."""
    df = spark.createDataFrame([("b", [0.0]), ("a", [0.2]), ("c", [0.1]), ("z", [9.0])], "id string, v array<double>")
    nodes = dtw.distinct_sequences(df, "id", "v")
    assert rows(clustering.dbscan(nodes, 0.3, 3)) == [("a", "a", True), ("b", "a", True), ("c", "a", True), ("z", "-1", False)]
    assert rows(clustering.dbscan(nodes, 0.3, 9), "label") == [("-1",)] * 4
    assert clustering.dbscan(nodes.limit(0), 0.3, 3).count() == 0


def plain_linkage(table, k):
    groups = [[i] for i in range(len(table))]
    while len(groups) > k:
        mean = {(a, b): np.mean([table[i][j] for i in groups[a] for j in groups[b]]) for a in range(len(groups)) for b in range(a + 1, len(groups))}
        a, b = min(mean, key=lambda p: (mean[p], p))
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def test_average_linkage_equals_the_plain_tree(spark, arrays):
    """With all sequences as landmarks; with fewer, most pairs of sequences are judged alike."""
    df = frame(spark, arrays)
    nodes = dtw.distinct_sequences(df, "id", "v").cache()
    ids = sorted(r.seq_id for r in nodes.collect())
    every = [[slow_dtw(a, b, 3) for b in arrays] for a in arrays]
    weigh = [i for i, a in enumerate(arrays)]
    want = plain_linkage([[every[i][j] for j in weigh] for i in weigh], 4)
    full = clustering.landmark_features(nodes, 100, 3, ("seq_id", "copies"))
    got = {r.seq_id: r.label for r in clustering.hierarchical(full, len(ids), 4).collect()}
    groups = {}
    for r in dtw.label_members(spark.createDataFrame(list(got.items()), "seq_id long, label int"), dtw.members(df, "id", "v", nodes), "id").collect():
        groups.setdefault(r.label, set()).add(r.seq_id)
    assert {frozenset(g) for g in groups.values()} == want
    some = clustering.landmark_features(nodes, 40, 3, ("seq_id", "copies"))
    few = {r.seq_id: r.label for r in clustering.hierarchical(some, 40, 4).collect()}
    assert sorted(few) == ids and -1 not in few.values()
    pairs = [(i, j) for i in ids for j in ids if i < j]
    assert np.mean([(got[i] == got[j]) == (few[i] == few[j]) for i, j in pairs]) > 0.75


def test_warping_silhouette_equals_its_definition(spark, arrays, monkeypatch):
    monkeypatch.setattr(near_, "BLOCK_ROWS", 8)
    df = frame(spark, arrays)
    nodes = dtw.distinct_sequences(df, "id", "v").cache()
    label = [i % 3 if i < 70 else 0 for i in range(len(arrays))]
    given = spark.createDataFrame([(i, label[i]) for i in range(len(arrays))], "seq_id long, label int")
    one, noisy = given.withColumn("label", F.lit(7)), given.withColumn("label", F.col("label") - 1)
    # copies of a sequence have its label
    for i, j in ((70, 0), (71, 0)):
        label[i] = label[j]
    apart = [[slow_dtw(a, b, 3) for b in arrays] for a in arrays]
    scores = []
    for i in range(len(arrays)):
        means = {c: np.mean([apart[i][j] for j in range(len(arrays)) if label[j] == c and j != i]) for c in range(3)}
        a, b = means[label[i]], min(m for c, m in means.items() if c != label[i])
        scores.append((b - a) / max(a, b))
    got = dict(rows(clustering.warping_silhouettes(nodes, {"given": given, "one": one, "noisy": noisy})))
    assert got["given"] == pytest.approx(np.mean(scores), abs=1e-9) and np.isnan(got["one"]) and np.isnan(got["noisy"])


def test_scores_with_many_blocks_of_centres(spark, monkeypatch):
    from tidemark.operators import validity

    rng = np.random.default_rng(6)
    data = [(int(c), [float(v) for v in rng.normal(c % 17, 1, 3)]) for c in rng.integers(0, 60, 400)]
    df = spark.createDataFrame(data, "label int, f array<double>")
    want = [clustering.silhouette(df, "f", "label").first()[0], clustering.davies_bouldin(df, "f", "label").first()[0]]
    monkeypatch.setattr(validity, "CENTRES", 7)
    got = [clustering.silhouette(df, "f", "label").first()[0], clustering.davies_bouldin(df, "f", "label").first()[0]]
    assert got == pytest.approx(want, abs=1e-9)
