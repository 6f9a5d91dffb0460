"""Steps whose memory or time must not grow faster than their input."""

from __future__ import annotations

from conftest import rows

from tidemark.operators import quantiles


def test_rows_are_not_dealt_by_key_for_percentiles(spark, monkeypatch):
    """A table of few keys is broadcast from the start, so that no task sorts all rows of a key."""
    plans, written = [], quantiles.cut_lineage

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return written(df)

    monkeypatch.setattr(quantiles, "cut_lineage", noted)
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [(None, 1.0), (None, 2.0)], "k string, v double")
    assert rows(quantiles.percentiles(df, "v", [0.5], ["k"])) == [("a", [4.0]), (None, [1.5])]
    assert "BroadcastHashJoin" in plans[1] and "SortMergeJoin" not in plans[1]


def test_distances_to_landmarks_leave_a_task_in_parts(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    from tidemark.operators import dtw

    sizes = []

    def noted(a, b, radius):
        sizes.append(len(a))
        return np.sqrt(((a - b) ** 2).sum(axis=1))

    monkeypatch.setattr(dtw, "dtw_rows", noted)
    monkeypatch.setattr(dtw, "DISTANCES_AT_ONCE", 20)

    class Source:
        """Hands one batch of 30 rows to the function that measures them."""

        schema = ()

        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            return list(run(iter([pd.DataFrame({"seq_id": range(30), "values": [np.array([float(i)]) for i in range(30)]})])))

    parts = dtw.distances_to_landmarks(Source(), [(0, [0.0]), (1, [1.0])], 0)
    assert max(sizes) == 20 and [len(p) for p in parts] == [10, 10, 10]
    assert [d.tolist() for p in parts for d in p["distances"]] == [[float(i), abs(i - 1.0)] for i in range(30)]


def test_repeats_are_handed_to_python_by_group_of_keys(spark, tmp_path, monkeypatch):
    """Fewer groups than keys; keys beside null and above 2^53, and rows without an id."""
    from datetime import datetime, timedelta

    from tidemark.streaming import jobs

    monkeypatch.setattr(jobs, "BUCKETS", 2, raising=False)
    start, big = datetime(2024, 1, 1), (1 << 60) + 1
    data = [(big + i % 20 if i % 7 else None, i, start + timedelta(hours=i)) for i in range(120)]
    data += [(1, None, start), (1, 5, start), (1, 6, start + timedelta(hours=1))]
    schema = "k long, id long, ts timestamp_ntz"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.message_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    found = jobs.repeats(stream, "ts", "id", ["k"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "pmod(xxhash64(_k0" in plan
    jobs.finish(jobs.append_stream(found, str(tmp_path / "out"), str(tmp_path / "c")), 240)
    want, firsts = [], {}
    for k, i, ts in sorted(data, key=lambda r: (r[2], r[1] is None, r[1] or 0)):
        if k not in firsts or ts > firsts[k][1] + timedelta(days=1):
            firsts[k] = i, ts
        else:
            want.append((k, i, ts, *firsts[k]))
    got = rows(spark.read.schema(found.schema).parquet(str(tmp_path / "out")), "k", "id", "ts", "first_id", "first_ts")
    assert len(want) > 40 and got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_pairs_too_far_are_not_measured_in_double_precision(monkeypatch):
    """Cheap tests leave out most pairs and lose none, at the limit, with warping and without, and for large numbers."""
    import numpy as np

    from tidemark.operators import kernels

    rng, measure, doubles = np.random.default_rng(5), kernels.dtw_rows, []

    def noted(a, b, radius):
        doubles.append(len(a) if a.dtype == np.float64 else 0)
        return measure(a, b, radius)

    monkeypatch.setattr(kernels, "dtw_rows", noted)
    for radius, lengths, scale in [(0, (31, 31), 1.0), (3, (31, 31), 1.0), (3, (28, 31), 1.0), (0, (28, 31), 1.0), (0, (31, 31), 1e9), (3, (31, 31), 1e9), (3, (9, 9), 1e200)]:
        a, b = (scale * (1e4 + np.round(rng.gamma(1.0, 10.0, (60, n)), 2)) for n in lengths)
        i, j = (g.ravel() for g in np.indices((60, 60)))
        with np.errstate(over="ignore"):
            every = measure(a[i], b[j], radius).reshape(60, 60)
            limits = np.sort(every, axis=1)[:, 3]  # equal to a distance
            doubles.clear()
            found = [(p, q, d) for *pq, ds in kernels.close_pairs(a, b, limits, radius) for p, q, d in zip(*pq, ds)]
        assert {(p, q) for p, q, _ in found} == set(zip(*np.nonzero(every <= limits[:, None])))
        assert all(d == every[p, q] for p, q, d in found)
        if scale < 1e15:
            assert sum(doubles) < 400


def test_spectral_clusters_keep_pairs_in_their_table(spark, monkeypatch):
    """The power iteration equals one on the whole matrix; neither rows of pairs nor a graph in memory are asked for."""
    import numpy as np

    from tidemark.operators import clustering, dtw
    from tidemark.operators import near as near_

    monkeypatch.setattr(near_, "BLOCK_ROWS", 8)
    monkeypatch.setattr(clustering, "BLOCKS_AT_ONCE", 2)
    rng = np.random.default_rng(3)
    centres = np.repeat([0.0, 30.0], 30)[:, None]
    values = np.vstack([np.round(centres + rng.normal(size=(60, 5)), 3), [[500.0] * 5]])
    copies = [1 + i % 3 for i in range(61)]
    nodes = spark.createDataFrame(
        [(i, v.tolist(), c) for i, (v, c) in enumerate(zip(values, copies))] + [(None, [0.0] * 5, 1)], "seq_id long, values array<double>, copies long"
    )
    pairs, blocks = dtw.pairs_in_blocks(nodes, 80.0, 1)
    flat = {}
    ids = {b.block: b.seq_id for b in blocks.collect()}
    for row in pairs.collect():
        for p, q, d in zip(*near_.unpacked(row)):
            flat[tuple(sorted((ids[row.a][p], ids[row.b][q])))] = d
    assert flat == {(r.i, r.j): r.dist for r in dtw.pairs_within(nodes.where("seq_id IS NOT NULL"), 80.0, 1).collect()}
    assert rows(dtw.pairs_of_blocks(pairs, blocks, 4.0)) == rows(dtw.pairs_within(nodes.where("seq_id IS NOT NULL"), 4.0, 1))
    weights, width = np.zeros((61, 61)), np.mean(list(flat.values()))
    for (i, j), d in flat.items():
        weights[i, j] = weights[j, i] = np.exp(-((d / width) ** 2)) * copies[i] * copies[j]
    held = blocks.selectExpr("block", "copies", "transform(seq_id, x -> cast(x + 1 as double)) AS v")
    got = {(r.block, r.place): r.x for r in clustering._times(pairs, held, width).collect()}
    want = weights @ np.arange(1.0, 62.0)
    np.testing.assert_allclose([got.get((b, p), 0.0) for b, at in ids.items() for p in range(len(at))], [want[i] for at in ids.values() for i in at])
    found = dict(rows(clustering.affinity_of_blocks(pairs, blocks, 2)))
    assert found[60] == -1 and None not in found
    assert len({found[i] for i in range(30)}) == len({found[i] for i in range(30, 60)}) == 1 and found[0] != found[30]


def test_rows_without_an_allowed_partner_are_not_compared(monkeypatch):
    import numpy as np

    from tidemark.operators import kernels

    rng = np.random.default_rng(8)
    a, b = rng.gamma(1.0, 50.0, (20, 9)), rng.gamma(1.0, 50.0, (30, 9))
    allowed, bounds, sizes = np.zeros((20, 30), bool), kernels.lower_bounds, []
    allowed[3, [4, 9]] = allowed[17, 4] = True
    monkeypatch.setattr(kernels, "lower_bounds", lambda x, y, r: sizes.append((len(x), len(y))) or bounds(x, y, r))
    found = [(i, j, d) for part in kernels.close_pairs(a, b, np.full(20, 1e6), 2, allowed) for i, j, d in zip(*part)]
    assert [(i, j) for i, j, _ in found] == [(3, 4), (3, 9), (17, 4)] and sizes == [(2, 2)]
    assert [d for *_, d in found] == kernels.dtw_rows(a[[3, 3, 17]], b[[4, 9, 4]], 2).tolist()
    assert list(kernels.close_pairs(a, b, np.full(20, 1e6), 2, np.zeros((20, 30), bool))) == []


def test_blocks_of_one_cluster_are_not_compared_again(spark, monkeypatch):
    """Labels are the same when most pairs of blocks are linked after a first share, and fewer links are looked for."""
    import numpy as np

    from tidemark.operators import density, dtw
    from tidemark.operators import near as near_

    monkeypatch.setattr(near_, "BLOCK_ROWS", 8)
    monkeypatch.setattr(density, "EARLY_SHARE", 3)
    rng = np.random.default_rng(4)
    values = np.round(np.concatenate([rng.uniform(0, 1, 110), rng.uniform(3, 4, 30), rng.uniform(8, 9, 4), [20.0]]), 4)
    nodes = dtw.distinct_sequences(spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(values)], "id long, v array<double>"), "id", "v")
    asked, fetched = {}, near_.Blocks.fetched
    for most in (1000, 4):
        monkeypatch.setattr(density, "EARLY_BLOCKS", most)
        counts = asked[most] = []

        def noted(self, pairs, both, *columns, rows=None):
            if "part" in columns:
                counts.append(pairs.count())
            return fetched(self, pairs, both, *columns, rows=rows)

        monkeypatch.setattr(near_.Blocks, "fetched", noted)
        got = rows(density.dbscan(nodes, 0.9, 5, 0))
        if most == 1000:
            want = got
    assert got == want and len({label for _, label, _ in got}) >= 3
    assert len(asked[4]) == 2 and sum(asked[4]) < sum(asked[1000])


def test_a_density_cut_hands_on_few_links(spark, monkeypatch):
    """Links between nodes that are joined already are dropped where they are found; labels stay."""
    import numpy as np

    from tidemark.operators import clustering, components, dtw
    from tidemark.operators import near as near_

    monkeypatch.setattr(near_, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(5)
    values = np.round(np.concatenate([rng.uniform(0, 1, 150), rng.uniform(9, 10, 60), [30.0, 30.1, 50.0]]), 4).tolist()
    nodes = dtw.distinct_sequences(spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id long, v array<double>"), "id", "v").cache()
    handed, joined = [], clustering.connected_components

    def noted(edges):
        handed.append(edges.count())
        return joined(edges)

    monkeypatch.setattr(clustering, "connected_components", noted)
    nearest, pairs = dtw.nearest_sequences(nodes, 2, 0), dtw.pairs_within(nodes, 2.0, 0)
    got = {r.seq_id: r.label for r in clustering.density_cut(nodes, pairs, nearest, 2.0, 3).collect()}
    assert pairs.count() > 12_000 and handed[0] <= components.FORESTS * 212
    assert {got[i] for i, v in enumerate(values) if v < 1 and i in got} == {0}
    assert {got[i] for i, v in enumerate(values) if 9 <= v <= 10 and i in got} == {150} and [got[i] for i in (210, 211, 212)] == [-1] * 3


def test_a_forest_joins_what_its_links_join():
    import numpy as np

    from tidemark.operators.components import _Forest

    rng = np.random.default_rng(7)
    for kind, n, m in ((int, 400, 350), (str, 60, 90), (int, 30, 3000)):
        i, j = (rng.integers(0, n, m).astype(kind).astype(object if kind is str else int) for _ in "ij")
        forest, kept = _Forest(), []
        for part in range(0, m, 40):
            at = slice(part, part + 40)
            kept += (forest.join(i[at], j[at]) + part).tolist()

        def groups(links):
            of = {x: x for x in [*i, *j]}
            for a, b in links:
                a, b = of[a], of[b]
                of = {x: a if y == b else y for x, y in of.items()}
            return {frozenset(x for x in of if of[x] == y) for y in of.values()}

        every = groups(zip(i, j))
        assert groups([(i[p], j[p]) for p in kept]) == every and len(kept) == len({*i, *j}) - len(every)


def test_blocks_are_sent_by_tiles(spark, monkeypatch):
    """A tile goes out once for all its pairs of blocks with another; pairs and neighbours are those of the definition."""
    import numpy as np

    from tidemark.operators import dtw
    from tidemark.operators import near as near_

    monkeypatch.setattr(near_, "BLOCK_ROWS", 4)
    monkeypatch.setattr(near_, "TILES", 4)
    sent, formed, by_block = [], [], []
    for name, into in (("dealt", sent), ("streamed", sent)):
        way = getattr(near_.Blocks, name)

        def noted(self, pairs, way=way, into=into):
            out = way(self, pairs)
            formed.append(pairs.count())
            into.append(out.count())
            return out

        monkeypatch.setattr(near_.Blocks, name, noted)
    fetched = near_.Blocks.fetched
    monkeypatch.setattr(near_.Blocks, "fetched", lambda self, *a, **k: by_block.append(1) or fetched(self, *a, **k))
    rng = np.random.default_rng(11)
    for lengths in ((9, 9), (8, 9)):
        arrays = [np.round(rng.gamma(1.0, 30.0, lengths[i % 2]), 2) for i in range(150)]
        nodes = dtw.distinct_sequences(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(arrays)], "id long, v array<double>").repartition(3), "id", "v")
        for radius in (0, 2):
            every = np.array([[dtw.dtw_rows(a[None], b[None], radius)[0] for b in arrays] for a in arrays])
            found = {(r.i, r.j): r.dist for r in dtw.pairs_within(nodes, 60.0, radius).collect()}
            assert found == {(i, j): every[i, j] for i in range(150) for j in range(i + 1, 150) if every[i, j] <= 60.0} and len(found) > 50
            got = rows(dtw.nearest_sequences(nodes, 3, radius))
            want = [(i, j, every[i, j], p + 1) for i in range(150) for p, j in enumerate(sorted((j for j in range(150) if j != i), key=lambda j: (every[i, j], j))[:3])]
            assert sorted(map(tuple, got)) == sorted(want)
    assert not by_block and all(n < m / 2 for n, m in zip(sent, formed))


def test_pairs_with_warping_are_given_up_in_stages(monkeypatch):
    """Of many pairs only those that are near, or almost, are measured to the end; pairs and distances are those of the definition."""
    import numpy as np

    from tidemark.operators import kernels

    rng, measure, sizes = np.random.default_rng(6), kernels.dtw_rows, []
    monkeypatch.setattr(kernels, "dtw_rows", lambda a, b, r: sizes.append(len(a)) or measure(a, b, r))
    for n, m in ((31, 31), (28, 31), (31, 28), (40, 9)):
        a, b = np.round(rng.gamma(1.0, 50.0, (90, n)), 2), np.round(rng.gamma(1.0, 50.0, (70, m)), 2)
        i, j = (g.ravel() for g in np.indices((90, 70)))
        every = measure(a[i], b[j], 3).reshape(90, 70)
        limits = np.sort(every, axis=1)[:, 2]
        limits[5], limits[6] = np.inf, 0.0
        for some in (None, rng.random((90, 70)) < 0.7):
            sizes.clear()
            found = [(p, q, d) for part in kernels.close_pairs(a, b, limits, 3, some) for p, q, d in zip(*part)]
            near = every <= limits[:, None]
            want = set(zip(*np.nonzero(near if some is None else near & some)))
            assert {(p, q) for p, q, _ in found} == want and len(found) == len(want) and all(d == every[p, q] for p, q, d in found)
            assert sum(sizes) <= len(want) + 5


def test_clusters_and_scores_fetch_blocks_by_tiles(spark, monkeypatch):
    """The tree, density clusters and scores send a tile once for all its pairs of blocks with another."""
    import numpy as np

    from tidemark.operators import clustering, density, dtw, tree
    from tidemark.operators import near as near_

    monkeypatch.setattr(near_, "BLOCK_ROWS", 4)
    monkeypatch.setattr(near_, "TILES", 4)
    monkeypatch.setattr(density, "EARLY_BLOCKS", 10**6)
    sent, formed, fetched = [], [], near_.Blocks.fetched

    def noted(self, pairs, both, *columns, rows=None):
        out = fetched(self, pairs, both, *columns, rows=rows)
        formed.append(pairs.count())
        sent.append(out.count())
        return out

    monkeypatch.setattr(near_.Blocks, "fetched", noted)
    rng = np.random.default_rng(12)
    arrays = [np.round(rng.gamma(1.0, 30.0, 7), 2) for _ in range(150)]
    nodes = dtw.distinct_sequences(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(arrays)], "id long, v array<double>").repartition(3), "id", "v").cache()
    every = np.array([[dtw.dtw_rows(a[None], b[None], 1)[0] for b in arrays] for a in arrays])
    limit = float(np.sort(every, axis=1)[:, 4].mean())
    cores = {r.seq_id: r.is_core for r in clustering.dbscan(nodes, limit, 5, 1).collect()}
    assert [cores[i] for i in range(150)] == ((every <= limit).sum(axis=1) >= 5).tolist() and len({*cores.values()}) == 2
    labels = nodes.selectExpr("seq_id", "seq_id % 3 AS label")
    score = clustering.warping_silhouettes(nodes, {"thirds": labels}, 1).first().silhouette
    means = np.array([[every[i, [j for j in range(150) if j % 3 == c and j != i]].mean() for c in range(3)] for i in range(150)])
    own, other = means[range(150), np.arange(150) % 3], np.array([min(np.delete(m, i % 3)) for i, m in enumerate(means)])
    np.testing.assert_allclose(score, ((other - own) / np.maximum(own, other)).mean())
    nearest = dtw.nearest_sequences(nodes, 2, 1).cache()
    core = clustering.core_distances(nodes, nearest)
    edges = tree.spanning_tree(nodes, core, nearest.select("i", "j", "dist"), 1).collect()
    kth = np.sort(every, axis=1)[:, 2]
    reach, left, total = np.maximum(np.maximum(every, kth[:, None]), kth[None, :]), {*range(1, 150)}, 0.0
    while left:  # grown from one end
        w, j = min((reach[i, j], j) for j in left for i in range(150) if i not in left)
        left.remove(j)
        total += w
    assert len(edges) == 149
    np.testing.assert_allclose(sum(e.w for e in edges), total)
    assert len(sent) >= 6 and all(n < m / 2 for n, m in zip(sent, formed) if m > 500) and max(formed) > 500
