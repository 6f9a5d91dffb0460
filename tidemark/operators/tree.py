"""Density tree of sequences: spanning tree of mutual reachability, dendrogram, condensed clusters.

The spanning tree grows by rounds in which every component takes its least outgoing edge. The
dendrogram is built by contraction: edges that are the least of one of their ends are merged, the others form
a tree of at most half the size, and so on; every edge then climbs to the chain it belongs to, and chains are
sorted. Sizes, stabilities and the choice of clusters are aggregates from the bottom up. No distance
is fixed beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.components import connected_components
from tidemark.operators.near import Blocks, Tile, block_close_pairs, in_turn, plain_ids
from tidemark.session import cut_lineage

LEAST = 1e-6  # smaller distances count as this one, so that copies have a finite density


# ---- spanning tree -----------------------------------------------------------------------


class _Side:
    """Ids, cores and parts of the rows of a tile, all blocks one after the other."""

    def __init__(self, tile: Tile):
        self.tile, self.place = tile, tile.places()
        self.ids, self.parts = (plain_ids(np.concatenate([plain_ids(m[c]) for m in tile.of.values()])) for c in ("seq_id", "part"))
        self.cores, self.limits = (np.concatenate([np.asarray(m[c], dtype=float) for m in tile.of.values()]) for c in ("core", "limit"))

    def rows(self, blocks: tuple) -> np.ndarray:
        return np.concatenate([self.place[block] for block in blocks])


class _Outgoing:
    """Least outgoing edges of the components in one tile, fed with other tiles, nearest first."""

    def __init__(self, tile: Tile, radius: int):
        self.own, self.radius = _Side(tile), radius
        self.limits = self.own.limits.copy()  # of each row's component, shrinking
        self.names, self.of = np.unique(self.own.parts, return_inverse=True)
        self.least = np.full(len(self.names), np.inf)
        self.lo, self.hi, self.other = (np.empty(len(self.names), self.own.ids.dtype) for _ in range(3))
        self.known = np.zeros(len(self.names), bool)

    def meet(self, a: np.ndarray, b: np.ndarray, bound: np.ndarray, other: Tile) -> None:
        """Pairs of an own block a[p] and a block b[p] of the other tile, at least bound[p] apart."""
        side = self.own if other is self.own.tile else _Side(other)
        apart = a != b
        for block in a[~apart]:
            self._measure((block,), (block,), side)
        order = np.argsort(bound, kind="stable")
        order = order[apart[order]]
        least = {(a[p], b[p]): bound[p] for p in order}
        for some, others in in_turn(a[order], b[order]):
            limit = self.limits[self.own.place[some[0]]].max()
            left = tuple(block for block in others if least[some[0], block] <= limit)
            if left:
                self._measure(some, left, side)

    def _measure(self, some: tuple, others: tuple, side: _Side) -> None:
        rows, cols = self.own.rows(some), side.rows(others)
        reach = np.maximum(self.own.cores[rows][:, None], side.cores[cols][None, :])
        allowed = (self.own.parts[rows][:, None] != side.parts[cols][None, :]) & (reach <= self.limits[rows][:, None])
        if not allowed.any():
            return
        own, theirs = self.own.tile.joined(some)[1], side.tile.joined(others)[1]
        for i, j, d in block_close_pairs(own, theirs, self.limits[rows], self.radius, allowed):
            self._add(rows[i], cols[j], np.maximum(d, reach[i, j]), side)

    def _add(self, p: np.ndarray, q: np.ndarray, w: np.ndarray, side: _Side) -> None:
        """Take the least edge of each component, of equal ones that of the smaller ids."""
        of, least = self.of[p], self.least.copy()
        np.minimum.at(least, of, w)
        some = np.flatnonzero(w == least[of])
        p, q, w, of = p[some], q[some], w[some], of[some]
        ends = self.own.ids[p], side.ids[q]
        swapped = np.asarray(ends[0] > ends[1], dtype=bool)
        lo, hi = np.where(swapped, ends[1], ends[0]), np.where(swapped, ends[0], ends[1])
        for at, x, low, high, part in zip(of.tolist(), w.tolist(), lo.tolist(), hi.tolist(), side.parts[q].tolist()):
            if not self.known[at] or (x, low, high) < (self.least[at], self.lo[at], self.hi[at]):
                self.known[at], self.least[at], self.lo[at], self.hi[at], self.other[at] = True, x, low, high, part
        np.minimum(self.limits, self.least[self.of], out=self.limits)

    def rows(self) -> pd.DataFrame:
        known = np.flatnonzero(self.known)
        return pd.DataFrame({"part": self.names[known], "w": self.least[known], "lo": self.lo[known], "hi": self.hi[known], "other": self.other[known]})


def _upper_bounds(parts: DataFrame, near: DataFrame) -> DataFrame:
    """(part, limit): the least known edge that leaves each component; ``near`` has (i, j, w)."""
    both = near.unionByName(near.select(F.col("j").alias("i"), F.col("i").alias("j"), "w"))
    named = both.join(parts.withColumnsRenamed({"seq_id": "i", "part": "part_i"}), "i").join(
        parts.withColumnsRenamed({"seq_id": "j", "part": "part_j"}), "j"
    )
    return named.where("part_i <> part_j").groupBy(F.col("part_i").alias("part")).agg(F.min("w").alias("limit"))


def spanning_tree(sequences: DataFrame, cores: DataFrame, near: DataFrame, radius: int = 3) -> DataFrame:
    """(lo, hi, w): the minimum spanning tree of the mutual reachability of (seq_id, values).

    The reachability of a pair is the largest of its distance and both core distances (i, core); ties
    go to the smaller ids. ``near`` has some pairs (i, j, dist), such as nearest neighbours and pairs with
    landmarks: they only bound the search, so that far blocks are left out.
    """
    core = cores.select(F.col("i").alias("seq_id"), "core")
    rows = sequences.select("seq_id", "values").join(core, "seq_id")
    blocks = Blocks(cut_lineage(rows), radius, carry="core")
    kind = blocks.id_type
    ends = {end: core.withColumnsRenamed({"seq_id": end, "core": f"core_{end}"}) for end in "ij"}
    known = near.join(ends["i"], "i").join(ends["j"], "j")
    known = cut_lineage(known.select("i", "j", F.greatest("dist", "core_i", "core_j").alias("w")))
    places = cut_lineage(blocks.rows.select("block", F.posexplode("seq_id").alias("place", "seq_id")))
    parts = cut_lineage(places.select("seq_id", F.col("seq_id").alias("part")))
    edges: list[DataFrame] = []
    base = blocks.rows

    while True:
        limits = _upper_bounds(parts, known)
        placed = places.join(parts, "seq_id").join(limits, "part", "left")
        placed = placed.select("block", "place", "part", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
        held = placed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "part", "limit"))).alias("p"))
        blocks.rows = cut_lineage(base.join(held, "block").select(base["*"], F.col("p.part").alias("part"), F.col("p.limit").alias("limit")))
        pairs = blocks.pairs(F.array_max("limit") * (1 + 1e-12), symmetric=False)
        streamed = blocks.fetched(pairs, False, "core", "part", "limit")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at, search = None, None
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if row.tile_a != at:
                        if search is not None:
                            yield search.rows()
                        at, search = row.tile_a, _Outgoing(Tile(row.members), radius)
                    if row.least <= search.limits.max():
                        search.meet(row.met_a, row.met_b, row.met_bound, search.own.tile if row.tile_b == at else Tile(row.members))
            if search is not None:
                yield search.rows()

        taken = streamed.mapInPandas(run, f"part {kind}, w double, lo {kind}, hi {kind}, other {kind}")
        least = cut_lineage(taken.groupBy("part").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e")).select("part", "e.*"))
        if least.isEmpty():
            break
        edges.append(least.select("lo", "hi", "w").distinct())
        merged = connected_components(least.select(F.col("part").alias("i"), F.col("other").alias("j")))
        renamed = parts.join(merged, parts["part"] == merged["node"], "left")
        parts = cut_lineage(renamed.select("seq_id", F.coalesce("component", "part").alias("part")))
    if not edges:
        return known.limit(0).select(F.col("i").alias("lo"), F.col("j").alias("hi"), "w")
    return cut_lineage(reduce(DataFrame.unionByName, edges))


# ---- dendrogram --------------------------------------------------------------------------


def _chains(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(e, level, root, above) of every edge, the chain it belongs to and the edge above that; and (x, least) of every vertex."""
    current = cut_lineage(edges.select(F.struct("w", "lo", "hi").alias("e"), F.col("lo").alias("u"), F.col("hi").alias("v")))
    least: list[DataFrame] = []
    up: list[DataFrame] = []
    inside: list[DataFrame] = []
    while not current.isEmpty():
        first = cut_lineage(
            current.select("e", F.explode(F.array("u", "v")).alias("x")).groupBy("x").agg(F.min("e").alias("least"))
        )
        judged = current
        for end in "uv":
            judged = judged.join(first.withColumnsRenamed({"x": end, "least": f"least_{end}"}), end)
        judged = cut_lineage(judged.withColumn("merged", (F.col("e") == F.col("least_u")) | (F.col("e") == F.col("least_v"))))
        merged = judged.where("merged")
        joined = cut_lineage(connected_components(merged.select(F.col("u").alias("i"), F.col("v").alias("j"))))
        for end in "uv":
            judged = judged.join(joined.withColumnsRenamed({"node": end, "component": f"in_{end}"}), end)
        judged = cut_lineage(judged.select("e", "merged", "in_u", "in_v"))
        least.append(first)
        up.append(joined)
        inside.append(judged.where("merged").select("e", F.col("in_u").alias("root")))
        current = judged.where("NOT merged").select("e", F.col("in_u").alias("u"), F.col("in_v").alias("v"))
    settled, climbing = None, None
    for level in range(1, len(least) + 1):
        here = inside[level - 1] if climbing is None else inside[level - 1].unionByName(climbing)
        if level < len(least):
            met = here.join(least[level], here["root"] == least[level]["x"]).select("e", "root", "least")
            met = cut_lineage(met.join(up[level], met["root"] == up[level]["node"]).select("e", "root", "least", "component"))
            done = met.where(F.col("least") > F.col("e")).select("e", F.lit(level).alias("level"), "root", F.col("least").alias("above"))
            climbing = met.where(F.col("least") < F.col("e")).select("e", F.col("component").alias("root"))
        else:
            done = here.select("e", F.lit(level).alias("level"), "root", F.lit(None).cast(here.schema["e"].dataType).alias("above"))
        settled = done if settled is None else settled.unionByName(done)
    return cut_lineage(settled), least[0]


def dendrogram(edges: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (e, level, root, at, parent, size), children (e, size, child) and vertices (x, least) of the single-linkage dendrogram.

    ``edges`` is a spanning tree (lo, hi, w), ``vertices`` has (seq_id, copies). ``child`` is the edge
    below, null for a vertex; ``least`` the edge above a vertex. Chains are sorted one by one.
    """
    chained, first = _chains(edges)
    weights = vertices.join(first, vertices["seq_id"] == first["x"]).select(F.col("least").alias("e"), F.col("copies").alias("size"))
    none = F.lit(None).cast(chained.schema["e"].dataType)
    hung = [weights.withColumn("child", none)]
    chain = Window.partitionBy("level", "root").orderBy("e")
    placed = cut_lineage(chained.withColumns({"at": F.row_number().over(chain), "next": F.lead("e").over(chain)}))
    sized: list[DataFrame] = []
    for (level,) in placed.select("level").distinct().orderBy("level").collect():
        offered = reduce(DataFrame.unionByName, hung).groupBy("e").agg(F.sum("size").alias("own"))
        own = placed.where(F.col("level") == level).join(offered, "e", "left")
        upto = chain.rowsBetween(Window.unboundedPreceding, 0)
        rows = cut_lineage(own.withColumn("size", F.sum(F.coalesce("own", F.lit(0))).over(upto)).drop("own"))
        sized.append(rows)
        tops = rows.where("next IS NULL AND above IS NOT NULL")
        hung.append(tops.select(F.col("above").alias("e"), "size", F.col("e").alias("child")))
    every = reduce(DataFrame.unionByName, sized)
    hung.append(every.where("next IS NOT NULL").select(F.col("next").alias("e"), "size", F.col("e").alias("child")))
    found = every.select("e", "level", "root", "at", F.coalesce("next", "above").alias("parent"), "size")
    return cut_lineage(found), cut_lineage(reduce(DataFrame.unionByName, hung)), first


# ---- clusters ----------------------------------------------------------------------------


def _density(distance: Column) -> Column:
    return 1 / F.greatest(distance, F.lit(LEAST))


def _condensed(edges: DataFrame, children: DataFrame, vertices: DataFrame, first: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clusters (cluster, parent, stability), and the cluster of every large edge (e, cluster) and large vertex (seq_id, cluster)."""
    sides = children.groupBy("e").agg(
        F.sum((F.col("size") >= least).cast("int")).alias("large"),
        F.sum(F.when(F.col("size") < least, F.col("size")).otherwise(0)).alias("small"),
    )
    alive = edges.where(F.col("size") >= least).join(sides, "e").withColumn("splits", (F.col("large") == 2).cast("int"))
    upto = Window.partitionBy("level", "root").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # a split ends the clusters below it: edges of a chain up to the next split are one cluster
    segment = F.struct("level", F.col("root").alias("root"), F.sum("splits").over(upto).alias("part"))
    alive = cut_lineage(alive.withColumn("segment", segment))
    heavy = vertices.where(F.col("copies") >= least).join(first, vertices["seq_id"] == first["x"])
    own = F.struct(F.lit(0).alias("level"), F.col("seq_id").alias("root"), F.lit(0).cast("long").alias("part"))
    heavy = cut_lineage(heavy.select("seq_id", "copies", "core", F.col("least").alias("parent"), own.alias("segment")))
    above = alive.select(F.col("e").alias("parent"), F.col("segment").alias("segment_above"), F.col("splits").alias("splits_above"))
    ups = cut_lineage(
        alive.select("segment", "parent", "size")
        .unionByName(heavy.select("segment", "parent", F.col("copies").alias("size")))
        .join(above, "parent", "left")
    )
    links = ups.where("splits_above = 0 AND segment <> segment_above").select(F.col("segment").alias("i"), F.col("segment_above").alias("j"))
    joined = cut_lineage(connected_components(links.distinct()))

    def named(df: DataFrame, segment: str, name: str) -> DataFrame:
        met = df.join(joined, df[segment] == joined["node"], "left")
        return met.withColumn(name, F.coalesce("component", segment)).drop("node", "component")

    leaving = F.when(F.col("splits") == 1, F.col("size")).otherwise(F.col("small")) * _density(F.col("e.w"))
    mass = alive.select("segment", leaving.alias("mass")).unionByName(heavy.select("segment", (F.col("copies") * _density(F.col("core"))).alias("mass")))
    masses = named(mass, "segment", "cluster").groupBy("cluster").agg(F.sum("mass").alias("mass"))
    tops = ups.where("splits_above = 1 OR parent IS NULL")
    tops = named(named(tops, "segment", "cluster"), "segment_above", "above")
    born = F.coalesce(F.col("size") * _density(F.col("parent.w")), F.lit(0.0))
    clusters = tops.select("cluster", "above", born.alias("born")).join(masses, "cluster")
    clusters = cut_lineage(clusters.select("cluster", F.col("above").alias("parent"), (F.col("mass") - F.col("born")).alias("stability")))
    return clusters, named(alive.select("e", "segment"), "segment", "cluster"), named(heavy.select("seq_id", "segment"), "segment", "cluster")


def _chosen(clusters: DataFrame) -> DataFrame:
    """(cluster, label): the chosen cluster each one belongs to, null where none; by rounds of one level of the tree.

    A cluster is chosen over those inside it if it is at least as stable as the best choice of them. The root is never chosen.
    """
    waiting, done = clusters, None
    while not waiting.isEmpty():
        ready = waiting.join(waiting.select(F.col("parent").alias("cluster")), "cluster", "left_anti")
        if done is None:
            scored = ready.withColumn("inside", F.lit(0.0))
        else:
            sums = done.groupBy(F.col("parent").alias("cluster")).agg(F.sum("score").alias("inside"))
            scored = ready.join(sums, "cluster", "left").na.fill(0.0, ["inside"])
        scored = scored.withColumn("chosen", F.col("parent").isNotNull() & (F.col("stability") >= F.col("inside")))
        score = F.when(F.col("chosen"), F.col("stability")).otherwise(F.col("inside"))
        scored = cut_lineage(scored.select("cluster", "parent", "chosen", score.alias("score")))
        done = scored if done is None else done.unionByName(scored)
        waiting = cut_lineage(waiting.join(scored.select("cluster"), "cluster", "left_anti"))
    if done is None:
        return clusters.select("cluster", F.col("cluster").alias("label"))
    label = F.when(F.col("chosen"), F.col("cluster"))
    level = cut_lineage(done.where("parent IS NULL").select("cluster", label.alias("label")))
    found = level
    while not level.isEmpty():
        inside = done.alias("d").join(level.select(F.col("cluster").alias("parent"), F.col("label").alias("given")), "parent")
        level = cut_lineage(inside.select("cluster", F.coalesce("given", label).alias("label")))
        found = found.unionByName(level)
    return found


def density_tree(vertices: DataFrame, edges: DataFrame, min_cluster_size: int = 5) -> DataFrame:
    """(seq_id, label): the most stable clusters of the density tree, named by their smallest sequence; -1 is noise.

    ``vertices`` has (seq_id, copies, core), ``edges`` the spanning tree (lo, hi, w) of mutual reachability. A cluster has
    ``min_cluster_size`` sequences or more, copies included; smaller groups fall out of it. The stability
    is the sum over its sequences of the density at which they leave, less the density at which it
    appears; of a cluster and those inside it the more stable choice is taken. The whole is no cluster.
    Equal distances count in the order of ids. Without edges all are noise.
    """
    kind = vertices.schema["seq_id"].dataType.simpleString()
    noise = F.lit(-1).cast(kind)
    if edges.isEmpty():
        return vertices.select("seq_id", noise.alias("label"))
    tree, children, first = dendrogram(edges, vertices)
    clusters, of_edge, of_vertex = _condensed(tree, children, vertices, first, min_cluster_size)
    chosen = _chosen(clusters)
    large = cut_lineage(of_edge.select("e", "cluster"))
    rest = vertices.select("seq_id").join(of_vertex.select("seq_id"), "seq_id", "left_anti")
    at = rest.join(first, rest["seq_id"] == first["x"]).select("seq_id", F.col("least").alias("e"))
    found = of_vertex.select("seq_id", "cluster")
    for _ in range(min_cluster_size):  # a group too small to be a cluster grows with every edge upwards
        met = cut_lineage(at.join(large, "e", "left"))
        found = found.unionByName(met.where("cluster IS NOT NULL").select("seq_id", "cluster"))
        left = met.where("cluster IS NULL").select("seq_id", "e")
        at = left.join(tree.select("e", "parent"), "e").where("parent IS NOT NULL").select("seq_id", F.col("parent").alias("e"))
    labelled = cut_lineage(found.join(chosen, "cluster").where("label IS NOT NULL").select("seq_id", F.col("label").alias("cluster")))
    names = labelled.groupBy("cluster").agg(F.min("seq_id").alias("label"))
    named = labelled.join(names, "cluster").select("seq_id", "label")
    return vertices.select("seq_id").join(named, "seq_id", "left").select("seq_id", F.coalesce("label", noise).alias("label"))
