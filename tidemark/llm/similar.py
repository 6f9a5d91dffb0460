"""One text of each class of near duplicates by the exact similarity of their word shingles.

Candidates come from SimHash fingerprints within two bits and from MinHash bands, which meet with
a probability of 0.9999 at a similarity of 0.8. A bucket of a band compares its texts with one of
them, so that it may hold a large group of copies. Where it then still holds several classes,
texts of different classes are compared: all of them in a small bucket; in a crowded one first with its
most central text, then those that share one of their rarest shingles, which by the prefix filter
are all that can be similar. Equal MinHash values thin candidates before the texts are fetched, and the Jaccard
similarity is computed from all shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.simhash import _view_links, first_rows, fingerprints_of
from tidemark.session import cut_lineage

WIDTH = 5  # words of a shingle
SIMILAR = (4, 5)  # numerator and denominator of the least similarity
BANDS, ROWS = 20, 4
CROWD = 64  # texts of a bucket whose different classes are compared pair by pair; rare shingles find the pairs of others
LEAST_EQUAL = 48  # equal MinHash values of 80; at a similarity of 0.8 fewer are equal with a probability of 0.00002
_BLOCK = 1 << 14  # shingles hashed at once
_SALTS = np.random.default_rng(7).integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted different hashes of a text's word shingles (lower-cased A-Z, ASCII white space)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    found = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(42)), dtype=np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a set; the empty set has the largest number in every place."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[None, start : start + _BLOCK]
        least = np.minimum(least, ((block ^ _SALTS[0][:, None]) * (_SALTS[1][:, None] | np.uint64(1))).min(axis=1))
    return least


def bands_of(least: np.ndarray) -> np.ndarray:
    """A key for each band of MinHash values."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ (keys >> np.uint64(29)) ^ row) * _MIX
        keys ^= keys >> np.uint64(32)
    return keys


def is_similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets is 0.8 or more; two empty sets are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def _sketches(texts: DataFrame, seed: int) -> DataFrame:
    """(node, view, bands, least) of every text of (node, text); ``least`` has 16 bits of each MinHash value."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v.as_py() for v in batch.column("text")]
            views = pa.array([fingerprints_of(v, WIDTH, seed, 1)[0] for v in values], pa.int64())
            least = [minima(shingles(v)) for v in values]
            bands = pa.array([bands_of(x).view(np.int64) for x in least], pa.list_(pa.int64()))
            short = pa.array([x.astype(np.uint16).view(np.int16) for x in least], pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), views, bands, short], ["node", "view", "bands", "least"])

    return texts.mapInArrow(read, "node long, view long, bands array<long>, least array<short>")


def _equal(a: str, b: str) -> Column:
    """Number of equal MinHash values."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _verified(pairs: DataFrame) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("text_a"), batch.column("text_b"))
            same = pa.array([is_similar(shingles(a.as_py()), shingles(b.as_py())) for a, b in texts], pa.bool_())
            yield batch.select(["a", "b"]).filter(same)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _similar(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """The (a, b) of ``candidates`` whose texts in ``texts`` (node, text) are similar."""
    for end in ("a", "b"):
        candidates = candidates.join(texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")), end)
    return cut_lineage(_verified(candidates))


def _ordered(texts: DataFrame, crowd: DataFrame) -> DataFrame:
    """(node, size, rarest, centre) of the texts of ``crowd`` (node).

    Shingles are ordered by the number of crowd texts that hold them, those of more than ``CROWD`` last and by
    hash; ``rarest`` has so many of the first that any two similar sets share one. ``centre`` is the share of
    shingles of more than ``CROWD`` texts, high in a text that differs little from many others.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(v.as_py()).view(np.int64) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    own = texts.join(crowd, "node", "left_semi").select("node", "text")
    each = cut_lineage(own.mapInArrow(cut, "node long, hashes array<long>"))
    # a crowd may lie in a few files: its shingles are spread over all tasks before they are counted
    long = each.repartition("node").select("node", F.explode("hashes").alias("hash"))
    rare = long.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") <= CROWD)
    counted = long.join(rare, "hash").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "hash"))).alias("rare"))
    first = F.coalesce("rare.hash", F.array().cast("array<long>"))
    rest, size = F.array_except("hashes", first), F.size("hashes")
    rarest = F.slice(F.concat(first, rest), F.lit(1), size - F.ceil(size * SIMILAR[0] / SIMILAR[1]).cast("int") + 1)
    centre = F.coalesce(F.try_divide(F.size(rest), size), F.lit(0.0))
    return each.join(counted, "node", "left").select("node", size.alias("size"), rarest.alias("rarest"), centre.alias("centre"))


def _rare_pairs(ordered: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): texts of different classes that share a shingle early enough in both orders to be similar.

    Of the texts that share a shingle, those of its most frequent class are compared with the others only.
    """
    rooted = ordered.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = rooted.select("node", "size", "root", F.posexplode("rarest").alias("at", "hash"))
    by_class = rows.groupBy("hash", "root").agg(F.count("*").alias("n"))
    most = by_class.groupBy("hash").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("classes")).where("classes > 1")
    rows = cut_lineage(rows.join(most.select("hash", F.col("most.root").alias("main")), "hash"))
    few = rows.where("root <> main").select("hash", *[F.col(c).alias(f"{c}_a") for c in ("node", "size", "root", "at")])
    met = few.join(rows, "hash").where("root_a <> root")
    # shared shingles are at most this one and all that follow
    after = F.least(F.col("size_a") - F.col("at_a"), F.col("size") - F.col("at"))
    fits = after * (SIMILAR[0] + SIMILAR[1]) >= (F.col("size_a") + F.col("size")) * SIMILAR[0]
    return met.where(fits).select(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b")).distinct()


def _ordered_pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similar_links(known: DataFrame, seed: int = 42) -> DataFrame:
    """(a, b): links between the texts of ``known`` (node, text) with a similarity of 0.8 or more that connect each class.

    Two texts that are in one class already are not compared again.
    """
    sketches = _sketches(known, seed).groupBy("node").agg(*[F.first(c).alias(c) for c in ("view", "bands", "least")])
    sketches = cut_lineage(sketches)
    least = sketches.select("node", "least")
    rows = cut_lineage(sketches.select("node", F.posexplode("bands").alias("band", "key")))
    ends = cut_lineage(rows.groupBy("band", "key").agg(F.min("node").alias("end"), F.count("*").alias("n")).where("n > 1"))
    met = rows.join(ends.select("band", "key", "end"), ["band", "key"]).where("node <> end")
    near = _view_links(sketches.select(F.col("node").alias("fingerprint"), "view"), "view")
    edges = met.select(*_ordered_pair("node", "end")).unionByName(near.select(*_ordered_pair("a", "b")))
    edges = cut_lineage(edges.distinct())
    # the texts of all later steps, fetched in one pass: those that share a bucket or a link with another
    nodes = cut_lineage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    texts = cut_lineage(known.join(nodes, "node", "left_semi").dropDuplicates(["node"]))
    found: list[DataFrame] = []

    def compare(candidates: DataFrame, thinned: bool = False) -> None:
        """Verify candidates (a, b) that no earlier step had; of those with few equal MinHash values none is similar."""
        if not thinned:
            for end in ("a", "b"):
                candidates = candidates.join(least.withColumnsRenamed({"node": end, "least": f"least_{end}"}), end)
            candidates = candidates.where(_equal("least_a", "least_b") >= LEAST_EQUAL).select("a", "b")
        found.append(_similar(texts, cut_lineage(candidates)))

    def classes() -> DataFrame:
        return components(reduce(DataFrame.unionByName, found))

    compare(edges)

    roots = cut_lineage(classes())
    placed = cut_lineage(rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    several = placed.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    several = cut_lineage(several.where("low < high").select("band", "key", "n"))

    small = placed.join(several.where(F.col("n") <= CROWD), ["band", "key"]).join(least, "node")
    small = cut_lineage(small.select("band", "key", "node", "root", "least"))
    other = small.withColumnsRenamed({"node": "b", "root": "root_b", "least": "least_b"})
    apart = (F.col("node") < F.col("b")) & (F.col("root") != F.col("root_b")) & (_equal("least", "least_b") >= LEAST_EQUAL)
    pairs = small.join(other, ["band", "key"]).where(apart).select(F.col("node").alias("a"), "b").distinct()
    compare(pairs, thinned=True)

    crowded = cut_lineage(placed.join(several.where(F.col("n") > CROWD), ["band", "key"]).select("band", "key", "node"))
    ordered = cut_lineage(_ordered(texts, crowded.select("node").distinct()))
    central = crowded.join(ordered.select("node", "centre"), "node").groupBy("band", "key").agg(F.max(F.struct("centre", "node")).alias("c"))
    pivots = crowded.join(central.select("band", "key", F.col("c.node").alias("pivot")), ["band", "key"]).where("node <> pivot")
    compare(pivots.select(*_ordered_pair("node", "pivot")).distinct())
    compare(_rare_pairs(ordered, cut_lineage(classes())), thinned=True)
    return reduce(DataFrame.unionByName, found)


def keep_one_similar(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of near duplicates, with all columns of ``docs``.

    Texts are linked that share 80 % of their five-word shingles. Which row stays, nulls, empty
    texts and empty tables as in ``simhash.keep_one``.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    known = docs.select(F.xxhash64(content).alias("node"), content.alias("text"))
    roots = components(similar_links(known))
    rows = cut_lineage(docs.select(F.col(id).alias("id"), F.xxhash64(content).alias("hash")))
    rooted = rows.join(roots, rows.hash == roots.node, "left").select("id", "hash", F.coalesce("root", "hash").alias("root"))
    return first_rows(docs, rooted, id, text)
