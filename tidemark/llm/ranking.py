"""Ranked lexical search over a document FP-tree.

Documents are restricted to the terms that some item asks for and their terms ordered by document
frequency, so that equal beginnings of two term vectors share a path of a trie. Every node of the
trie knows the largest term frequencies and the smallest length norm below it, which bound the
score of all its documents. An item walks the trie depth first, best bound first, and leaves out
what cannot enter its best documents so far. Each task builds tries of its own documents, one
after the other, and the best of all tasks are merged.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of
from tidemark.session import cut_lineage

TERMS = 1 << 17  # different terms asked for at once: more items are searched in further blocks
TREE = 1 << 14  # documents of one trie
LEAF = 32  # documents below which a path is not split any more
_BATCH = 1024  # texts read at once
NO_ID = (1 << 63) - 1  # orders documents without id last

#: Fixed value: ASCII letters and digits and all bytes of other characters belong to terms; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Saturated term frequency, a whole number; grows with ``tf`` and falls with ``norm``."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * norm)


@dataclass
class Vectors:
    """Documents with at least one asked term, in the order of their paths; postings row by row."""

    ids: np.ndarray
    norms: np.ndarray
    starts: np.ndarray  # first posting of each document, and the end
    terms: np.ndarray  # ranks by document frequency, ascending within a document
    counts: np.ndarray

    @classmethod
    def of(cls, rows: Iterable[tuple[int, int, np.ndarray, np.ndarray]]) -> Vectors:
        """From (id, norm, term ranks ascending, counts)."""
        rows = sorted(rows, key=lambda r: (r[2].astype(">i4").tobytes(), r[0]))
        lengths = [len(r[2]) for r in rows]
        joined = [np.concatenate([r[i] for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64) for i in (2, 3)]
        ids, norms = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1))
        return cls(ids, norms, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64), *joined)


class Tree:
    """The trie of some documents: ranges of rows that share a path, down to leaves of about ``LEAF`` rows.

    Neighbouring paths of few documents share a leaf, a path without a branch has no nodes.
    """

    def __init__(self, vectors: Vectors, leaf: int = LEAF):
        self.v = vectors
        self.children: list[list[int]] = []
        self.ranges: list[tuple[int, int]] = []
        parents: list[int] = []
        n = len(vectors.ids)
        todo = [(0, n, 0, -1)] if n else []
        while todo:
            start, end, depth, parent = todo.pop()
            node = len(self.ranges)
            self.ranges.append((start, end))
            self.children.append([])
            parents.append(parent)
            if parent >= 0:
                self.children[parent].append(node)
            if end - start <= leaf:
                continue
            depth += self._shared(start, end - 1, depth)
            todo += [(a, b, depth, node) for a, b in self._parts(start, end, depth, leaf)]
        self._bound(np.array(parents, dtype=np.int64))
        v = vectors
        self.scores = impact(v.counts, np.repeat(v.norms, np.diff(v.starts)))

    def _path(self, row: int, depth: int) -> np.ndarray:
        return self.v.terms[self.v.starts[row] + depth : self.v.starts[row + 1]]

    def _shared(self, first: int, last: int, depth: int) -> int:
        """Terms that two rows, and so all between them, share after ``depth``."""
        a, b = self._path(first, depth), self._path(last, depth)
        n = min(len(a), len(b))
        differs = np.flatnonzero(a[:n] != b[:n])
        return int(differs[0]) if len(differs) else n

    def _parts(self, start: int, end: int, depth: int, leaf: int) -> list[tuple[int, int]]:
        """Rows start to end cut by their next term; small neighbours together, equal paths in pieces."""
        at = self.v.starts[start:end] + depth
        ended = at >= self.v.starts[start + 1 : end + 1]
        following = np.where(ended, -1, self.v.terms[np.minimum(at, len(self.v.terms) - 1)])
        cuts = [0, *(np.flatnonzero(np.diff(following)) + 1).tolist(), end - start]
        parts: list[tuple[int, int]] = []
        held = 0
        for a, b in zip(cuts, cuts[1:]):
            if held < a and b - held > leaf:
                parts.append((held, a))
                held = a
            if b - a > leaf:
                if following[a] < 0:  # equal in all terms
                    parts += [(i, min(i + leaf, b)) for i in range(a, b, leaf)]
                else:
                    parts.append((a, b))
                held = b
        if held < end - start:
            parts.append((held, end - start))
        return [(start + a, start + b) for a, b in parts]

    def _bound(self, parents: np.ndarray) -> None:
        """Smallest norm and id below each node, and for each term the nodes above it with their largest impact."""
        v, n = self.v, len(self.ranges)
        leaves = np.array([i for i in range(n) if not self.children[i]], dtype=np.int64)
        order = np.array(sorted(leaves.tolist(), key=lambda i: self.ranges[i]), dtype=np.int64)
        first = np.array([self.ranges[i][0] for i in order], dtype=np.int64)
        self.norms, self.least = np.full(n, NO_ID, np.int64), np.full(n, NO_ID, np.int64)
        if n:
            self.norms[order], self.least[order] = np.minimum.reduceat(v.norms, first), np.minimum.reduceat(v.ids, first)
        depths = np.zeros(n, dtype=np.int64)
        for i in range(1, n):  # a parent comes before its children
            depths[i] = depths[parents[i]] + 1
        row_leaf = np.repeat(order, np.diff(np.append(first, len(v.ids))))
        nodes, terms, most = _largest(np.repeat(row_leaf, np.diff(v.starts)), v.terms, v.counts)
        levels = []
        for level in range(int(depths.max(initial=0)), -1, -1):
            own = depths[nodes] == level
            up = parents[nodes[own]]
            levels.append((nodes[own], terms[own], most[own]))
            if level:
                at = np.flatnonzero(depths == level)
                np.minimum.at(self.norms, parents[at], self.norms[at])
                np.minimum.at(self.least, parents[at], self.least[at])
                joined = [np.concatenate(x) for x in ((nodes[~own], up), (terms[~own], terms[own]), (most[~own], most[own]))]
                nodes, terms, most = _largest(*joined)
        nodes, terms, most = (np.concatenate(x) for x in zip(*levels))
        by_term = np.argsort(terms, kind="stable")
        self.at, self.of_term = nodes[by_term], terms[by_term]
        self.most = impact(most[by_term], self.norms[self.at])

    def bounds(self, asked: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document below a node scores more than this for terms ``asked`` with ``weights``."""
        total = np.zeros(len(self.ranges), dtype=np.int64)
        low, high = np.searchsorted(self.of_term, asked), np.searchsorted(self.of_term, asked, side="right")
        for a, b, w in zip(low.tolist(), high.tolist(), weights.tolist()):
            total[self.at[a:b]] += w * self.most[a:b]
        return total

    def search(self, asked: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list, k: int) -> int:
        """Push (score, -id) of documents into the heap ``best`` of ``k``; the number of documents scored.

        ``dense`` has the weight of each rank, 0 where it is not asked for.
        """
        if not self.ranges:
            return 0
        bound = self.bounds(asked, weights)
        v, scored, stack = self.v, 0, [0]
        while stack:
            node = stack.pop()
            most = int(bound[node])
            if most <= 0 or (len(best) == k and (most, -int(self.least[node])) <= best[0]):
                continue
            if self.children[node]:
                stack += sorted(self.children[node], key=bound.__getitem__)
                continue
            start, end = self.ranges[node]
            scored += end - start
            a, b = v.starts[start], v.starts[end]
            found = np.add.reduceat(dense[v.terms[a:b]] * self.scores[a:b], v.starts[start:end] - a)
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(found >= least).tolist():
                entry = (int(found[i]), -int(v.ids[start + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored


def _largest(nodes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest count of every different (node, term)."""
    if not len(nodes):
        return nodes, terms, counts
    key = nodes << 32 | terms
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[first] >> 32, key[first] & 0xFFFFFFFF, np.maximum.reduceat(counts[order], first)


def _restricted(docs: DataFrame, id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of every text that has a term: its number of terms, and those of the vocabulary."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for i, value in zip(batch.column("id"), batch.column("text")):
                words = terms_of(value.as_py())
                if words:
                    tf = Counter(words)
                    met = tf.keys() & vocabulary.keys()
                    ids.append(i.as_py())
                    lengths.append(len(words))
                    found.append([vocabulary[w] for w in met])
                    counts.append([tf[w] for w in met])
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip((ids, lengths, found, counts), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    slim = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(read, "id long, n long, terms array<int>, counts array<long>")


def _search_block(docs: DataFrame, block: list[tuple[int, list[bytes]]], k: int, id: str, text: str) -> DataFrame:
    """(item, id, score): the best ``k`` of every task for each (item, terms) of the block."""
    vocabulary = {term: i for i, term in enumerate(dict.fromkeys(t for _, terms in block for t in terms))}
    with batches_of(docs.sparkSession, _BATCH):
        vectors = cut_lineage(_restricted(docs, id, text, vocabulary))
    documents, words = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(max(1, len(vocabulary)), dtype=np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # TERMS rows, about
        df[term] = n
    rank = np.empty(len(df), dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    asked = []
    for item, terms in block:
        repeats = Counter(vocabulary[t] for t in terms)
        at = np.array(list(repeats), dtype=np.int64)
        weights = [times * math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df[t]) + 1))) for t, times in repeats.items()]
        asked.append((item, rank[at], np.array(weights, dtype=np.int64)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for batch in batches:
            ids, n = batch.column("id").to_pylist(), batch.column("n").to_pylist()
            lists = [batch.column(c) for c in ("terms", "counts")]
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in lists]
            ends = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
            for i in range(batch.num_rows):
                terms = rank[flat[0][ends[i] : ends[i + 1]]]
                if len(terms):
                    order = np.argsort(terms)
                    yield ids[i], 75 + 25 * n[i] * documents // words, terms[order], flat[1][ends[i] : ends[i + 1]][order]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in asked]
        dense = np.zeros(len(rank), dtype=np.int64)

        def look(held: list) -> None:
            tree = Tree(Vectors.of(held))
            for (_, terms, weights), heap in zip(asked, best):
                dense[terms] = weights
                tree.search(terms, weights, dense, heap, k)
                dense[terms] = 0

        held: list = []
        for row in rows(batches):
            held.append(row)
            if len(held) == TREE:
                look(held)
                held = []
        look(held)
        found = [(item, -back, score) for (item, _, _), heap in zip(asked, best) for score, back in heap]
        columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "id", "score"])

    return vectors.select("id", "n", "terms", "counts").mapInArrow(search, "item long, id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item.

    Terms, weights and scores as whole numbers: a term that occurs in df of N documents weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), and a document of n terms, tf of them this one, gets for
    it w * (10^9 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, L the terms of all documents. Terms
    repeated in an item count as often. N, L and df come from all documents.

    Ties go to the smaller id. Items without terms, or without any in the documents, give no rows;
    items equal in id and text are searched once, items equal in id only each on their own. Rows
    that repeat a document count and are found as often as they occur; documents without id come
    last among equal scores and are returned with a null id. Null and empty texts have no terms and do not
    count in N. Empty tables give no rows. Other columns are not read.

    The items are the stated queries: they are read in blocks of at most ``TERMS`` different terms,
    each block against all documents, so that the driver and a task hold one block at a time.
    """
    asked = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
    blocks: list[list] = [[]]
    names, seen, number = [], set(), 0
    for row in asked.orderBy("item_id", "text").toLocalIterator():
        terms = terms_of(row.text)
        if blocks[-1] and len(seen) + len(set(terms) - seen) > TERMS:
            blocks.append([])
            seen = set()
        seen.update(terms)
        if terms:
            blocks[-1].append((number, terms))
            names.append((number, row.item_id))
            number += 1
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    found = None
    for block in blocks:
        more = cut_lineage(_search_block(docs, block, k, id, text))
        found = more if found is None else found.unionByName(more)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = ranked.join(spark.createDataFrame(names, f"item long, name {kind}"), "item")
    return named.select(F.col("name").alias(item_id), "rank", F.nullif(F.col("id"), F.lit(NO_ID)).alias(id), "score")
