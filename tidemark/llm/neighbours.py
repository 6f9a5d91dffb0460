"""Exact nearest neighbours by a block matrix join with quantisation error bounds.

Queries and candidates are cut into blocks; each pair of blocks is a tile. In a tile one product
of int8 codes gives every distance up to the two vectors' quantisation errors. Pairs whose lower
bound is above the k-th smallest upper bound of their query cannot be among its k nearest; the
others are computed anew from the original vectors in double precision. Each tile returns a heap
of k per query, and the heaps are merged.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_ROWS, CANDIDATE_ROWS = 512, 4096  # rows of a block, on average
_CHUNK = 64  # queries of a tile bounded at once


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components and not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Block:
    """A matrix of vectors with its int8 codes, scales and error norms."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.scale = np.abs(vectors).max(axis=1) / 127
        # tiny vectors may have a scale of 0, which gives codes of 0 and an error of the whole norm
        codes = np.rint(np.divide(vectors, self.scale[:, None], out=np.zeros_like(vectors), where=self.scale[:, None] > 0))
        self.codes = codes.clip(-127, 127).astype(np.int8)
        coded = self.codes * self.scale[:, None]
        self.error = np.sqrt(((vectors - coded) ** 2).sum(axis=1))
        self.square = (coded**2).sum(axis=1)


def bounds(q: Block, c: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances of a tile, from the codes."""
    exact = np.float32 if q.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q.codes.astype(exact) @ c.codes.astype(exact).T).astype(np.float64)
    total = q.square[:, None] + c.square[None, :]
    squares = total - 2 * product * q.scale[:, None] * c.scale[None, :]
    # rounding of the sums above, as a share of their terms
    slack = np.sqrt(np.finfo(np.float64).eps * 4 * q.codes.shape[1] * total)
    distance, error = np.sqrt(np.maximum(squares, 0)), q.error[:, None] + c.error[None, :] + slack
    return distance - error, distance + error


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows in double precision, summed from the first component on."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        step = a[:, d] - b[:, d]
        total += step * step
    return np.sqrt(total)


def nearest_in_tile(queries: Block, candidates: Block, k: int) -> list[tuple[int, int, float]]:
    """(query id, candidate id, distance) of each query's k nearest in the tile, ties to smaller ids."""
    out = []
    for start in range(0, len(queries.ids), _CHUNK):
        q = Block(queries.ids[start : start + _CHUNK], queries.vectors[start : start + _CHUNK])
        low, high = bounds(q, candidates)
        other = q.ids[:, None] != candidates.ids[None, :]
        high[~other] = np.inf
        limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(q.ids), np.inf)
        for i in range(len(q.ids)):
            left = np.flatnonzero(other[i] & (low[i] <= limit[i]))
            exact = distances(np.broadcast_to(q.vectors[i], (len(left), q.vectors.shape[1])), candidates.vectors[left])
            heap = heapq.nsmallest(k, zip(exact.tolist(), candidates.ids[left].tolist()))
            out += [(int(q.ids[i]), neighbour, score) for score, neighbour in heap]
    return out


def _matrix(table: pa.Table) -> Block:
    vectors = table.column("vector").combine_chunks()
    return Block(table.column("id").to_numpy(), vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1))


def nearest(candidates: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest candidates of each query, by Euclidean distance.

    Both sides have a whole-number ``id`` and an array ``vector``. Vectors that are null, zero or
    hold a null or non-finite component, and rows without id, take no part. A query is not
    compared with rows of its own id, nor with vectors of another length. Rows that repeat id and
    vector count once; ties go to the smaller id. Fewer candidates than k give fewer rows; a side
    without rows gives none. Other columns are not read.
    """

    def known(df: DataFrame) -> DataFrame:
        valid = df.where(F.col(id).isNotNull() & usable(F.col(vector)))
        return valid.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).distinct()

    asked, offered = known(queries), known(candidates)
    asked_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    offered_blocks = max(1, -(-offered.count() // CANDIDATE_ROWS))
    place = F.xxhash64("id", "vector")

    def tiled(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select("id", "vector", F.size("vector").alias("width"), F.pmod(place, F.lit(blocks)).cast("int").alias(own)).withColumn(other, each)

    left = tiled(asked, "q", asked_blocks, "c", offered_blocks).groupBy("width", "q", "c")
    right = tiled(offered, "c", offered_blocks, "q", asked_blocks).groupBy("width", "q", "c")

    def tile(asked: pa.Table, offered: pa.Table) -> pa.Table:
        found = nearest_in_tile(_matrix(asked), _matrix(offered), k) if asked.num_rows and offered.num_rows else []
        columns = list(zip(*found)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInArrow(tile, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
