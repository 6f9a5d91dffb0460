"""Centroid clustering by progressive search in the Walsh-Hadamard domain.

Vectors become integers and are transformed once, exactly, by sums and differences; the transform
keeps every squared distance up to the factor of its width. Its coefficients are ordered from
coarse (few sign changes) to fine. A round adds up squared coefficient differences in that order;
a centroid whose partial sum is already above a whole distance of the same vector is strictly
worse and goes, and all that are left are finished over every coefficient.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

LARGEST = 1 << 23  # of a scaled component: distances then fit 64 bits for widths up to 64
COARSE = 8  # coefficients that choose the centroid whose whole distance is the first limit
_ROWS = 4096  # vectors searched at once


def walsh(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows from few to many sign changes; times itself transposed it is ``width`` times one."""
    if width < 1 or width & (width - 1):
        raise ValueError("the width must be a power of two")
    matrix = np.ones((1, 1), dtype=np.int64)
    while len(matrix) < width:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1), kind="stable")]


def nearest_centroids(coded: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared difference) of each row's nearest of ``centres``, ties to the smaller number.

    Both hold coefficients from coarse to fine, as int64.
    """
    width = coded.shape[1]
    first = min(COARSE, width)
    so_far = np.zeros((len(coded), len(centres)), dtype=np.int64)
    for at in range(first):
        so_far += (coded[:, at, None] - centres[None, :, at]) ** 2
    limit = ((coded - centres[so_far.argmin(axis=1)]) ** 2).sum(axis=1)
    row, number = np.nonzero(so_far <= limit[:, None])
    total = so_far[row, number]
    while first < width:
        last = min(2 * first, width)
        total = total + ((coded[row, first:last] - centres[number, first:last]) ** 2).sum(axis=1)
        stay = total <= limit[row]
        row, number, total, first = row[stay], number[stay], total[stay], last
    order = np.lexsort((number, total, row))
    best = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return number[best], total[best]


def _finite(vector: Column, width: int) -> Column:
    each = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == width) & each, F.lit(False))


def _rows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def transformed(vectors: DataFrame, id: str, vector: str, width: int, scale: int) -> DataFrame:
    """(id, coded): coefficients of floor(``scale`` times each component), of vectors with ``width`` finite components."""
    matrix = walsh(width)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.floor(_rows(batch, "vector", width) * float(scale))
            if np.abs(whole).max(initial=0) >= LARGEST:
                raise ValueError(f"a component is {LARGEST} or more after scaling: distances would not fit 64 bits")
            coded = (whole.astype(np.int64) @ matrix.T).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, coded.size + 1, width, dtype=np.int32)), pa.array(coded.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "coded"])

    known = vectors.where(_finite(F.col(vector), width))
    slim = known.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return slim.mapInArrow(code, "id long, coded array<int>")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _sums(coded: DataFrame, centres: np.ndarray) -> DataFrame:
    """(number, n, sums): one row for each centroid of a task that has vectors there."""
    width = centres.shape[1]
    matrix = walsh(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centres), np.int64), np.zeros(centres.shape, np.int64)
        for batch in _chunks(batches):
            rows = _rows(batch, "coded", width).astype(np.int64)
            number, _ = nearest_centroids(rows, centres)
            n += np.bincount(number, minlength=len(centres))
            np.add.at(sums, number, rows)
        met = np.flatnonzero(n)
        plain = (sums[met] @ matrix) // width  # exact: the transform's inverse
        kinds = [pa.array(met, pa.int64()), pa.array(n[met], pa.int64()), pa.array(plain.tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(kinds, ["number", "n", "sums"])

    return coded.select("coded").mapInArrow(add, "number long, n long, sums array<long>")


def _assigned(coded: DataFrame, centres: np.ndarray) -> DataFrame:
    width = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            number, total = nearest_centroids(_rows(batch, "coded", width).astype(np.int64), centres)
            columns = [batch.column("id"), pa.array(number, pa.int32()), pa.array(total // width, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    return coded.mapInArrow(assign, "id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2",
    id: str = "vec_id",
    vector: str = "embedding",
    width: int = 64,
    scale: int = 256,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) of every vector kept.

    Kept are vectors of exactly ``width`` components, none null or non-finite, as the integers
    floor(``scale`` * x). The first centroids are the ``k`` vectors with the smallest sha256 of
    ``seed:id``, in that order. A round assigns every vector to its nearest centroid (ties: the
    smaller number) and moves each centroid that has vectors to the floor of their mean; then all
    are assigned once more. ``distance`` is squared, the inertias are its sums over a cluster and
    over all, ``centroid`` is the final one and the digest that of its components joined by commas.

    Repeated rows count as often as they occur; rows equal in id start in the order of their
    coefficients, rows without id after all others. Fewer vectors than ``k`` give as many
    centroids; none give no rows. Zero vectors are vectors like others. A component of 2^23 or more
    after scaling is an error. Other columns are not read. Only the ``k`` centroids and their sums
    meet on the driver.
    """
    coded = cut_lineage(transformed(vectors, id, vector, width, scale))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = coded.orderBy(mark.asc_nulls_last(), "coded").limit(k).select("coded").collect()
    matrix = walsh(width)
    centres = np.array([r.coded for r in first], dtype=np.int64).reshape(len(first), width) @ matrix // width
    for _ in range(rounds if len(first) else 0):
        sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
        for number, n, *total in _sums(coded, centres @ matrix.T).groupBy("number").agg(F.sum("n"), *sums).collect():
            centres[number] = [s // n for s in total]
    found = cut_lineage(_assigned(coded, centres @ matrix.T) if len(first) else coded.selectExpr("id", "0 AS cluster", "0L AS distance"))
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    texts = [",".join(map(str, c)) for c in centres.tolist()]

    def of(values: list, kind: str) -> Column:
        return F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster"))

    return found.select(
        F.col("id").alias(id),
        "cluster",
        "distance",
        of([inertia.get(i, 0) for i in range(len(texts))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.split(of(texts, "string"), ",").cast("array<long>").alias("centroid"),
        of([hashlib.sha256(t.encode()).hexdigest() for t in texts], "string").alias("centroid_sha256"),
    )
