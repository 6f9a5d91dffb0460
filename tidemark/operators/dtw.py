"""Sequences and their copies, landmarks, and the time-warping distances to them.

The full distance matrix is never built. Copies are merged first; ``near`` then finds the pairs
within a limit and the nearest neighbours, exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.kernels import CANDIDATES_AT_ONCE, dtw_rows, lower_bounds
from tidemark.operators.near import nearest_sequences, pairs_in_blocks, pairs_of_blocks, pairs_within, stacked

DISTANCES_AT_ONCE = 1 << 20  # to landmarks, of the rows that a task measures and hands on together

__all__ = ["dtw_rows", "lower_bounds", "nearest_sequences", "pairs_in_blocks", "pairs_of_blocks", "pairs_within"]


# ---- sequences ---------------------------------------------------------------------------


def distinct_sequences(df: DataFrame, key: str, values: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, seq_id, values, copies): one row per different array, named by its smallest key."""
    return (
        df.groupBy(*groups, F.col(values).alias("values"))
        .agg(F.min(key).alias("seq_id"), F.count("*").alias("copies"))
        .select(*groups, "seq_id", "values", "copies")
    )


def members(df: DataFrame, key: str, values: str, distinct: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, key, seq_id): which distinct sequence each key has."""
    named = distinct.select(*groups, F.col("values").alias(values), "seq_id")
    return df.join(named, [*groups, values]).select(*groups, key, "seq_id")


def label_members(labelled: DataFrame, belongs: DataFrame, key: str, seq: str = "seq_id") -> DataFrame:
    """The labels of distinct sequences given to every key that has them; ``belongs`` is of ``members``."""
    named = labelled.withColumnRenamed(seq, "_seq")
    joined = belongs.join(named, belongs["seq_id"] == named["_seq"]).drop("_seq", "seq_id")
    return joined.withColumnRenamed(key, seq).select(*labelled.columns)


def nearest_members(nearest: DataFrame, belongs: DataFrame, key: str, k: int) -> DataFrame:
    """(i, j, dist, pos): the ``k`` nearest other keys of every key, copies at distance 0 among them.

    Of the keys of one sequence at most k + 1 can be among a key's neighbours, the smallest ones.
    """
    keys = belongs.select("seq_id", F.col(key).alias("j"))
    first = keys.withColumn("n", F.row_number().over(Window.partitionBy("seq_id").orderBy("j"))).where(F.col("n") <= k + 1).drop("n")
    same = first.select("seq_id", F.col("seq_id").alias("other"), F.lit(0.0).alias("dist")).distinct()
    different = nearest.select(F.col("i").alias("seq_id"), F.col("j").alias("other"), "dist")
    offered = same.unionByName(different).join(first.withColumnRenamed("seq_id", "other"), "other").drop("other")
    order = Window.partitionBy("seq_id").orderBy("dist", "j")
    offered = offered.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    pairs = belongs.select("seq_id", F.col(key).alias("i")).join(offered, "seq_id").where(F.col("i") != F.col("j"))
    ranked = pairs.withColumn("pos", F.row_number().over(Window.partitionBy("i").orderBy("dist", "j")))
    return ranked.where(F.col("pos") <= k).select("i", "j", "dist", "pos")


# ---- landmarks ---------------------------------------------------------------------------

def pick_landmarks(distinct: DataFrame, count: int) -> list[tuple[int, list[float]]]:
    """Up to ``count`` sequences in a fixed pseudo-random order.

    They come to the driver and go to every task, so the caller's ``count`` is what bounds them:
    10,000 sequences of a month are 2.5 MB.
    """
    if count < 1:
        raise ValueError("count must be 1 or more")
    rows = distinct.select("seq_id", "values").orderBy(F.xxhash64("seq_id"), "seq_id").limit(count).collect()
    return [(r["seq_id"], list(r["values"])) for r in rows]


def landmark_table(landmarks: Sequence[tuple[int, Sequence[float]]], radius: int) -> np.ndarray:
    """Distances among the landmarks themselves."""
    values = [np.asarray(v, dtype=float) for _, v in landmarks]
    table = np.zeros((len(values), len(values)))
    for i, mark in enumerate(values):
        for n in {len(v) for v in values}:
            at = [j for j, v in enumerate(values) if len(v) == n]
            block = np.stack([values[j] for j in at])
            table[i, at] = dtw_rows(block, np.broadcast_to(mark, (len(at), len(mark))), radius)
    return table


def distances_to_landmarks(
    sequences: DataFrame,
    landmarks: Sequence[tuple[int, Sequence[float]]],
    radius: int = 3,
    keep: Sequence[str] = ("seq_id",),
    finish: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """(keep, values, distances): distance of each sequence to every landmark, in their order.

    ``finish`` turns a batch's distance matrix into the rows to keep instead.
    """
    marks = [np.asarray(values, dtype=float) for _, values in landmarks]
    source = sequences.select(*keep, "values")

    rows = max(1, DISTANCES_AT_ONCE // max(1, len(marks)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), rows):
                batch = whole.iloc[start : start + rows]
                out = np.empty((len(batch), len(marks)))
                lengths = batch["values"].map(len).to_numpy()
                for n in np.unique(lengths):
                    at = np.flatnonzero(lengths == n)
                    block, some = np.stack(batch["values"].iloc[at].to_list()), max(1, CANDIDATES_AT_ONCE // len(at))
                    for places, alike in stacked(marks).values():
                        for first in range(0, len(places), some):
                            part = alike[first : first + some]
                            i, j = (g.ravel() for g in np.indices((len(at), len(part))))
                            found = dtw_rows(block[i], part[j], radius).reshape(len(at), len(part))
                            out[np.ix_(at, places[first : first + some])] = found
                yield batch.assign(distances=list(finish(out) if finish else out))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInPandas(measure, f"{kinds}, distances array<double>")
