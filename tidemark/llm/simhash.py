"""Near-duplicate texts by SimHash fingerprints and multi-index hashing.

The 64 bits of a fingerprint are cut into segments. Two fingerprints at two or fewer differing
bits have a common neighbour at one bit from each, so the balls of radius 1 that both enumerate,
segment by segment with the other segments unchanged, share a probe. The probe table is grouped,
matches of a probe are fetched, and complete distances are verified.

A bucket keyed by one segment alone may hold a third of all fingerprints (a large group of near
copies agrees in most bits); a probe of this table is within one bit of all its fingerprints, so
its bucket holds 65 at most, whatever the data. Equal fingerprints are merged first.

Two bits of 64 find copies that differ in few words. To find nearer to all copies of a similarity
of 0.8 and more, ``keep_one`` may look at several views: independent fingerprints of the same
shingles. Texts are then linked if they are within two bits in any view, still without a bucket
that grows with a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name
from tidemark.llm.components import components
from tidemark.session import cut_lineage

SEGMENT_BITS = 16
MAX_DISTANCE = 2
_BLOCK = 1 << 16  # shingles whose bits are counted at once
_MIX = 0x9E3779B97F4A7C15


def fingerprints_of(text: str | None, width: int, seed: int, views: int) -> list[int]:
    """Signed 64-bit SimHashes of a text's word shingles (lower-cased A-Z, ASCII white space).

    The first view takes the bits of the shingles' hashes, each other one those of a mix of them.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return [0] * views
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8")
    out = []
    for view in range(views):
        ones = np.zeros(64, dtype=np.int64)
        for start in range(0, len(hashes), _BLOCK):
            block = hashes[start : start + _BLOCK]
            if view:
                block = (block ^ (block >> np.uint64(29))) * np.uint64(2 * view + 1) * np.uint64(_MIX)
                block ^= block >> np.uint64(32)
            bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        most = (ones * 2 > len(hashes)).astype(np.uint8)
        out.append(int(np.packbits(most, bitorder="little").view("<i8")[0]))
    return out


def with_fingerprints(docs: DataFrame, text: str, columns: Sequence[str], width: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with a long column for each view of the SimHash of ``text``; null and wordless texts get 0."""
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(value.as_py(), width, seed, len(columns)) for value in batch.column(at)]
            views = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *views], [*batch.schema.names, *columns])

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in columns)]))


def _ball(fingerprint: Column) -> Column:
    """The fingerprint and, for each segment, its ball of radius 1 in place of the segment."""
    probes = [fingerprint]
    for start in range(0, 64, SEGMENT_BITS):
        for bit in range(start, start + SEGMENT_BITS):
            mask = 1 << bit
            probes.append(fingerprint.bitwiseXOR(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)))
    return F.array(*probes)


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints that connect all within ``MAX_DISTANCE`` bits.

    ``fingerprints`` has one long column ``fingerprint`` without repeats. Each probe links its
    fingerprints to the smallest of them, at most 64 rows a fingerprint.
    """
    probes = fingerprints.select("fingerprint", F.explode(_ball(F.col("fingerprint"))).alias("probe"))
    probes = probes.where("fingerprint IS NOT NULL AND probe IS NOT NULL").repartition("probe")  # one shuffle for both readings
    shared = probes.groupBy("probe").agg(F.min("fingerprint").alias("first"), F.max("fingerprint").alias("last"))
    matches = probes.join(shared.where("first < last").select("probe", "first"), "probe").where("fingerprint <> first")
    verified = matches.where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("first"))) <= MAX_DISTANCE)
    return verified.select(F.col("fingerprint").alias("a"), F.col("first").alias("b")).distinct()


def _view_links(prints: DataFrame, view: str) -> DataFrame:
    """(a, b): links between fingerprints of the first view that another view asks for.

    A fingerprint of the other view stands for the smallest first one that it occurs with.
    """
    seen = cut_lineage(prints.select("fingerprint", F.col(view).alias("other")).distinct())
    stands = cut_lineage(seen.groupBy("other").agg(F.min("fingerprint").alias("rep")))
    same = seen.join(stands, "other").where("fingerprint <> rep").select(F.col("fingerprint").alias("a"), F.col("rep").alias("b"))
    near = links(stands.select(F.col("other").alias("fingerprint")))
    for end in ("a", "b"):
        near = near.join(stands.select(F.col("other").alias(end), F.col("rep").alias(f"rep_{end}")), end)
    return same.unionByName(near.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).where("a <> b"))


def classes(prints: DataFrame, views: Sequence[str] = ()) -> DataFrame:
    """(fingerprint, root, component_id) for every distinct fingerprint of ``prints`` (id, fingerprint, views).

    ``component_id`` is the smallest id of the class, null only if all its ids are null.
    """
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("id").alias("id")))
    edges = links(distinct.select("fingerprint"))
    if views:
        # each view is written before the next, so that their probes are not on disk together
        edges = reduce(DataFrame.unionByName, [cut_lineage(e) for e in (edges, *(_view_links(prints, v) for v in views))])
    roots = components(edges)
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "id", F.coalesce("root", "fingerprint").alias("root")
    )
    return rooted.join(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "root").drop("id")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fingerprint hex, component_id) for every row of ``docs``.

    Null texts count as empty; empty texts have fingerprint zero and are linked like any other.
    Repeated rows give repeated rows. No rows give no rows. Other columns are not read.
    """
    known = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    prints = cut_lineage(with_fingerprints(known, "text", ["fingerprint"], width, seed).drop("text"))
    found = prints.join(classes(prints), "fingerprint")
    return found.select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_rows(docs: DataFrame, rooted: DataFrame, id: str, text: str) -> DataFrame:
    """The row of ``docs`` that stays of each ``root`` of ``rooted`` (id, hash, root), as told in ``keep_one``."""
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    first = rooted.groupBy("root").agg(F.min(order).alias("row"))
    first = first.select(F.struct("row.id", "row.hash").alias("row"))
    rows = rooted.groupBy(F.struct("id", "hash").alias("row")).agg(F.count("*").alias("n"))
    key, kept, repeats = (free_name(docs, name) for name in ("key", "kept", "repeats"))
    chosen = cut_lineage(first.join(rows, "row").select(F.col("row").alias(kept), F.col("n").alias(repeats)))
    # structs are equal if their nulls are; both branches read one shuffle of the documents
    keyed = docs.withColumn(key, F.struct(F.col(id).alias("id"), text_hash.alias("hash")))
    found = keyed.join(chosen, F.col(key) == F.col(kept))
    once, again = found.where(F.col(repeats) == 1), found.where(F.col(repeats) > 1).dropDuplicates([key])
    return once.unionByName(again).select(*docs.columns)


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42, views: int = 1
) -> DataFrame:
    """One row of each class of near duplicates, with all columns of ``docs``.

    Texts are linked that are within two bits in any of ``views`` independent fingerprints.
    The row with the smallest id stays, null ids last, then the smallest hash of the text; of
    rows equal in both any one stays. Nulls, empty texts and empty tables as in
    ``near_duplicates``.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    known = docs.select(F.col(id).alias("id"), text_hash.alias("hash"), F.col(text).alias("text"))
    others = [f"view{i}" for i in range(1, views)]
    prints = cut_lineage(with_fingerprints(known, "text", ["fingerprint", *others], width, seed).drop("text"))
    return first_rows(docs, prints.join(classes(prints, others), "fingerprint"), id, text)
