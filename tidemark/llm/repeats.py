"""Removal of byte strings that occur more than once, by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``length`` bytes, most significant digit first, and a group that
is down to one suffix is dropped; groups that are still equal at full depth are the repeated
windows.

1. First digit: a gram of half the length. Of the suffixes that could start a window only those at
   anchors are sorted: a window's anchor is the position of its smallest gram hash, which depends
   on the window's bytes alone, so equal windows have equal anchors at the same offset.
2. An anchor stands for the windows at offsets 0 to ``length - gram`` before it. Anchors with the
   same gram and the same surroundings form a class; in a class of two or more all windows are
   repeated, and one anchor of it goes on.
3. Next digits: a group of many classes is split by the bytes that all windows of half the offsets
   have in common, again and again. Small groups are compared byte by byte in one task.

All windows of an anchor contain its gram, so the bytes covered by its repeated windows are one
interval, and only its ends are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_length
from tidemark.session import cut_lineage

SMALL_GROUP = 512  # classes that one task compares; larger groups are split by further digits
_PIECE = 1 << 20  # window starts hashed at once
_PAIRS = 8192  # surroundings compared at once
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_NODE = ["g1", "g2", "lo", "hi"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Anchors:
    """Finds the anchors of all windows of ``length`` bytes, by their grams' rolling hashes."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.size = 0

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.size = min(max(n, 2 * self.size), _PIECE + self.length)
            self.up = _powers(_BASE, self.size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), self.size)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, wide = len(data), self.length - self.gram + 1
        self._grow(n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.down[:n], out=sums[1:])
        grams = n - self.gram + 1
        hashes = _mixed((sums[self.gram :] - sums[:grams]) * self.up[:grams])
        keys = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(grams, dtype=np.uint64)
        padded = np.full(-(-grams // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:grams] = keys
        blocks = padded.reshape(-1, wide)
        first = np.minimum.accumulate(blocks, axis=1).ravel()
        last = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - self.length + 1
        best = np.minimum(last[:windows], first[wide - 1 : wide - 1 + windows])
        at = (best & np.uint64(0xFFFFFF)).astype(np.int64)
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        return at, hashes[at].view(np.int64)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions and gram hashes of the anchors of a text."""
        data = np.frombuffer(text, dtype=np.uint8)
        places, hashes = [], []
        for start in range(0, len(data) - self.length + 1, _PIECE):
            at, found = self._piece(data[start : start + _PIECE + self.length - 1])
            places.append(at + start)
            hashes.append(found)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, first = np.unique(np.concatenate(places), return_index=True)
        return at, np.concatenate(hashes)[first]


def _find_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for batch in batches:
            found = [anchors.of(value.as_buffer().to_pybytes()) for value in batch.column("text")]
            index = pa.array(np.repeat(np.arange(batch.num_rows), [len(at) for at, _ in found]))
            at = np.concatenate([at for at, _ in found] or [np.zeros(0, np.int64)])
            h = np.concatenate([h for _, h in found] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(index), batch.column("k2").take(index), pa.array(at, pa.int64()), pa.array(h, pa.int64())],
                ["k1", "k2", "pos", "h"],
            )

    return texts.mapInArrow(find, "k1 long, k2 long, pos long, h long")


def _surroundings(texts: DataFrame, length: int, gram: int, bytes_too: bool) -> DataFrame:
    """A row for each anchor of (k1, k2, text, anchors): what is around it, as bytes or as a class.

    ``lead`` and ``tail`` are the bytes before and from the anchor, cut at the text's ends.
    """
    reach = length - gram

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("k1", "k2", "pos", "h", "lead", "tail", "s1", "s2", "around")}
            for k1, k2, text, anchors in zip(*(batch.column(c) for c in ("k1", "k2", "text", "anchors"))):
                data = text.as_buffer().to_pybytes()
                for anchor in anchors.as_py():
                    pos = anchor["pos"]
                    lead, tail = min(pos, reach), min(len(data) - pos, length)
                    around = data[pos - lead : pos + tail]
                    row = [k1.as_py(), k2.as_py(), pos, anchor["h"], lead, tail]
                    row += [0, 0, around] if bytes_too else [xxhash.xxh3_64_intdigest(around, lead) - (1 << 63), xxhash.xxh64_intdigest(around, tail) - (1 << 63), b""]
                    for column, value in zip(out.values(), row):
                        column.append(value)
            arrays = [pa.array(v, pa.binary() if c == "around" else pa.int64()) for c, v in out.items()]
            yield pa.RecordBatch.from_arrays(arrays, list(out))

    names = "k1 long, k2 long, pos long, h long, lead long, tail long, s1 long, s2 long, around binary"
    return texts.mapInArrow(look, names)


def _sk() -> Column:
    return F.xxhash64("k1", "k2", "pos")


def _classes(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Split rows with a node and a class (s1, s2) into intervals of shared classes and one row a class.

    A row's windows are those at offsets lo to hi that lie in its text; rows without any are dropped.
    """
    left, right = F.least("lead", "hi"), F.least("tail", length - F.col("lo"))
    rows = rows.where(left + right >= length)
    key = [*_NODE, "s1", "s2"]
    classes = rows.withColumn("sk", _sk()).groupBy(*key).agg(F.min("sk").alias("first"), F.max("sk").alias("last"))
    joined = rows.withColumn("sk", _sk()).join(classes, key)
    shared = joined.where("first < last").select(
        "k1", "k2", (F.col("pos") - left).alias("start"), (F.col("pos") + right).alias("end")
    )
    return shared, joined.where("sk = first").drop("first", "last", "sk")


def _part(column: str, start: Column, size: Column) -> Column:
    return F.substring(F.col(column), (F.col("lead") - start + 1).cast("int"), size.cast("int"))


def _split(rows: DataFrame, length: int) -> DataFrame:
    """Children of hot nodes: both halves of the offsets, keyed by the bytes all their windows share."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2)
    halves = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi")))
    apart = rows.where("lo < hi").withColumn("half", F.explode(halves))
    apart = apart.withColumn("lo", F.col("half.lo")).withColumn("hi", F.col("half.hi")).drop("half")
    apart = apart.where((F.col("lo") <= F.col("lead")) & (length - F.col("hi") <= F.col("tail")))
    common = _part("around", F.col("lo"), length - (F.col("hi") - F.col("lo")))
    left, right = F.least("lead", "hi"), F.least("tail", length - F.col("lo"))
    own = _part("around", left, left + right)
    return (
        apart.withColumn("g1", F.xxhash64(common))
        .withColumn("g2", F.xxhash64(F.lit(1), common))
        .withColumn("s1", F.xxhash64(left, right, own))
        .withColumn("s2", F.xxhash64(F.lit(1), left, right, own))
    )


def _extents(same: np.ndarray) -> np.ndarray:
    """For each row of booleans the number of leading trues."""
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def _compare(rows: list[tuple], length: int, reach: int) -> list[tuple[int, int, int, int]]:
    """Intervals of repeated windows for whole groups: (node, lo, hi, k1, k2, pos, lead, tail, around) in order of node."""
    n = len(rows)
    lead, tail = np.array([r[6] for r in rows]), np.array([r[7] for r in rows])
    lo, hi = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    around = np.zeros((n, reach + length), dtype=np.uint8)
    for i, row in enumerate(rows):
        around[i, reach - row[6] : reach + row[7]] = np.frombuffer(row[8], dtype=np.uint8)
    new = np.array([i == 0 or rows[i][0] != rows[i - 1][0] for i in range(n)])
    group = np.cumsum(new)
    most, least = np.full(n, -1), np.full(n, length)
    for shift in range(1, int(np.bincount(group).max())):
        i = np.flatnonzero(group[:-shift] == group[shift:])
        for part in range(0, len(i), _PAIRS):
            a = i[part : part + _PAIRS]
            b = a + shift
            same = around[a] == around[b]
            left = np.minimum(_extents(same[:, :reach][:, ::-1]), np.minimum(lead[a], lead[b]))
            right = np.minimum(_extents(same[:, reach:]), np.minimum(tail[a], tail[b]))
            low, high = np.maximum(lo[a], length - right), np.minimum(hi[a], left)
            good = low <= high
            for side in (a[good], b[good]):
                np.maximum.at(most, side, high[good])
                np.minimum.at(least, side, low[good])
    return [(rows[i][3], rows[i][4], rows[i][5] - int(most[i]), rows[i][5] - int(least[i]) + length) for i in np.flatnonzero(most >= 0)]


def _compare_groups(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Intervals of repeated windows within nodes of at most ``SMALL_GROUP`` rows."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def done(rows: list[tuple]) -> pa.RecordBatch:
            found = _compare(rows, length, length - gram) if rows else []
            columns = list(zip(*found)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "start", "end"])

        for batch in batches:
            at = [batch.column(c).to_pylist() for c in (*_NODE, "k1", "k2", "pos", "lead", "tail", "around")]
            for g1, g2, lo, hi, k1, k2, pos, lead, tail, around in zip(*at):
                node = (g1, g2, lo, hi)
                if len(waiting) >= SMALL_GROUP and waiting[-1][0] != node:
                    yield done(waiting)
                    waiting = []
                if not waiting or waiting[-1][0] != node or waiting[-1][3:6] != (k1, k2, pos):
                    waiting.append((node, lo, hi, k1, k2, pos, lead, tail, around))
        yield done(waiting)

    ordered = rows.repartition(*_NODE).sortWithinPartitions(*_NODE, "k1", "k2", "pos")
    return ordered.mapInArrow(compare, "k1 long, k2 long, start long, end long")


def _spans(texts: DataFrame, intervals: DataFrame) -> DataFrame:
    """(k1, k2, spans, n_removed, kept_sha256): intervals merged and cut out of their texts."""
    listed = intervals.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    kind = "k1 long, k2 long, spans array<struct<start: long, end: long>>, n_removed long, kept_sha256 string"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, removed, digests = [], [], []
            for text, found in zip(batch.column("text"), batch.column("found")):
                data, merged = memoryview(text.as_buffer()), []
                for start, end in sorted((x["start"], x["end"]) for x in found.as_py()):
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], end)
                    else:
                        merged.append({"start": start, "end": end})
                kept, at = hashlib.sha256(), 0
                for piece in merged:
                    kept.update(data[at : piece["start"]])
                    at = piece["end"]
                kept.update(data[at:])
                spans.append(merged)
                removed.append(sum(piece["end"] - piece["start"] for piece in merged))
                digests.append(kept.hexdigest())
            arrays = [batch.column("k1"), batch.column("k2"), pa.array(spans, span), pa.array(removed, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "spans", "n_removed", "kept_sha256"])

    return texts.select("k1", "k2", "text").join(listed, ["k1", "k2"]).mapInArrow(cut, kind)


def _intervals(involved: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, start, end): what repeated windows cover, for texts with their anchors."""
    reach = length - gram
    root = {"g1": F.col("h"), "g2": F.lit(0).cast("long"), "lo": F.lit(0).cast("long"), "hi": F.lit(reach).cast("long")}
    spots = cut_lineage(_surroundings(involved, length, gram, bytes_too=False).drop("around").withColumns(root))
    shared, single = _classes(spots, length)
    found, single = [shared], cut_lineage(single)
    several = single.groupBy("g1").agg(F.count("*").alias("n")).where("n > 1").select("g1")
    going = single.join(several, "g1", "left_semi").groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "h")).alias("anchors"))
    texts = involved.select("k1", "k2", "text").join(going, ["k1", "k2"])
    rows = cut_lineage(_surroundings(texts, length, gram, bytes_too=True).withColumns(root))
    while True:
        sizes = cut_lineage(rows.groupBy(*_NODE).agg(F.count("*").alias("n")).where("n > 1"))
        small = rows.join(sizes.where(F.col("n") <= SMALL_GROUP), _NODE, "left_semi")
        found.append(_compare_groups(small, length, gram))
        hot = sizes.where(F.col("n") > SMALL_GROUP)
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, found)
        shared, rows = _classes(cut_lineage(_split(rows.join(hot, _NODE, "left_semi"), length)), length)
        found.append(shared)
        rows = cut_lineage(rows)


def repeated_spans(docs: DataFrame, length: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) for every row of ``docs``.

    A byte is removed if it lies in a string of ``length`` bytes (two at least) that also starts
    at another place, in the same text or another, overlaps included. Texts are UTF-8 bytes, null
    counts as empty; matches never cross texts. ``spans`` are the removed runs in order,
    ``kept_sha256`` is the digest of the bytes left. Repeated rows are copies of each other, with
    the same id or not. No rows give no rows. Other columns are not read.
    """
    if length < 2:
        raise ValueError("length must be 2 or more")
    gram = (length + 1) // 2
    content = F.coalesce(F.col(text), F.lit(""))
    known = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(content).alias("k1"),
        F.xxhash64(F.lit(1), content).alias("k2"),
        F.xxhash64(F.col(id)).alias("row"),
        content.cast("binary").alias("text"),
        byte_length(content).alias("n_bytes"),
    )
    long = known.where(F.col("n_bytes") >= length)
    anchors = cut_lineage(_find_anchors(long.select("k1", "k2", "text"), length, gram))
    again = anchors.withColumn("sk", _sk()).groupBy("h").agg(F.min("sk").alias("first"), F.max("sk").alias("last"))
    met = anchors.join(again.where("first < last").select("h"), "h", "left_semi")
    listed = met.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "h")).alias("anchors"))
    copies = long.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    listed = listed.join(copies.select("k1", "k2", "row"), ["k1", "k2"])
    involved = cut_lineage(long.select("k1", "k2", "row", "text").join(listed, ["k1", "k2", "row"]).drop("row"))

    cut = _spans(involved, _intervals(involved, length, gram)).dropDuplicates(["k1", "k2"])
    copied = copies.where("n > 1").select("k1", "k2", F.lit(True).alias("copied"))
    slim = known.select("id", "k1", "k2", "n_bytes", F.sha2("text", 256).alias("whole"))
    joined = slim.join(copied, ["k1", "k2"], "left").join(cut, ["k1", "k2"], "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    all_gone = F.col("copied").isNotNull()
    return joined.select(
        F.col("id").alias(id),
        "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(all_gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
