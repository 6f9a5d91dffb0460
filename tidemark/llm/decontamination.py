"""Benchmark decontamination by spaced-seed hashing.

A seed is a window of tokens of which a fixed mask keeps some; its hash ignores the others, so a
substituted token there does not hide a copied passage. Seeds of training texts are joined with
seeds of benchmark items, and the overlap around each hit is verified token by token.

Training seeds first pass a bit table of fixed size that all benchmark seeds are set in, so that
only seeds which may have a partner are shuffled. A full table lets more pass, never fewer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name
from tidemark.session import cut_lineage

#: Kept token positions of a window; the spans are at most MIN_TOKENS.
MASKS = ("1110111", "11011011", "11101101", "10110111")
#: With these, some seed hits every pattern of up to 20 % differing tokens in 8 to 25 tokens, and longer
#: stretches with 80 % hold one of 13 to 25.
WIDE_MASKS = ("1110000111", "1110100011", "1100011011")
MIN_TOKENS = 8  # items with fewer tokens are copied only whole and without a change
MIN_STRETCH = 13  # tokens of a copied stretch that is not a whole item
SIMILARITY = 0.8
FILTER_BITS = 24  # the bit table has 2**24 bits, 2 MB; a seed sets one bit by its low and one by its next bits
_PENALTY = 4  # of a differing token, at a similarity of 0.8
#: Non-ASCII spaces and marks, with full-width and small forms.
_SEPARATORS = re.compile(
    "[\\u00a0-\\u00a9\\u00ab-\\u00b1\\u00b4-\\u00b8\\u00bb\\u00bf\\u2000-\\u206f\\u3000-\\u3004\\u3008-\\u3020\\u3030\\u303d-\\u303f"
    "\\u30fb\\ufe10-\\ufe19\\ufe30-\\ufe6f\\ufeff\\uff01-\\uff0f\\uff1a-\\uff20\\uff3b-\\uff40\\uff5b-\\uff65\\uffe0-\\uffee]"
)
#: Letters of scripts without spaces between words (Thai, Lao, Burmese, Khmer, kana, Han), each with the marks after it.
_UNSPACED = re.compile(
    "[\\u0e01-\\u0eff\\u1000-\\u109f\\u1780-\\u17ff\\u3005-\\u3007\\u3021-\\u302f\\u3031-\\u303c\\u3041-\\u30ff\\u31f0-\\u31ff"
    "\\u3400-\\u4dbf\\u4e00-\\u9fff\\uf900-\\ufaff\\uff66-\\uff9f\\U00020000-\\U0003ffff]"
    "[\\u0e31\\u0e34-\\u0e3a\\u0e47-\\u0e4e\\u0eb1\\u0eb4-\\u0ebc\\u0ec8-\\u0ece\\u102b-\\u103e\\u17b4-\\u17d3\\u3099\\u309a\\uff9e\\uff9f]*"
)
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(31))


class Tokens:
    """Token hashes of texts: runs of ASCII letters, digits and non-ASCII characters, lower-cased.

    Where words are not parted by spaces, every character is a token.
    """

    def __init__(self) -> None:
        self.word = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
        self.values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of(self, text: str | None) -> np.ndarray:
        text = (text or "").lower()
        if not text.isascii():
            text = _UNSPACED.sub(r" \g<0> ", _SEPARATORS.sub(" ", text))
        data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        self._powers(len(data) + 1)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], self.word[data], [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.down[: len(data)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.up[starts])


def seeds(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all seeds of a token sequence, mask by mask."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for number, mask in enumerate(MASKS + WIDE_MASKS):
        n = len(tokens) - len(mask) + 1
        if n > 0:
            h = np.full(n, number + 1, dtype=np.uint64)
            for offset in (i for i, bit in enumerate(mask) if bit == "1"):
                h = h * np.uint64(_BASE) + tokens[offset : offset + n]
            places.append(np.arange(n))
            hashes.append(_mixed(h))
    return np.concatenate(places), np.concatenate(hashes)


def short_seeds(tokens: np.ndarray, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """First positions and hashes of all runs of the given lengths under ``MIN_TOKENS``."""
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for length in lengths:
        n = len(tokens) - length + 1
        if n > 0:
            h = np.full(n, -length % (1 << 64), dtype=np.uint64)
            for offset in range(length):
                h = h * np.uint64(_BASE) + tokens[offset : offset + n]
            different, first = np.unique(_mixed(h), return_index=True)
            places.append(first)
            hashes.append(different)
    return np.concatenate(places), np.concatenate(hashes)


def _items(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """(item, tokens, positions, hashes) of benchmark items with tokens."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in batches:
            tokens = [known.of(value.as_py()) for value in batch.column(1)]
            found = [seeds(t) if len(t) >= MIN_TOKENS else short_seeds(t, [len(t)] if len(t) else []) for t in tokens]
            arrays = [
                batch.column(0),
                pa.array([t.view(np.int64) for t in tokens], pa.list_(pa.int64())),
                pa.array([p for p, _ in found], pa.list_(pa.int64())),
                pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "tokens", "positions", "hashes"])

    kind = benchmark.select(id).schema[0].dataType.simpleString()
    named = benchmark.select(F.col(id).alias("item"), F.col(text).alias("text")).distinct()
    return named.mapInArrow(
        read, f"item {kind}, tokens array<long>, positions array<long>, hashes array<long>"
    ).where(F.size("tokens") > 0)


def _bit_table(hashes: DataFrame) -> bytes:
    """The bits of all hashes; its size is fixed by FILTER_BITS, so it may go to every task."""
    two = F.array(F.col("h"), F.shiftrightunsigned("h", FILTER_BITS))
    bits = hashes.select(F.explode(two).alias("part")).select(F.col("part").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit"))
    words = bits.selectExpr("shiftright(bit, 5) AS word", "shiftleft(1L, cast(bit % 32 AS int)) AS bits")
    table = np.zeros((1 << FILTER_BITS) // 32, dtype=np.uint32)
    for word, bits in words.groupBy("word").agg(F.bit_or("bits")).collect():  # at most 2**(FILTER_BITS - 5) rows
        table[word] = bits
    return table.tobytes()


def _is_set(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64((1 << FILTER_BITS) - 1)
    return (table[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def _training_hits(texts: DataFrame, table: bytes, short: Sequence[int]) -> DataFrame:
    """(k1, k2, tokens, positions, hashes) of the texts of which a seed is in the bit table.

    ``short`` are the lengths of the items under ``MIN_TOKENS``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = Tokens(), np.frombuffer(shared.value, dtype=np.uint32)
        for batch in batches:
            rows, tokens, positions, hashes = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                own = known.of(value.as_py())
                at, h = map(np.concatenate, zip(seeds(own), short_seeds(own, short)))
                hit = _is_set(bits, h)
                hit[hit] = _is_set(bits, h[hit] >> np.uint64(FILTER_BITS))
                if hit.any():
                    rows.append(row)
                    tokens.append(own.view(np.int64))
                    positions.append(at[hit])
                    hashes.append(h[hit].view(np.int64))
            index, long = pa.array(rows, pa.int64()), pa.list_(pa.int64())
            arrays = [batch.column("k1").take(index), batch.column("k2").take(index)]
            arrays += [pa.array(x, long) for x in (tokens, positions, hashes)]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "tokens", "positions", "hashes"])

    return texts.mapInArrow(read, "k1 long, k2 long, tokens array<long>, positions array<long>, hashes array<long>")


def overlap(item: np.ndarray, text: np.ndarray, n_item: int) -> tuple[int, int] | None:
    """(matching tokens, length) of the overlap of aligned tokens, or None if it is no copy.

    ``item`` and ``text`` are aligned and cut to where both have tokens. A copy is a whole item
    with 80 % of its tokens (all of them under ``MIN_TOKENS``), or a stretch of ``MIN_STRETCH`` or more tokens in which 80 % match; the
    longest such stretch is returned.
    """
    same = item == text
    if n_item < MIN_TOKENS:
        return (n_item, n_item) if same.sum() == n_item else None
    if same.sum() >= SIMILARITY * n_item:
        return int(same.sum()), n_item
    # a stretch has 80 % if the steps do not fall from its start to its end; the first start at or below an end is a new minimum
    steps = np.concatenate(([0], np.cumsum(np.where(same, 1, -_PENALTY))))
    starts = np.searchsorted(-np.minimum.accumulate(steps), -steps)
    end = int(np.argmax(np.arange(len(steps)) - starts))
    start = int(starts[end])
    return (int(same[start:end].sum()), end - start) if end - start >= MIN_STRETCH else None


def _verified(pairs: DataFrame, kind: str) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                overlap(np.array(item.as_py()), np.array(text.as_py()), n.as_py())
                for item, text, n in zip(batch.column("own"), batch.column("part"), batch.column("n_item"))
            ]
            rows = pa.array([i for i, x in enumerate(found) if x], pa.int64())
            arrays = [batch.column(c).take(rows) for c in ("k1", "k2", "item")]
            arrays += [pa.array([x[j] for x in found if x], pa.int64()) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, ["k1", "k2", "item", "matched", "length"])

    return pairs.mapInArrow(verify, f"k1 long, k2 long, item {kind}, matched long, length long")


def text_keys(text: str):
    content = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(content), F.xxhash64(F.lit(1), content)


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(k1, k2, item, matched, length): the best overlap of each text with each item it copies.

    ``k1`` and ``k2`` are the ``text_keys`` of a text; copies of a text have one row an item.
    """
    items = cut_lineage(_items(benchmark, item, item_text))
    planted = items.select("item", F.explode(F.arrays_zip("positions", "hashes")).alias("s")).select(
        "item", F.col("s.positions").alias("at"), F.col("s.hashes").alias("h")
    )
    k1, k2 = text_keys(text)
    known = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text).alias("text"))
    n_tokens = F.size("tokens")
    short = [r.n for r in items.where(n_tokens < MIN_TOKENS).select(n_tokens.alias("n")).distinct().collect()]
    hits = cut_lineage(_training_hits(known, _bit_table(planted.select("h").distinct()), sorted(short)))
    spots = hits.select("k1", "k2", F.explode(F.arrays_zip("positions", "hashes")).alias("s")).select(
        "k1", "k2", F.col("s.positions").alias("pos"), F.col("s.hashes").alias("h")
    )
    met = spots.join(planted, "h").select("k1", "k2", "item", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    tokens = hits.select("k1", "k2", "tokens").dropDuplicates(["k1", "k2"])
    own = items.select("item", F.col("tokens").alias("item_tokens"))
    both = met.join(tokens, ["k1", "k2"]).join(own, met.item.eqNullSafe(own.item)).drop(own.item)
    skip, n_item = F.greatest(-F.col("shift"), F.lit(0)).cast("int"), F.size("item_tokens")
    first = F.greatest(F.col("shift"), F.lit(0)).cast("int")
    n = F.least(n_item - skip, F.size("tokens") - first)
    pairs = both.select(
        "k1", "k2", "item", n_item.alias("n_item"),
        F.slice("item_tokens", skip + 1, n).alias("own"), F.slice("tokens", first + 1, n).alias("part"),
    )
    kind = items.schema["item"].dataType.simpleString()
    best = F.max(F.struct("matched", "length")).alias("best")
    found = _verified(pairs, kind).groupBy("k1", "k2", "item").agg(best)
    return cut_lineage(found.select("k1", "k2", "item", "best.matched", "best.length"))


def leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, matched, length) for every row of ``docs`` and every item that it copies.

    ``length`` is the number of aligned tokens of the best overlap, ``matched`` how many agree.
    Null texts count as empty and copy nothing; items with fewer than ``MIN_TOKENS`` tokens are
    copied where they occur unchanged, items without tokens are not. Repeated rows of ``docs`` give repeated rows, repeated items count once. An empty
    table on either side gives no rows. Other columns are not read.
    """
    found = contaminated_texts(docs, benchmark, text, item, item_text)
    k1, k2 = text_keys(text)
    known = docs.select(F.col(id).alias("id"), k1.alias("k1"), k2.alias("k2"))
    return known.join(found, ["k1", "k2"]).select(F.col("id").alias(id), F.col("item").alias(item), "matched", "length")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that copy no benchmark item."""
    found = contaminated_texts(docs, benchmark, text, item, item_text)
    name = free_name(docs, "keys")
    bad = found.select(F.struct("k1", "k2").alias(name)).distinct()
    k1, k2 = text_keys(text)
    return docs.join(bad, F.struct(k1.alias("k1"), k2.alias("k2")) == F.col(name), "left_anti")
