"""Blocks of similar sequences, a tree of bounds over them, and searches by pairs of blocks.

Sequences are ordered along a space-filling curve through their piecewise means and cut into
blocks. A block knows the range of every item of its sequences, the same widened by the warping
band, and the ranges of their largest, smallest, first and last items. Together these bound
the warping distance of any pair of two blocks from below. Pairs of blocks are found from the top
of a tree of such ranges downwards, so that far parts of the table never meet, and only the
surviving pairs of blocks fetch their sequences. Searches fetch them by tiles, which are up to
``2**TILE_BITS`` blocks that follow each other: a tile is sent once for all pairs of blocks it has with another one.

Without any structure in the data (all distances alike) no bound can tell blocks apart and all pairs
of blocks remain, as in every exact search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.kernels import CANDIDATES_AT_ONCE, close_pairs
from tidemark.session import cut_lineage

BLOCK_ROWS = 128
PIECES, BITS = 8, 4  # piecewise means of a sequence, and bits of each in the curve
FAN = 4  # bits: nodes have up to 16 children
TOP = 256  # nodes that are paired without going through a level above them
TILES, TILE_BITS = 32, 7  # tiles of a table, if blocks suffice, and bits of the number of a block in its tile
JOINED = 64  # several blocks of a tile that are kept joined
TOGETHER = (4, 8)  # blocks of both tiles that meet in one call
NEXT = 4  # blocks that a block meets in one call on its way to the nearest sequences, with warping
FOUND_AT_ONCE = 8 * CANDIDATES_AT_ONCE  # pairs that a task hands on together
PACKED = "a long, b long, n long, total double, p binary, q binary, dist binary"  # pairs of sequences of two blocks
RANGES = ("lo", "hi", "wide_lo", "wide_hi", "mark_lo", "mark_hi")
_LOW = ("lo", "wide_lo", "mark_lo")


# ---- order -------------------------------------------------------------------------------


def _piece_means(values: Column) -> Column:
    def mean(i: Column) -> Column:
        size = F.size(values)
        start = F.floor(i * size / PIECES).cast("int")
        length = F.greatest(F.floor((i + 1) * size / PIECES).cast("int") - start, F.lit(1))
        piece = F.slice(values, F.least(start, size - 1) + 1, length)
        return F.aggregate(piece, F.lit(0.0), lambda a, x: a + x) / F.size(piece)

    return F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), mean)


def _measured(sequences: DataFrame) -> tuple[DataFrame, int, int]:
    """``sequences`` with ``z``, the bits of each piece's quantile number interleaved, and the least and largest length."""
    means = sequences.withColumn("means", _piece_means(F.col("values")))
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    cuts = [F.percentile_approx(F.col("means")[i], shares, 1000) for i in range(PIECES)]
    shortest, longest, *cuts = means.agg(F.min(F.size("values")), F.max(F.size("values")), *cuts).first()
    edges = F.lit([list(map(float, found or [0.0])) for found in cuts])
    numbers = F.zip_with("means", edges, lambda mean, cut: F.size(F.filter(cut, lambda c: c < mean)))
    bits = [
        F.shiftleft(F.shiftright(F.col("numbers")[i], bit).bitwiseAND(F.lit(1)).cast("long"), bit * PIECES + i)
        for i in range(PIECES)
        for bit in range(BITS)
    ]
    placed = means.withColumn("numbers", numbers).withColumn("z", reduce(add, bits))
    return placed.drop("means", "numbers"), shortest or 1, longest or 1


# ---- blocks ------------------------------------------------------------------------------


def _ranges(values: list[np.ndarray], width: int, reach: int) -> dict[str, np.ndarray]:
    """Ranges of a block's items by place; a place that some sequence lacks is not bounded."""
    lo, hi = np.full(width, np.inf), np.full(width, -np.inf)
    for v in values:
        np.minimum(lo[: len(v)], v, out=lo[: len(v)])
        np.maximum(hi[: len(v)], v, out=hi[: len(v)])
    shortest, longest = min(map(len, values)), max(map(len, values))
    wide_lo, wide_hi = np.full(width, -np.inf), np.full(width, np.inf)
    for i in range(min(width, shortest + reach)):
        window = slice(max(0, i - reach), min(longest, i + reach + 1))
        wide_lo[i], wide_hi[i] = lo[window].min(), hi[window].max()
    lo[shortest:], hi[shortest:] = -np.inf, np.inf
    marks = np.array([[v.max(), v.min(), v[0], v[-1]] for v in values])
    return {"lo": lo, "hi": hi, "wide_lo": wide_lo, "wide_hi": wide_hi, "mark_lo": marks.min(axis=0), "mark_hi": marks.max(axis=0)}


class Blocks:
    """The blocks of ``sequences`` (groups, seq_id, values, copies) in a written table.

    Columns: groups, block (the number of a range and of a block in it), seq_id, values and copies as arrays, the values
    once more as ``lengths`` and the bytes ``flat``, the ranges of ``RANGES``, and ``most``, what ``measure`` gives for a block's ids and values; the column ``carry`` of the sequences comes along as an
    array. Groups never share a block.
    """

    def __init__(self, sequences: DataFrame, radius: int, groups: Sequence[str] = (), measure: Callable[[list, list], float] | None = None, carry: str | None = None):
        self.radius, self.groups, self.tile_bits = radius, list(groups), TILE_BITS
        if "copies" not in sequences.columns:
            sequences = sequences.withColumn("copies", F.lit(1).cast("long"))
        extra = [carry] if carry else []
        known = sequences.select(*groups, "seq_id", "values", "copies", *extra).where(F.size("values") > 0)
        placed, shortest, self.width = _measured(known)
        self.id_type = known.schema["seq_id"].dataType.simpleString()
        kinds = "".join(f"`{g}` {known.schema[g].dataType.simpleString()}, " for g in groups)
        order = [*groups, "z"]
        ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order, "seq_id").withColumn("range", F.spark_partition_id())
        rows, width, reach, names = BLOCK_ROWS, self.width, radius + self.width - shortest, self.groups

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list = []
            number = 0

            def block(part: list) -> dict:
                nonlocal number
                values = [np.asarray(r.values_, dtype=float) for r in part]
                fields = {g: getattr(part[0], g) for g in names} | {"block": part[0].range << 32 | number, "values": values}
                number += 1
                fields |= {"lengths": [len(v) for v in values], "flat": np.concatenate(values).tobytes()}
                fields |= {c: [getattr(r, c) for r in part] for c in ("seq_id", "copies", *extra)}
                fields["most"] = measure(fields["seq_id"], values) if measure else np.inf
                return fields | _ranges(values, width, reach)

            def rest() -> list[dict]:
                """What is held in one block, or in two of equal size: no block of a few rows stays over."""
                parts = [held] if len(held) <= rows * 3 // 2 else [held[: len(held) // 2], held[len(held) // 2 :]]
                return [block(part) for part in parts if part]

            def same_groups(a, b) -> bool:
                return all(getattr(a, g) == getattr(b, g) or (pd.isna(getattr(a, g)) and pd.isna(getattr(b, g))) for g in names)

            for batch in batches:
                done = []
                for row in batch.itertuples(index=False):
                    if held and not same_groups(held[0], row):
                        done += rest()
                        held = []
                    held.append(row)
                    if len(held) == 2 * rows:
                        done.append(block(held[:rows]))
                        held = held[rows:]
                if done:
                    yield pd.DataFrame(done)
            if held:
                yield pd.DataFrame(rest())

        ranges = ", ".join(f"{r} array<double>" for r in RANGES)
        carried = "".join(f"`{c}` array<{known.schema[c].dataType.simpleString()}>, " for c in extra)
        schema = f"{kinds}block long, seq_id array<{self.id_type}>, `values` array<array<double>>, lengths array<int>, flat binary, copies array<long>, most double, {carried}{ranges}"
        packed = ranged.select(*groups, "seq_id", F.col("values").alias("values_"), "copies", F.col("range").cast("long"), *extra)
        self.rows = cut_lineage(packed.mapInPandas(cut, schema))

    # ---- pairs of blocks -----------------------------------------------------------------

    def _nodes(self, limit: Column) -> DataFrame:
        return self.rows.select(*self.groups, F.col("block").alias("node"), limit.alias("limit"), *RANGES)

    def _above(self, nodes: DataFrame, shift: int) -> DataFrame:
        """Parents of nodes: by number of the block in its range, or by number of the range."""
        low = F.lit((1 << 32) - 1).cast("long")
        inner = F.shiftleft(F.shiftright("node", 32), 32).bitwiseOR(F.shiftright(F.col("node").bitwiseAND(low), FAN))
        outer = F.shiftleft(F.shiftright("node", 32 + FAN), 32)
        parent = nodes.withColumn("parent", outer if shift else inner)
        names = [*self.groups, "parent"]
        long = parent.select(*names, "limit", *[F.transform(r, lambda x, i: F.struct(i.alias("i"), x.alias("x"))).alias(r) for r in RANGES])
        parts = None
        for r in RANGES:
            each = long.select(*names, F.explode(r).alias("e")).groupBy(*names, "e.i")
            least = each.agg((F.min if r in _LOW else F.max)("e.x").alias("x"))
            gathered = least.groupBy(*names).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias(r))
            parts = gathered if parts is None else parts.join(gathered, names)
        limits = parent.groupBy(*names).agg(F.max("limit").alias("limit"))
        return cut_lineage(parts.join(limits, names).withColumnRenamed("parent", "node").select(*self.groups, "node", "limit", *RANGES))

    def pairs(self, limit: Column, symmetric: bool = True) -> DataFrame:
        """(groups, a, b, bound): pairs of blocks that may hold a pair within the limit of ``a``.

        ``limit`` is a column of the blocks. A symmetric search has each unordered pair once and keeps it
        if the limit of one of both allows it. The pairs are those of the highest level with at most
        ``TOP`` nodes, then those of their children that the bounds allow, and so on down.
        """
        levels, shifts = [self._nodes(limit)], []
        while levels[-1].count() > TOP:
            several = levels[-1].where(F.col("node").bitwiseAND(F.lit((1 << 32) - 1).cast("long")) > 0).isEmpty()
            up = self._above(levels[-1], int(several))
            if several and up.count() == levels[-1].count():
                break  # one node a group
            levels.append(up)
            shifts.append(several)
        a, b = (self._named(levels[-1], end) for end in "ab")
        met = a.join(b, self._same("a", "b")) if self.groups else a.crossJoin(b)  # at most TOP nodes
        pairs = self._allowed(met, symmetric)
        for level in range(len(levels) - 2, -1, -1):
            low = F.lit((1 << 32) - 1).cast("long")
            above = (
                (lambda n: F.shiftleft(F.shiftright(n, 32 + FAN), 32))
                if shifts[level]
                else (lambda n: F.shiftleft(F.shiftright(n, 32), 32).bitwiseOR(F.shiftright(n.bitwiseAND(low), FAN)))
            )
            parents = cut_lineage(pairs).withColumnsRenamed({"a": "up_a", "b": "up_b", **{g: f"up_{g}" for g in self.groups}})
            for end in "ab":
                child = self._named(levels[level], end)
                same = [F.col(f"up_{g}").eqNullSafe(F.col(f"{end}_{g}")) for g in self.groups]
                parents = parents.join(child, [*same, F.col(f"up_{end}") == above(F.col(end))])
            pairs = self._allowed(parents, symmetric)
        return pairs

    def _named(self, nodes: DataFrame, end: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in (*self.groups, "limit", *RANGES)]
        )

    def _same(self, *ends: str) -> list[Column]:
        return [F.col(f"{ends[0]}_{g}").eqNullSafe(F.col(f"{ends[1]}_{g}")) for g in self.groups]

    def _allowed(self, met: DataFrame, symmetric: bool) -> DataFrame:
        def gap(one: str, two: str) -> Column:
            over = F.zip_with(f"{one}_lo", f"{two}_wide_hi", lambda x, y: x - y)
            under = F.zip_with(f"{two}_wide_lo", f"{one}_hi", lambda x, y: x - y)
            gaps = F.zip_with(over, under, lambda x, y: F.greatest(x, y, F.lit(0.0)))
            return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x))

        over = F.zip_with("a_mark_lo", "b_mark_hi", lambda x, y: x - y)
        under = F.zip_with("b_mark_lo", "a_mark_hi", lambda x, y: x - y)
        bound = F.greatest(F.array_max(over), F.array_max(under), gap("a", "b"), gap("b", "a"), F.lit(0.0)) * (1 - 1e-12)
        if symmetric:
            met = met.where(F.col("a") <= F.col("b"))
        limit = F.greatest("a_limit", "b_limit") if symmetric else F.col("a_limit")
        within = met.withColumn("bound", bound).where((F.col("bound") <= limit) | (F.col("a") == F.col("b")))
        return within.select(*[F.col(f"a_{g}").alias(g) for g in self.groups], "a", "b", "bound")

    def fetched(self, pairs: DataFrame, both: bool, *columns: str, rows: DataFrame | None = None) -> DataFrame:
        """The tiles of ``pairs`` with more columns of their blocks: rows of ``dealt`` if ``both``, else of ``streamed``."""
        pairs = pairs if "bound" in pairs.columns else pairs.withColumn("bound", F.lit(0.0))
        return self.dealt(pairs, *columns, rows=rows) if both else self.streamed(pairs, *columns)

    # ---- tiles ---------------------------------------------------------------------------

    def _tiled(self, pairs: DataFrame, rows: DataFrame | None, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Pairs of tiles with their pairs of blocks as arrays, and the tiles (tile, members) with more columns of ``rows``."""
        bits = min(self.tile_bits, max(0, (self.rows.count() // TILES).bit_length() - 1))
        names = ["a", "b", "bound", *self.groups]
        met = pairs.groupBy(*[F.shiftright(end, bits).alias(f"tile_{end}") for end in "ab"]).agg(F.collect_list(F.struct(*names)).alias("met"), F.min("bound").alias("least"))
        met = met.select("tile_a", "tile_b", "least", *[F.col("met")[c].alias(f"met_{c}") for c in names])
        rows = self.rows if rows is None else rows
        tiles = rows.groupBy(F.shiftright("block", bits).alias("tile")).agg(F.collect_list(F.struct("block", "seq_id", "lengths", "flat", *columns)).alias("members"))
        return cut_lineage(met), cut_lineage(tiles)

    def dealt(self, pairs: DataFrame, *columns: str, rows: DataFrame | None = None) -> DataFrame:
        """Rows for ``tile_pairs``: of tile a (side 0) with the pairs of blocks, then of tile b unless it is the same."""
        met, tiles = self._tiled(pairs, rows, columns)
        sides = met.select("*", F.posexplode(F.array_distinct(F.array("tile_a", "tile_b"))).alias("side", "tile")).drop("least")
        lists = [c for c in sides.columns if c.startswith("met_")]
        slim = sides.withColumns({c: F.when(F.col("side") == 0, F.col(c)) for c in lists})
        tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return slim.join(tiles, "tile").drop("tile").repartition(tasks, "tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b", "side")

    def streamed(self, pairs: DataFrame, *columns: str) -> DataFrame:
        """Rows of ``Tile`` for the tiles b that each tile a meets: itself first, then by their least bounds."""
        met, tiles = self._tiled(pairs, None, columns)
        tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = met.join(tiles.withColumnRenamed("tile", "tile_b"), "tile_b").repartition(tasks, "tile_a")
        return rows.sortWithinPartitions("tile_a", F.col("tile_a") != F.col("tile_b"), "least")


class Tile:
    """The blocks of a tile: ids and values of some of them, one after the other."""

    def __init__(self, members):
        self.of, self.known = {m["block"]: m for m in members}, {}

    def places(self) -> dict[int, np.ndarray]:
        """Places of the rows of each block among those of all."""
        ends = np.cumsum([len(m["lengths"]) for m in self.of.values()])
        return {block: np.arange(end - len(m["lengths"]), end) for (block, m), end in zip(self.of.items(), ends)}

    def joined(self, blocks: tuple) -> tuple[np.ndarray, dict]:
        """Ids, and values as of ``stacked``."""
        if blocks not in self.known:
            if len(self.known) >= JOINED:
                self.known.clear()
            parts = [self.of[block] for block in blocks]
            lengths = np.concatenate([np.asarray(m["lengths"], dtype=int) for m in parts])
            flat, starts = np.concatenate([np.frombuffer(m["flat"]) for m in parts]), np.cumsum(lengths) - lengths
            values = {}
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                values[int(n)] = at, flat.reshape(-1, n) if len(at) == len(lengths) else flat[starts[at][:, None] + np.arange(n)]
            ids = np.concatenate([plain_ids(m["seq_id"]) for m in parts])
            self.known[blocks] = ids, values
        return self.known[blocks]

    def rows(self, blocks: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Block and place in it of every row."""
        sizes = [len(self.of[block]["lengths"]) for block in blocks]
        return np.repeat(blocks, sizes), np.concatenate([np.arange(n) for n in sizes])


def plain_ids(ids) -> np.ndarray:
    """Ids as numbers, or as objects where they are not."""
    found = np.asarray(ids)
    return found if found.dtype.kind in "iuf" else np.array(list(ids) + [None], dtype=object)[:-1]


def meetings(a: Sequence, b: Sequence) -> Iterator[tuple[tuple, tuple]]:
    """The pairs of blocks a[p] and b[p] as few pairs of several blocks."""
    with_a: dict = {}
    for x, y in zip(a, b):
        with_a.setdefault(x, []).append(y)
    alike: dict = {}
    for x, others in with_a.items():
        alike.setdefault(tuple(sorted(others)), []).append(x)
    for others, some in alike.items():
        for p in range(0, len(some), TOGETHER[0]):
            for q in range(0, len(others), TOGETHER[1]):
                yield tuple(some[p : p + TOGETHER[0]]), others[q : q + TOGETHER[1]]


def in_turn(a: Sequence, b: Sequence) -> Iterator[tuple[tuple, tuple]]:
    """The pairs of blocks a[p] and b[p], each block of a with the next few of b, in their order."""
    with_a: dict = {}
    for x, y in zip(a, b):
        with_a.setdefault(x, []).append(y)
    for start in range(0, max(map(len, with_a.values()), default=0), NEXT):
        yield from (((x,), tuple(others[start : start + NEXT])) for x, others in with_a.items() if len(others) > start)


def stacked(arrays: Sequence) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the arrays of each length."""
    lengths = np.array([len(v) for v in arrays])
    found = {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        found[int(n)] = at, np.stack([np.asarray(arrays[i], dtype=float) for i in at])
    return found


def block_close_pairs(
    a: dict, b: dict, limits: np.ndarray, radius: int, allowed: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in both blocks and distances of the pairs within the limit of their row of ``a``."""
    for at_a, x in a.values():
        for at_b, y in b.values():
            for i, j, d in close_pairs(x, y, limits[at_a], radius, None if allowed is None else allowed[np.ix_(at_a, at_b)]):
                yield at_a[i], at_b[j], d


# ---- searches ----------------------------------------------------------------------------


def tile_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(row with the pairs of blocks, tile a, tile b) for rows of ``Blocks.dealt``."""
    row = a = None
    for batch in batches:
        for part in batch.itertuples(index=False):
            if part.side == 0:
                row, a = part, Tile(part.members)
            if part.side or row.tile_a == row.tile_b:
                yield row, a, Tile(part.members) if part.side else a


def _close_in_tiles(batches: Iterator[pd.DataFrame], limit: float, radius: int) -> Iterator[tuple]:
    """For rows of ``Blocks.dealt``: (row with the pairs of blocks, tiles, blocks, places in them and distances) of the pairs within the limit, each once."""
    def found(row, a: Tile, b: Tile) -> Iterator[tuple]:
        apart = row.met_a != row.met_b
        for block in row.met_a[~apart]:
            _, own = a.joined((block,))
            once = np.triu(np.ones((len(a.of[block]["lengths"]),) * 2, bool), 1)
            for i, j, d in block_close_pairs(own, own, np.full(len(once), float(limit)), radius, once):
                yield row, a, a, (block,), (block,), i, j, d
        for some, others in meetings(row.met_a[apart], row.met_b[apart]):
            (ids, x), (_, y) = a.joined(some), b.joined(others)
            for i, j, d in block_close_pairs(x, y, np.full(len(ids), float(limit)), radius):
                yield row, a, b, some, others, i, j, d

    for met in tile_pairs(batches):
        yield from found(*met)


def pairs_within(sequences: DataFrame, limit: float, radius: int = 3, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, i, j, dist) with i < j: all pairs of distinct sequences at most ``limit`` apart."""
    blocks = Blocks(sequences, radius, groups)
    pairs = blocks.pairs(F.lit(float(limit)))
    names, idt = blocks.groups, blocks.id_type

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for row, a, b, some, others, i, j, d in _close_in_tiles(batches, limit, radius):
            out = pd.DataFrame({"i": a.joined(some)[0][i], "j": b.joined(others)[0][j], "dist": d})
            for g in names:  # blocks that meet are of one group
                out[g] = getattr(row, f"met_{g}")[np.flatnonzero(row.met_a == some[0])[0]]
            held.append(out[[*names, "i", "j", "dist"]])
            n += len(d)
            if n >= FOUND_AT_ONCE:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if n:
            yield pd.concat([out for out in held if len(out)], ignore_index=True)

    kinds = "".join(f"`{g}` {pairs.schema[g].dataType.simpleString()}, " for g in names)
    found = blocks.dealt(pairs).mapInPandas(run, f"{kinds}i {idt}, j {idt}, dist double")
    return found.select(*names, F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "dist")


def packed(a: int, b: int, p, q, dist) -> pd.DataFrame:
    """One row of ``PACKED``."""
    dist, places = np.asarray(dist, dtype="<f8"), [np.asarray(at, dtype="<u2").tobytes() for at in (p, q)]
    return pd.DataFrame({"a": [a], "b": [b], "n": [len(dist)], "total": [dist.sum()], "p": places[:1], "q": places[1:], "dist": [dist.tobytes()]})


def unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in both blocks and distances of a row of ``PACKED``."""
    return np.frombuffer(row.p, "<u2"), np.frombuffer(row.q, "<u2"), np.frombuffer(row.dist, "<f8")


def pairs_in_blocks(sequences: DataFrame, limit: float, radius: int = 3) -> tuple[DataFrame, DataFrame]:
    """The pairs of ``pairs_within`` in rows of two blocks, written, and the blocks (block, seq_id, copies).

    Columns of ``PACKED``: both blocks, the number of pairs and the sum of their distances, places in the blocks and
    distances as bytes of numpy arrays, which pass to Python uncopied by element. A row has at most
    ``CANDIDATES_AT_ONCE`` pairs. Sequences without an id take no part.
    """
    blocks = Blocks(sequences.where("seq_id IS NOT NULL"), radius)
    pairs = blocks.dealt(blocks.pairs(F.lit(float(limit))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, a, b, some, others, i, j, d in _close_in_tiles(batches, limit, radius):
            (blocks_a, places_a), (blocks_b, places_b) = a.rows(some), b.rows(others)
            met = np.stack([blocks_a[i], blocks_b[j]])
            order = np.lexsort(met[::-1])
            for at in np.split(order, np.flatnonzero((np.diff(met[:, order]) != 0).any(axis=0)) + 1):
                if len(at):
                    yield packed(*met[:, at[0]].tolist(), places_a[i[at]], places_b[j[at]], d[at])

    return cut_lineage(pairs.mapInPandas(run, PACKED)), blocks.rows.select("block", "seq_id", "copies")


def pairs_of_blocks(pairs: DataFrame, blocks: DataFrame, limit: float) -> DataFrame:
    """(i, j, dist) with i < j: what ``pairs_in_blocks`` found within a limit, as that of ``pairs_within``."""
    kind = blocks.schema["seq_id"].dataType.elementType.simpleString()
    met = pairs.select("a", "b", "p", "q", "dist")
    for end in "ab":
        met = met.join(blocks.select(F.col("block").alias(end), F.col("seq_id").alias(f"{end}_seq_id")), end)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                p, q, dist = unpacked(row)
                near = dist <= limit
                yield pd.DataFrame({"i": np.asarray(row.a_seq_id)[p[near]], "j": np.asarray(row.b_seq_id)[q[near]], "dist": dist[near]})

    found = met.mapInPandas(run, f"i {kind}, j {kind}, dist double")
    return found.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "dist")


def _sortable(ids: np.ndarray) -> np.ndarray:
    """Ids, or numbers in their order; null comes last."""
    if ids.dtype.kind != "O":
        return ids
    codes = pd.Categorical(ids, ordered=True).codes.astype(int)
    return np.where(codes < 0, len(ids), codes)


class _Nearest:
    """The k nearest others of the sequences of one tile, fed with other tiles, nearest first."""

    def __init__(self, tile: Tile, k: int, radius: int):
        self.tile, self.k, self.radius = tile, k, radius
        self.ids = np.concatenate([plain_ids(m["seq_id"]) for m in tile.of.values()])
        self.place = tile.places()
        n = len(self.ids)
        self.j, self.dist, self.have = np.empty((n, k), self.ids.dtype), np.full((n, k), np.inf), np.zeros(n, int)
        self.limits = np.full(n, np.inf)

    def _limit(self, blocks: tuple) -> float:
        return max(self.limits[self.place[block]].max() for block in blocks)

    def meet(self, a: np.ndarray, b: np.ndarray, bound: np.ndarray, other: Tile) -> None:
        """Pairs of an own block a[p] and a block b[p] of the other tile, at least bound[p] apart."""
        self.tile.known.clear()
        for block in a[a == b]:
            self._measure((block,), (block,), other)
        order = np.argsort(bound, kind="stable")
        wanted = [p for p in order if a[p] != b[p] and bound[p] <= self._limit((a[p],))]
        least = {(a[p], b[p]): bound[p] for p in wanted}
        for some, others in meetings(a[wanted], b[wanted]) if not self.radius else in_turn(a[wanted], b[wanted]):
            if len(some) > 1 or min(least[some[0], block] for block in others) <= self._limit(some):
                self._measure(some, others, other)

    def _measure(self, some: tuple, others: tuple, other: Tile) -> None:
        rows = np.concatenate([self.place[block] for block in some])
        (_, own), (theirs, values) = self.tile.joined(some), other.joined(others)
        for i, j, d in block_close_pairs(own, values, self.limits[rows], self.radius):
            i, j = rows[i], theirs[j]
            apart = np.asarray(self.ids[i] != j, dtype=bool)
            if apart.any():
                self._add(i[apart], j[apart], d[apart])

    def _add(self, p: np.ndarray, j: np.ndarray, dist: np.ndarray) -> None:
        """Merge what was found with what is known of the same rows."""
        if j.dtype != self.j.dtype:
            self.j = self.j.astype(object)
        at = np.unique(p)
        known = np.arange(self.k)[None, :] < self.have[at][:, None]
        p = np.concatenate([np.repeat(at, self.have[at]), p])
        j, dist = np.concatenate([self.j[at][known], j]), np.concatenate([self.dist[at][known], dist])
        order = np.lexsort((_sortable(j), dist, p))
        p, j, dist = p[order], j[order], dist[order]
        starts = np.searchsorted(p, at)
        rank = np.arange(len(p)) - np.repeat(starts, np.diff(np.append(starts, len(p))))
        best = rank < self.k
        p, rank = p[best], rank[best]
        self.j[p, rank], self.dist[p, rank] = j[best], dist[best]
        self.have[at] = np.bincount(np.searchsorted(at, p), minlength=len(at))
        full = at[self.have[at] == self.k]
        self.limits[full] = self.dist[full, self.k - 1]

    def rows(self) -> pd.DataFrame:
        p, at = np.nonzero(np.arange(self.k)[None, :] < self.have[:, None])
        return pd.DataFrame({"i": self.ids[p], "j": self.j[p, at], "dist": self.dist[p, at], "pos": at + 1})


def nearest_sequences(sequences: DataFrame, k: int, radius: int = 3) -> DataFrame:
    """(i, j, dist, pos): the ``k`` nearest other distinct sequences of each one.

    The k-th neighbour inside its own block bounds each search from above. A tile then meets the
    other tiles that this allows in the order of their lower bounds, limits shrink on the way, and
    blocks whose bound is above all limits are left out. Only k rows a sequence are returned.
    """
    def farthest(ids: list, values: list) -> float:
        lengths, flat = [len(v) for v in values], np.concatenate(values).tobytes()
        tile = Tile([{"block": 0, "seq_id": ids, "lengths": lengths, "flat": flat}])
        search = _Nearest(tile, k, radius)
        search.meet(np.zeros(1, int), np.zeros(1, int), np.zeros(1), tile)
        return search.limits.max()

    blocks = Blocks(sequences, radius, measure=farthest)
    streamed = blocks.streamed(blocks.pairs(F.col("most") * (1 + 1e-12), symmetric=False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, search = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.tile_a != at:
                    if search is not None:
                        yield search.rows()
                    at, search = row.tile_a, _Nearest(Tile(row.members), k, radius)
                search.meet(row.met_a, row.met_b, row.met_bound, search.tile if row.tile_b == at else Tile(row.members))
        if search is not None:
            yield search.rows()

    return streamed.mapInPandas(run, f"i {blocks.id_type}, j {blocks.id_type}, dist double, pos int")
