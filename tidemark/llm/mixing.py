"""Mixing sources to target weights along a time-varying curriculum.

A schedule gives every source a weight that is linear between its knots over training time 0 to 1.
The integral of the weight sets the source's share of all words; the source's documents, in a
fixed random order and repeated in epochs, fill that share; the cumulative demand of the schedule
is inverted to give each taken copy its training position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name

CHUNKS = 3  # hex digits: 4096 pieces a source for the running totals


def integrated(schedule: DataFrame) -> DataFrame:
    """(source, weight, knots): integral of a schedule (source, t, weight) and its pieces.

    A piece is (t, span, w0, w1, before): weights at both ends and the integral before it. Knots
    may come in any order; a source with one knot has no integral and so no share.
    """
    by_time = Window.partitionBy("source").orderBy("t", "weight")
    piece = schedule.select(
        "source",
        "t",
        (F.lead("t").over(by_time) - F.col("t")).alias("span"),
        F.col("weight").alias("w0"),
        F.lead("weight").over(by_time).alias("w1"),
    )
    piece = piece.withColumn("area", F.coalesce(F.col("span") * (F.col("w0") + F.col("w1")) / 2, F.lit(0.0)))
    upto = Window.partitionBy("source").orderBy("t", "w0").rowsBetween(Window.unboundedPreceding, -1)
    by_time_all = piece.withColumn("before", F.coalesce(F.sum("area").over(upto), F.lit(0.0)))
    knots = F.array_sort(F.collect_list(F.struct("t", "span", "w0", "w1", "before")))
    return by_time_all.where("span is not null").groupBy("source").agg(F.sum("area").alias("weight"), knots.alias("knots"))


def targets(sizes: DataFrame, max_repeats: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight, ...): shares of all words, capped.

    No target is above ``max_repeats`` times its source's size; the excess goes to the others by
    weight until none is above. In order of the level at which a source is full, the first level
    that the remaining words do not reach is the level of all sources that are not full. One row
    for each source: the ordered pass is over sources, never over documents.
    """
    level = F.col("cap") / F.col("weight")
    order = Window.orderBy(level, F.col("source").asc_nulls_last())
    full = sizes.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    some = full.where("weight > 0").select(
        level.alias("full_at"),
        F.col("weight"),
        (F.sum("cap").over(order) - F.col("cap")).alias("given"),
        (F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(order) + F.col("weight")).alias("left"),
    )
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("total"))
    reached = some.crossJoin(F.broadcast(total)).select("full_at", ((F.col("total") - F.col("given")) / F.col("left")).alias("level"))
    common = reached.where("full_at > level").agg(F.max("level").alias("level"))  # after the first, levels fall
    share = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    priced = full.crossJoin(F.broadcast(common))  # one row
    return priced.withColumn("target", F.when(F.col("weight") > 0, share).otherwise(F.lit(0.0))).drop("cap", "level")


def _position(knots: Column, weight: Column, done: Column) -> Column:
    """Training time at which the share ``done`` (0 to 1) of a source's integral is reached."""
    area = done * weight
    piece = F.element_at(F.filter(knots, lambda k: k["before"] <= area), -1)
    rest, slope = area - piece["before"], (piece["w1"] - piece["w0"]) / piece["span"]
    root = piece["w0"] + F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * slope * rest, F.lit(0.0)))
    return piece["t"] + F.when(root > 0, F.least(2 * rest / root, piece["span"])).otherwise(F.lit(0.0))


def mix(docs: DataFrame, schedule: DataFrame, size: str, mark: str, source: str = "source", out: str = "mix", max_repeats: float = 3.0) -> DataFrame:
    """``docs`` with a struct ``out``: what the mix takes of every row.

    ``size`` names a long column of words, ``mark`` a hex string that orders a source's rows at
    random (a digest of the row); rows equal in both are taken in any order. The struct has
    source_size, target (words of the row's source), taken (words of this row, repeats counted;
    a source's last copy may be cut), copies (whole copies, a cut one counted from its half on)
    and positions (training times in 0 to 1, one for each copy, whole or cut).

    Null sources form one source. Sources that are not in the schedule get nothing. Sources
    without words get the target 0. No rows give no rows.
    """
    chunk = F.coalesce(F.substring(F.col(mark), 1, CHUNKS), F.lit(""))
    parts = docs.groupBy(F.col(source).alias("source"), chunk.alias("_chunk")).agg(F.sum(size).alias("n"))
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("source", "_chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    sizes = parts.groupBy("source").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("source_size"))
    known = integrated(schedule).select(F.col("source").alias("_known"), "weight", "knots")
    weighted = sizes.join(known, F.col("source").eqNullSafe(F.col("_known")), "left").drop("_known")
    by_source = targets(weighted.withColumn("weight", F.coalesce("weight", F.lit(0.0))), max_repeats)
    pieces = starts.alias("s").join(by_source.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source")))
    columns = ["source_size", "target", "weight", "knots"]
    at_name, key, piece_name, before_name = (free_name(docs, name) for name in ("at", "key", "piece", "before"))
    piece = pieces.select(F.struct("s.source", "s._chunk").alias(key), F.struct("start", *columns).alias(piece_name))

    # structs are equal if their nulls are, so that window and join share one shuffle of the rows
    placed = docs.withColumn(at_name, F.struct(F.col(source).alias("source"), chunk.alias("_chunk")))
    within = Window.partitionBy(at_name).orderBy(mark, size).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn(before_name, F.coalesce(F.sum(size).over(within), F.lit(0)))
    placed = placed.join(piece, F.col(at_name) == F.col(key))
    s, words = F.col(f"{piece_name}.source_size"), F.col(size)
    wanted = F.floor(F.col(f"{piece_name}.target") + 0.5)
    epochs = F.when(s > 0, F.floor(wanted / s)).otherwise(F.lit(0))
    at = F.col(f"{piece_name}.start") + F.col(before_name)
    cut = F.least(F.greatest(wanted - epochs * s - at, F.lit(0)), words)
    copies = epochs + F.when((cut > 0) & (cut * 2 >= words), 1).otherwise(0)

    def position(epoch: Column) -> Column:
        n = F.when(epoch < epochs, words).otherwise(cut)
        return _position(F.col(f"{piece_name}.knots"), F.col(f"{piece_name}.weight"), (epoch * s + at + n / 2) / wanted)

    count = (epochs + F.when(cut > 0, 1).otherwise(0)).cast("int")
    none = F.array().cast("array<double>")
    positions = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), position)).otherwise(none)
    fields = [
        s.alias("source_size"),
        F.col(f"{piece_name}.target").alias("target"),
        (epochs * words + cut).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
        positions.alias("positions"),
    ]
    return placed.withColumn(out, F.struct(*fields)).drop(at_name, before_name, key, piece_name)


def training_order(docs: DataFrame, mixed: str = "mix") -> DataFrame:
    """One row for each whole copy, sorted by training position over all partitions; all columns stay."""
    position = free_name(docs, "position")
    taken = docs.withColumn(position, F.explode(F.slice(f"{mixed}.positions", 1, F.col(f"{mixed}.copies"))))
    return taken.orderBy(position).drop(position, mixed)


def marked(docs: DataFrame, id: str, text: str) -> Column:
    """Digest that orders rows at random: of the id and the text, a null id or text as empty."""
    return F.md5(F.concat(F.coalesce(docs[id].cast("string"), F.lit("")), F.lit("|"), F.coalesce(docs[text], F.lit(""))))


def ranked_schedule(docs: DataFrame, source: str, weights: tuple[float, ...], tilts: tuple[float, ...]) -> DataFrame:
    """A schedule by rank: sources by code point, null last, take ``weights`` in turn.

    Over training a weight moves from (1 - tilt) to (1 + tilt) times its mean; the sources take
    ``tilts`` in turn too.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    names = docs.select(F.col(source).alias("source")).distinct().select("source", rank.alias("rank"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    tilt = F.element_at(F.array(*map(F.lit, tilts)), (F.col("rank") % len(tilts) + 1).cast("int"))
    ends = names.select("source", weight.alias("w"), tilt.alias("tilt"), F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("t"))
    return ends.select("source", "t", (F.col("w") * (1 + F.col("tilt") * (2 * F.col("t") - 1))).alias("weight"))
