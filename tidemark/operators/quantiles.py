"""Exact percentiles without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, cut_lineage

ACCURACY = 10_000  # the sketch's rank error is 1 / ACCURACY of the rows
SMALL = 3 * ACCURACY  # below, a margin of 2 / ACCURACY of the rows may be less than the two ranks between which one interpolates
RANGES = 1024  # equal-width ranges within a bracket


def _rank_at(p: float) -> tuple[Column, Column, Column]:
    position = (F.col("total") - 1) * F.lit(float(p))
    low = F.floor(position)
    return low, F.least(low + 1, F.col("total") - 1), position - low


def approximate_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Percentiles within 1 / ``accuracy`` of the rank, from mergeable sketches: one small shuffle."""
    found = F.percentile_approx(F.col(value).cast("double"), list(probabilities), accuracy)
    return df.groupBy(*keys).agg(found.alias("percentiles"))


def _brackets(known: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(keys, total, brackets): for each probability, ascending, values below and above its ranks, from one sketch.

    In a group of fewer than ``SMALL`` rows the brackets reach from the least to the largest value.
    """
    margin = 2 / ACCURACY
    edges = [min(1.0, max(0.0, p + side)) for p in probabilities for side in (-margin, margin)]
    found = known.groupBy(*keys).agg(
        F.count("v").alias("total"),
        F.percentile_approx("v", edges, ACCURACY).alias("e"),
        F.min("v").alias("least"),
        F.max("v").alias("most"),
    )
    few = F.col("total") < SMALL
    brackets = [
        F.struct(
            F.when(few, F.col("least")).otherwise(F.col("e")[2 * i]).alias("lo"),
            F.when(few, F.col("most")).otherwise(F.col("e")[2 * i + 1]).alias("hi"),
        )
        for i in range(len(probabilities))
    ]
    return found.select(*keys, "total", F.array(*brackets).alias("brackets"))


def percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated percentiles, one array column ``percentiles`` per key.

    A mergeable sketch gives each wanted rank a bracket of values around it, some ten-thousandths
    of a key's rows. One aggregate counts the rows between brackets and each different value
    inside one. Values inside are added up in ranges of equal width, and the few ranges that hold
    a wanted rank are ordered, each in a window of its own. Where the other values lie does not
    matter. The built-in exact aggregate would keep all distinct values of a key in one buffer.
    """
    keys = list(keys)
    known = df.select(*keys, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    brackets = _brackets(known, keys, sorted(set(probabilities)))
    if keys:
        # written first, so that a table of few keys is known to be small and the rows are not dealt by key
        brackets = broadcast_if_small(cut_lineage(brackets))
        same = [F.col(f"x.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        joined = known.alias("x").join(brackets.alias("b"), same).select("x.*", "total", "brackets")
    else:
        joined = known.crossJoin(F.broadcast(brackets))  # one row
    # brackets ascend, so a value inside one is inside the first that it is not above; the rows
    # that lie outside all and below the same number of brackets come before that one's values
    above = [(F.col("brackets")[i]["hi"] < F.col("v")).cast("int") for i in range(len(set(probabilities)))]
    joined = joined.withColumn("gap", reduce(add, above))
    gap, near = F.col("gap"), F.get("brackets", "gap")
    inside = F.coalesce(near["lo"] <= F.col("v"), F.lit(False))
    part = F.try_divide(F.col("v") - near["lo"], near["hi"] - near["lo"])
    wide = F.floor(F.coalesce(part, F.lit(0.0)) * RANGES)
    placed = joined.select(
        *keys,
        "total",
        (gap * (RANGES + 2) + F.when(inside, wide + 1).otherwise(F.lit(0))).alias("range"),
        F.when(inside, F.col("v")).alias("v"),
    )
    counts = cut_lineage(placed.groupBy(*keys, "range", "v").agg(F.count("*").alias("n"), F.max("total").alias("total")))

    per_range = counts.groupBy(*keys, "range").agg(F.sum("n").alias("bn"), F.max("total").alias("total"))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.withColumn("start", F.coalesce(F.sum("bn").over(before), F.lit(0)))
    ranks = F.array_distinct(F.array(*[r for p in probabilities for r in _rank_at(p)[:2]]))
    held = F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("bn")))
    wanted = starts.withColumn("ranks", held).where(F.size("ranks") > 0)

    at = [*keys, "range"]
    within = Window.partitionBy(*at).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ours, theirs = counts.alias("a"), wanted.select(*at, "start", "ranks").alias("b")
    met = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in at]
    ordered = ours.join(theirs, met).select(*[F.col(f"a.{k}").alias(k) for k in at], "v", "n", "total", "start", "ranks")
    ordered = ordered.withColumn("first_rank", F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    hits = F.filter("ranks", lambda r: (r >= F.col("first_rank")) & (r < F.col("first_rank") + F.col("n")))
    at_rank = ordered.select(*keys, "total", "v", F.explode(hits).alias("rank"))
    found = at_rank.groupBy(*keys).agg(
        F.first("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("by_rank"),
    )

    def interpolated(p: float) -> Column:
        low, high, part = _rank_at(p)
        a, b = F.element_at("by_rank", low), F.element_at("by_rank", high)
        return a + part * (b - a)

    return found.select(*keys, F.array(*[interpolated(p) for p in probabilities]).alias("percentiles"))
